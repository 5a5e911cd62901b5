"""Connected components by contraction, in shuffles whose rows shrink every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import stored


def components(edges: DataFrame, kind: str = "long") -> DataFrame:
    """``(node, label)`` of every node that has an edge; equal labels: connected.

    ``edges`` has columns ``a`` and ``b``. Each round a node goes to the smallest of its
    neighbours and itself, and the edges between what is left form the next round. The
    smallest neighbour is pre-aggregated in the tasks, so a hub sends few rows. Labels are
    nodes, but not always the smallest. Rounds grow with the logarithm of the graph.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    whole = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("label")
        )
        step = stored(step, "labels")
        if whole is None:
            whole = step
        else:
            later = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            whole = whole.join(later, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label")
            )
        left = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        moved = edges.join(left, "a").join(right, "b").where("la <> lb")
        pair = moved.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
        edges = stored(pair.distinct(), "edges")
    if whole is None:
        return spark.createDataFrame([], f"node {kind}, label {kind}")
    return stored(whole, "components")
