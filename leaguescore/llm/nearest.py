"""Approximate nearest neighbours by largest inner product, on one small-world graph per shard.

A shard has at most ``SHARD_ROWS`` distinct vectors. Its hierarchical navigable small-world graph is
a table row: vectors, levels and neighbours as flat arrays. Vectors get one more component that
gives all the same length, so that the largest inner product is the nearest on that sphere and
graph distances are those of a metric; a query's is zero. Every query searches every shard, and the
shards' results are merged. Scores are inner products of the original vectors in double precision.

Equal vectors are one node that stands for all their rows, else thousands of copies would be each other's
neighbours and cut off from the rest. A node keeps the ``k + 1`` smallest ids of its rows: ties go to
smaller ids and a query leaves out its own row at most, so no other copy can be in a result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguescore.llm.runtime import map_arrow, share_package, stored

#: Vectors of a shard; neighbours of a node on upper levels (twice as many on the lowest).
SHARD_ROWS, NEIGHBOURS = 16_384, 16
#: Nodes that a search keeps in view while the graph is built, and when it is searched.
BUILD_VIEW, SEARCH_VIEW = 100, 200
#: Queries that meet a shard at once.
QUERY_ROWS = 4_096
SEED = 13


class Graph:
    """A hierarchical navigable small-world graph over unit-like vectors, by inner product.

    ``links[level]`` is an array of one row of neighbours a node, -1 where there is none.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.levels, self.links, self.entry = vectors, levels, links, entry
        self.seen = np.zeros(len(vectors), np.int64)
        self.turn = 0

    def closest(self, query: np.ndarray, start: list[tuple[float, int]], view: int, level: int) -> list:
        """The ``view`` best nodes that a best-first walk on a level finds, as a heap of (score, node)."""
        self.turn += 1
        links, vectors, seen, turn = self.links[level], self.vectors, self.seen, self.turn
        todo = [(-score, node) for score, node in start]
        heapq.heapify(todo)
        best = list(start)
        heapq.heapify(best)
        for _, node in start:
            seen[node] = turn
        while todo:
            score, node = heapq.heappop(todo)
            if len(best) >= view and -score < best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            scores = vectors[near] @ query
            if len(best) >= view:
                some = scores > best[0][0]
                near, scores = near[some], scores[some]
            for s, other in zip(scores.tolist(), near.tolist()):
                if len(best) < view:
                    heapq.heappush(best, (s, other))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, other))
                else:
                    continue
                heapq.heappush(todo, (-s, other))
        return best

    def search(self, query: np.ndarray, view: int) -> list[tuple[float, int]]:
        """About the ``view`` best nodes for a query."""
        at = [(float(self.vectors[self.entry] @ query), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            at = [max(self.closest(query, at, 1, level))]
        return self.closest(query, at, view, 0)


def spread(vectors: np.ndarray, query: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """At most ``most`` of the found nodes, best first, each nearer to the query than to a chosen one.

    Places that are left go to the best of the others, so that no node has few neighbours.
    """
    found = sorted(found, reverse=True)
    nodes = np.array([node for _, node in found])
    if len(nodes) <= most:
        return nodes.tolist()
    between = vectors[nodes] @ vectors[nodes].T
    chosen: list[int] = []
    closest = np.full(len(nodes), -np.inf)
    for i, (score, _) in enumerate(found):
        if len(chosen) == most:
            break
        if score > closest[i]:
            chosen.append(i)
            np.maximum(closest, between[i], out=closest)
    others = [i for i in range(len(nodes)) if i not in set(chosen)]
    return nodes[(chosen + others)[:most]].tolist()


def build_graph(vectors: np.ndarray, seed: int, neighbours: int = NEIGHBOURS, view: int = BUILD_VIEW) -> Graph:
    """Insert all vectors, one after another, in their order; levels are drawn from the seed."""
    n = len(vectors)
    draws = np.random.default_rng(seed).random(n)
    levels = np.minimum((-np.log(1 - draws) / np.log(neighbours)).astype(np.int64), 12)
    widths = [2 * neighbours] + [neighbours] * int(levels.max(initial=0))
    graph = Graph(vectors, levels, [np.full((n, w), -1, np.int32) for w in widths], 0)
    filled = [np.zeros(n, np.int64) for _ in widths]
    for node in range(1, n):
        query, top = vectors[node], int(levels[graph.entry])
        at = [(float(vectors[graph.entry] @ query), graph.entry)]
        for level in range(top, int(levels[node]), -1):
            at = [max(graph.closest(query, at, 1, level))]
        for level in range(min(top, int(levels[node])), -1, -1):
            at = graph.closest(query, at, view, level)
            links, full, width = graph.links[level], filled[level], widths[level]
            chosen = spread(vectors, query, at, neighbours)
            links[node, : len(chosen)] = chosen
            full[node] = len(chosen)
            for other in chosen:
                if full[other] < width:
                    links[other, full[other]] = node
                    full[other] += 1
                    continue
                ring = np.append(links[other], node)
                scores = vectors[ring] @ vectors[other]
                kept = spread(vectors, vectors[other], list(zip(scores.tolist(), ring.tolist())), width)
                links[other, : len(kept)] = kept
        if levels[node] > levels[graph.entry]:
            graph.entry = node
    return graph


def usable(vector: Column) -> Column:
    """Is it neither null, empty, zero nor with a component that is null or not finite?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(rows: DataFrame, ids: str, vector: str, copies: int) -> DataFrame:
    """``(node, dim, vector, ids)``: each distinct vector with its smallest ids; ``node`` is the first of them.

    Rows that are equal count once. Of thousands of copies, each task hands on ``copies`` only.
    """
    order = Window.partitionBy("vector").orderBy("id")
    some = rows.where(usable(F.col(vector)) & F.col(ids).isNotNull()).select(
        F.col(ids).alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    first = some.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= copies).select("id", "vector").distinct()
    grouped = first.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("node"), F.size("vector").alias("dim"), "vector", "ids")


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64)


def build_index(
    rows: DataFrame,
    ids: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row for each shard: its distinct vectors, their row ids, and the graph as flat arrays.

    Shards are cut by a hash of the vector, evenly whatever the copies; vectors of different
    lengths are never in one shard. Unusable vectors and rows without id are left out. ``ids``
    must be of a type that sorts; ids of equal vectors may repeat.
    """
    nodes = stored(nodes_of(rows, ids, vector, k + 1), "nodes")
    shards = F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("shards")
    sizes = stored(nodes.groupBy("dim").agg(shards), "shard-counts")
    n_shards = sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]
    hashed = F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int").alias("shard")
    dealt = nodes.join(sizes, "dim").select("dim", hashed, "shards", "vector", "ids")
    kind = rows.schema[ids].dataType.simpleString()
    schema = (
        f"dim int, shard int, shards int, n long, ids array<array<{kind}>>, vectors binary, "
        "levels binary, entry long, widths array<int>, links binary"
    )

    def built(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(pc.list_element(table["ids"], 0))
        table = table.take(order).combine_chunks()  # the same graph whatever the order of rows
        own = matrix(table["vector"].chunk(0))
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        graph = build_graph(lifted(own), SEED + shard)
        flat = b"".join(np.ascontiguousarray(x, np.int32).tobytes() for x in graph.links)
        return pa.Table.from_pydict(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": pa.array([shard], pa.int32()),
                "shards": pa.array([table["shards"][0].as_py()], pa.int32()),
                "n": pa.array([len(own)], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), table["ids"].chunk(0)),
                "vectors": pa.array([own.tobytes()], pa.binary()),
                "levels": pa.array([graph.levels.astype(np.uint8).tobytes()], pa.binary()),
                "entry": pa.array([graph.entry], pa.int64()),
                "widths": pa.array([[x.shape[1] for x in graph.links]], pa.list_(pa.int32())),
                "links": pa.array([flat], pa.binary()),
            }
        )

    share_package(rows.sparkSession)
    dealt = dealt.repartition(3 * n_shards, "dim", "shard")  # few bytes, much work: not to be coalesced
    return dealt.groupBy("dim", "shard").applyInArrow(built, schema)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows over their greatest component, which changes no order and keeps squares finite."""
    return vectors / np.abs(vectors).max(axis=1, keepdims=True)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """All of one length, by one more component; in single precision, for the walk only."""
    vectors = vectors / np.abs(vectors).max()
    squares = (vectors**2).sum(axis=1)
    rest = np.sqrt(squares.max() - squares)
    return np.ascontiguousarray(np.column_stack([vectors, rest]) / np.sqrt(squares.max()), np.float32)


def graph_of(row: dict) -> tuple[np.ndarray, Graph]:
    """A shard's original vectors and its graph, from its row."""
    own = np.frombuffer(row["vectors"]).reshape(row["n"], row["dim"])
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for width in row["widths"]:
        links.append(flat[at : at + row["n"] * width].reshape(-1, width))
        at += row["n"] * width
    return own, Graph(lifted(own), np.frombuffer(row["levels"], np.uint8), links, row["entry"])


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 20,
    ids: str = "vec_id",
    vector: str = "embedding",
    view: int = SEARCH_VIEW,
) -> DataFrame:
    """``(query_id, rank, ids, score)``: up to ``k`` rows of largest inner product found for each query.

    A query is a distinct pair of id and vector; rows with its own id are not among its results. Ties go to
    the smaller id. The index must have been built for this ``k`` or a larger one. Equal query vectors are
    searched once. Blocks of queries meet every shard; no query is compared with all rows.
    """
    kind = index.schema["ids"].dataType.elementType.elementType.simpleString()
    asked = queries.where(usable(F.col(vector)) & F.col(ids).isNotNull()).select(
        F.col(ids).alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    asked = stored(asked.distinct(), "queries")
    nodes = stored(asked.groupBy("vector").agg(F.min("query_id").alias("node")), "query-nodes")
    blocks = -(-nodes.count() // QUERY_ROWS) or 1
    shards = index.groupBy("dim").agg(F.max("shards").alias("shards"))
    block = F.pmod(F.xxhash64("vector"), F.lit(blocks)).alias("block")
    grouped = nodes.groupBy(F.size("vector").alias("dim"), block).agg(
        F.collect_list("node").alias("nodes"), F.flatten(F.collect_list("vector")).alias("flat")
    )  # lists of one aggregate have one order
    each = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    met = index.drop("shards").join(grouped.join(shards, "dim").select("dim", each, "nodes", "flat"), ["dim", "shard"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, graph = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("dim", "shard", "n")}
                if at != (row["dim"], row["shard"]):
                    at = (row["dim"], row["shard"])
                    row |= {n: batch.column(n)[i].as_py() for n in ("vectors", "levels", "entry", "widths", "links")}
                    own, graph = graph_of(row)
                members = batch.column("ids")[i].values
                nodes = batch.column("nodes")[i].values
                wanted = np.asarray(batch.column("flat")[i].values).reshape(len(nodes), -1)
                yield from results(graph, own, members, nodes, wanted)

    def results(graph, own, members, nodes, wanted) -> Iterator[pa.RecordBatch]:
        walk = np.column_stack([scaled(wanted), np.zeros(len(wanted))]).astype(np.float32)
        starts = np.asarray(members.offsets)
        flat, least = members.values, np.asarray(pc.list_element(members, 0))
        of, rows, scores = [], [], []
        for q, query in enumerate(wanted):
            found = np.array([node for _, node in graph.search(walk[q], max(view, k + 1))])
            exact = (own[found] * query).sum(axis=1)
            left = k + 1
            for j in np.lexsort((least[found], -exact)).tolist():
                low, high = int(starts[found[j]]), int(starts[found[j] + 1])
                high = min(high, low + left)
                rows += range(low, high)
                of += [q] * (high - low)
                scores += [exact[j]] * (high - low)
                left -= high - low
                if not left:
                    break
        columns = [nodes.take(pa.array(of, pa.int64())), flat.take(pa.array(rows, pa.int64())), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "id", "score"])

    node_kind = nodes.schema["node"].dataType.simpleString()
    found = map_arrow(met, searched, f"node {node_kind}, id {kind}, score double")
    order = (F.col("score").desc(), F.col("id"))
    part = found.withColumn("part", F.spark_partition_id() % 64)
    near = Window.partitionBy("node", "part").orderBy(*order)
    some = part.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k + 1)
    whole = Window.partitionBy("node").orderBy(*order)
    best = some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k + 1)
    best = best.select("node", "id", "score")
    of_query = asked.join(nodes, "vector").select("query_id", "node").join(best, "node")
    own = Window.partitionBy("query_id", "node").orderBy(*order)
    ranked = of_query.where("id <> query_id").withColumn("rank", F.row_number().over(own))
    return ranked.where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), F.col("id").alias(ids), "score"
    )


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, ids: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``search`` over an index of all ``rows`` that is written for it."""
    return search(stored(build_index(rows, ids, vector, k), "graphs"), queries, k, ids, vector)
