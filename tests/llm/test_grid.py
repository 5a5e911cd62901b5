"""The grid's two sizes give the same links; folders of a run are removed where that is asked for."""

import os
import random

import pytest
from pyspark.sql import functions as F

from leaguescore.llm import simhash
from leaguescore.llm.runtime import own_tables, stored


def near(spark, seed, n=60):
    """Fingerprints in clusters: each a few bits from another."""
    random.seed(seed)
    found = {0, (1 << 64) - 1}
    while len(found) < n:
        base = random.choice(sorted(found)) if random.random() < 0.8 else random.getrandbits(64)
        for bit in random.sample(range(64), random.randint(0, 6)):
            base ^= 1 << bit
        found.add(base)
    rows = [(simhash.signed(f), simhash.signed(f)) for f in sorted(found)]
    return spark.createDataFrame(rows, "fingerprint long, grp long"), [f for f, _ in rows]


@pytest.mark.parametrize("dimensions", [simhash.DIMENSIONS, simhash.FINER])
@pytest.mark.parametrize("distance", [0, 3, 4])
def test_links_are_those_of_all_pairs(spark, distance, dimensions):
    nodes, prints = near(spark, distance)
    got = sorted(map(tuple, simhash.links(nodes, distance, dimensions).collect()))
    wanted = sorted(
        (min(a, b), max(a, b))
        for i, a in enumerate(prints) for b in prints[:i]
        if bin((a ^ b) & (2**64 - 1)).count("1") <= distance
    )
    assert got == wanted and (wanted or not distance)


@pytest.mark.parametrize("dimensions", [simhash.DIMENSIONS, simhash.FINER])
def test_cells_are_never_broadcast(spark, dimensions):
    """However small the stored table is: its cells are 70 and more for each row, which Spark does not know."""
    nodes, _ = near(spark, 5)
    found = simhash.links(stored(nodes, "nodes"), 4, dimensions)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1 << 20
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_the_finer_grid_makes_fewer_chance_pairs(spark):
    random.seed(1)
    rows = [(simhash.signed(random.getrandbits(64)),) * 2 for _ in range(3000)]
    nodes = stored(spark.createDataFrame(rows, "fingerprint long, grp long"), "nodes")
    pairs = []
    for dimensions in (simhash.DIMENSIONS, simhash.FINER):
        cells = simhash.grid_cells(nodes, 4, dimensions).groupBy("choice", "cell").count()
        pairs.append(cells.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0])
    assert pairs[1] < pairs[0] / 20


def test_large_tables_have_the_finer_grid_and_the_same_classes(spark, monkeypatch):
    nodes, _ = near(spark, 9)
    prints = nodes.select(F.monotonically_increasing_id().alias("doc_id"), "fingerprint")
    prints = stored(prints, "prints")
    coarse = sorted(map(tuple, simhash.classes(prints).collect()))
    monkeypatch.setattr(simhash, "FINER_FROM", 1)
    assert sorted(map(tuple, simhash.classes(prints).collect())) == coarse


def test_own_tables_are_removed_and_others_stay(spark):
    kept = stored(spark.range(3), "kept")
    with own_tables(spark) as made:
        total = stored(spark.range(5), "gone").count()
        assert len(made) == 1 and os.path.isdir(made[0].removeprefix("file:"))
    assert total == 5 and not os.path.exists(made[0].removeprefix("file:"))
    assert kept.count() == 3
    after = stored(spark.range(2), "after")
    assert after.count() == 2
