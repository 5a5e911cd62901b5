"""A third of all rows under one key, and as many without one, are dealt to several tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leaguescore.llm import bitplanes, mixing, packing, registry, sketch
from leaguescore.llm.runtime import new_folder, row_cuts, shared_folder
from leaguescore.llm.tokens import public_vocabulary

N = 3000


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).cast("long")
    text = F.concat(F.lit("some words of document "), F.col("id") % 900, F.lit(" and more of it"))
    rows = spark.range(0, N, 1, 6).select(key.alias("doc_id"), text.alias("text"))
    return rows.persist()


def test_ranges_divide_the_rows_of_a_key(hot):
    cuts = row_cuts(hot, "doc_id", "text", 16)
    assert cuts.rows == sorted(cuts.rows) and 12 <= len(cuts.rows) <= 24
    placed = hot.select("doc_id", "text", cuts.place().alias("at")).withColumn("r", cuts.number(F.col("at")))
    rows = placed.collect()
    for row in rows:
        at = tuple(row["at"])
        assert row["r"] == sum(cut <= at for cut in cuts.rows) - 1
    counts = np.bincount([r["r"] for r in rows], minlength=len(cuts.rows))
    assert counts.min() > 0 and counts.max() < N / 5
    for name in (7, None):
        assert len({r["r"] for r in rows if r["doc_id"] == name}) >= 4
    some = {(r["at"]["is_null"], r["at"]["key"], r["at"]["hash"]) for r in rows}
    assert set(cuts.rows) <= some and cuts.rows[0] == min(some)


def test_odd_tables(spark, hot):
    assert row_cuts(hot.where("doc_id = -5"), "doc_id", "text", 8).rows == []
    for some in (hot.where("doc_id IS NULL"), hot.where("doc_id = 7"), hot.where("doc_id = 1")):
        cuts = row_cuts(some, "doc_id", "text", 8)
        numbers = {r[0] for r in some.select(cuts.number(cuts.place())).collect()}
        assert numbers == set(range(len(cuts.rows)))


def in_order(hot):
    cuts = row_cuts(hot, "doc_id", "text", 2)
    return [(r["doc_id"], r["text"]) for r in sorted(
        hot.select("doc_id", "text", cuts.place().alias("at")).collect(), key=lambda r: (tuple(r["at"]), r["text"])
    )]


def test_each_document_meets_the_next(spark, hot):
    rows = in_order(hot)
    how = sketch.Scale()
    wanted = sorted(
        (sketch.sketch_of(t, how).digits(), sketch.sketch_of(sketch.edited(t, following), how).digits())
        for (_, t), (_, following) in zip(rows, [*rows[1:], rows[0]])
    )
    got = sketch.compare_edited(hot).select("fingerprint", "edited_fingerprint").collect()
    assert sorted(map(tuple, got)) == wanted
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as they are small here
    try:
        counts = sketch.with_next(hot, "doc_id", "text").where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(counts) >= 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_files_of_a_hot_key(spark, hot):
    vocabulary = public_vocabulary(registry.WORD_BPE)
    manifest = bitplanes.write_files(hot, new_folder(spark, "planes"), vocabulary)
    assert len(manifest) >= 6 and max(r["n_docs"] for r in manifest) < N / 2
    back = sorted(bitplanes.read_files(spark, manifest).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(vocabulary)
    rows = in_order(hot)
    assert [r["doc_id"] for r in back] == [k for k, _ in rows]
    for r, (_, text) in list(zip(back, rows))[::50]:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        assert bytes(r["ids"]) == np.array(ids, "<u4").tobytes()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


def test_rows_of_one_key_and_size_are_in_many_shards(spark):
    docs = spark.range(0, 2000, 1, 4).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"),
        F.concat(F.lit("one two three w"), F.col("id")).alias("text"),
    )
    mixed = mixing.mix_sources(docs, mixing.Mix(shard_words=400, total_share=0.5))
    taken = mixed.select("taken", "size", "target", "source_size").collect()
    assert len(taken) == 2000 and {r["source_size"] for r in taken} == {8000}
    assert abs(sum(r["taken"] for r in taken) - 4000) <= 16 and max(r["taken"] for r in taken) <= 8
    shards = mixing.sized(docs, "doc_id", "source", "text").select("text_hash").distinct().count()
    assert shards == 2000  # what shards are dealt by tells the rows apart


def test_pieces_are_packed_alike_in_any_order_of_arrival(spark):
    rows = [(k, k % 3, 10 + k * 7 % 90) for k in range(500)]
    def packed(some):
        df = spark.createDataFrame(some, "doc_id long, piece int, length long").coalesce(1)
        out = packing.pack(df, packing.Capacity(100, 100, 10_000), n_rows=500).collect()
        return {(r["doc_id"], r["piece"], r["length"], r["sequence_id"], r["offset"]) for r in out}

    assert packed(rows) == packed(rows[::-1]) == packed(sorted(rows, key=lambda r: r[2]))
