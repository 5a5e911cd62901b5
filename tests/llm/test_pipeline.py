"""The corpus pipeline, stage by stage, against its operators' own decisions."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from leaguescore.llm import mixing, simhash
from leaguescore.llm.runtime import stored

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        out[name] = docs
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_filters_keep_clean_documents(spark, staged):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    ruled, graded = ids(staged["quality_rules"]), ids(staged["quality_classifier"])
    assert not [r for r in labels if r["quality"] == 0 and r["doc_id"] in ruled]
    clean = {r["doc_id"] for r in labels if r["quality"] == 1 and r["toxic"] == 0} & ruled
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1} & ruled
    assert len(clean & graded) > 0.98 * len(clean) and len(toxic & graded) < 0.1 * len(toxic)
    for name in ("quality_rules", "quality_classifier", "near_duplicates", "mix"):
        assert staged[name].columns == staged["documents"].columns


def test_one_document_of_each_group_stays(staged):
    before = staged["quality_classifier"]
    classes = simhash.classes(simhash.fingerprints(before)).toPandas()
    assert ids(staged["near_duplicates"]) == set(classes.component_id)
    assert staged["near_duplicates"].count() == classes.component_id.nunique()


def test_no_row_for_each_document_is_broadcast(spark, staged, monkeypatch):
    """Spark sizes cells and stored tables far below what they are in the driver."""
    made, links, classes = [], simhash.links, simhash.classes
    monkeypatch.setattr(simhash, "links", lambda *a: made.append(links(*a)) or made[-1])
    monkeypatch.setattr(simhash, "classes", lambda *a, **b: made.append(classes(*a, **b)) or made[-1])
    stored(corpus_pipeline.near_duplicates(spark, staged["quality_classifier"], SF_DIR), "found")
    assert len(made) == 2
    for df in made:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_mix_takes_effect(staged):
    before = staged["near_duplicates"]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(before).collect()}
    sizes = mixing.sized(staged["mix"], "doc_id", "source", "text").groupBy("doc_id")
    got = {r["doc_id"]: r["n"] for r in sizes.agg(F.sum("size").alias("n")).collect()}
    assert got == {k: n for k, n in taken.items() if n}
    assert staged["mix"].where("n_chars <> length(text)").isEmpty()


def test_packed(staged):
    packed = staged["pack"].toPandas()
    assert ids(staged["pack"]) == ids(staged["mix"])
    assert (packed.ids.map(len) == 4 * packed.length).all()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert packed.sequence_id.nunique() < 1.03 * packed.length.sum() / 1024


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a " * 90, "en", None, 180)]
    rows += [(3, " ".join(f"word{i}" for i in range(80)), None, "s", None)] * 2
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema).withColumn("kept", F.lit("clash"))
    for some in (docs, docs.where("doc_id = 99")):
        now = some
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, SF_DIR), name)
            if name != "pack":
                assert now.columns == docs.columns
        assert ids(now) <= {3}
