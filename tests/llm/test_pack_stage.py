"""The packing stage's capacity for documents, where documents are short."""

from collections import Counter

import corpus_pipeline


def test_documents_bind_in_the_pack_stage(spark):
    docs = spark.createDataFrame([(k, f"short text {k}") for k in range(900)], "doc_id long, text string")
    rows = corpus_pipeline.pack(spark, docs, "").collect()
    assert {r["doc_id"] for r in rows} == set(range(900)) and len(rows) == 900
    held = Counter(r["sequence_id"] for r in rows)
    assert max(held.values()) == corpus_pipeline.SEQUENCE.documents == 8
    assert len(held) == 113
