"""From documents to packed training sequences, in five stages.

A stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before kept. It
returns the columns of documents, the last stage packed pieces. Input columns are renamed within
a stage, so that none can clash with what an operator adds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguescore.llm import mixing, ordinal, packing, simhash, supervision
from leaguescore.llm.runtime import stored
from leaguescore.llm.tokens import public_vocabulary

KEY, TEXT, SOURCE = "in_doc_id", "in_text", "in_source"
#: Eight pieces at most; pieces may have 1024 tokens, so no lower attention cost would hold them.
SEQUENCE = packing.Capacity(documents=8)


def named(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def plain(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents under their own names."""
    return rows.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep."""
    rows = named(docs)
    judged = supervision.judge(rows, key=KEY, text=TEXT, carry=tuple(rows.columns))
    return plain(judged.where("kept"), docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely than not of the highest grade."""
    rows, labels = named(docs), spark.read.parquet(f"{sf_dir}/labels.parquet")
    graded = ordinal.classify(rows, labels, key=KEY, text=TEXT, carry=tuple(rows.columns))
    return plain(graded.where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of linked fingerprints; of rows alike, one.

    Shingles of four words, links at four differing bits or fewer. A null text is empty, and texts without words are
    one class. Rows without id come after those with one, and by a hash of their texts; so do rows of equal ids.
    """
    row = F.struct(
        F.col(KEY).isNull().alias("no_id"),
        F.coalesce(F.col(KEY), F.lit(0)).alias("id"),
        F.xxhash64(TEXT).alias("hash"),
    )
    rows = named(docs).withColumn("row", row)
    prints = simhash.fingerprints(rows, width=4, key="row", text=TEXT)
    found = simhash.classes(prints, distance=4, key="row")
    kept = found.where("row = component_id").select("row").distinct()
    alike = Window.partitionBy("row").orderBy(F.lit(1))
    single = rows.join(kept, "row", "left_semi").withColumn("n", F.row_number().over(alike))
    return plain(single.where("n = 1"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those at the end of a run of blocks are cut."""
    rows = named(docs)
    mixed = mixing.mix_sources(rows, key=KEY, source=SOURCE, text=TEXT, carry=tuple(rows.columns))
    whole = F.when(
        F.col("rounds") > 0,
        F.array_repeat(F.struct(F.lit(0).cast("long").alias("low"), "size"), F.col("rounds").cast("int")),
    ).otherwise(F.array().cast("array<struct<low: bigint, size: bigint>>"))
    copies = F.concat(whole.cast("array<struct<low: bigint, high: bigint>>"), "cuts")
    taken = mixed.where("taken > 0").withColumn("cut", F.explode(copies))
    is_whole = F.col("cut.high") - F.col("cut.low") == F.col("size")
    cut_text = mixing.take_text(F.col(TEXT), F.col("cut"))
    text = F.when(is_whole, F.col(TEXT)).otherwise(cut_text)
    out = taken.withColumn(TEXT, text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        count = F.when(is_whole, F.col("in_n_chars")).otherwise(F.length(TEXT).cast(kind))
        out = out.withColumn("in_n_chars", count)
    return plain(out, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)``: sequences of 1024 tokens and eight pieces."""
    pieces = packing.cut_pieces(docs, public_vocabulary("byte_bpe_50k.json"), special_ids=True)
    return packing.pack(pieces, SEQUENCE, n_rows=docs.count(), group_rows=2_048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: Classifier, fingerprints and token ids are beyond SQL; tests hold the rows against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
