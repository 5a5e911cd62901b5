"""One query for each operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguescore.llm import (
    bitplanes,
    chat,
    lattice,
    mixing,
    nearest,
    ordinal,
    packing,
    ranking,
    separators,
    simhash,
    sketch,
    spelling,
    supervision,
)
from leaguescore.llm.runtime import new_folder, stored
from leaguescore.llm.tokens import public_vocabulary

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
END_OF_TEXT = 50256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.classify(documents(spark, sf_dir), labels)


def op2_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "taken")


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted from flat files of their ids."""
    docs, vocabulary = documents(spark, sf_dir), public_vocabulary(BYTE_BPE)
    folder = new_folder(spark, "flat")
    placed = stored(separators.write_flat(docs, folder, vocabulary, END_OF_TEXT), "placed")
    counted = separators.count_tokens(docs, vocabulary, END_OF_TEXT, folder, placed)
    return counted.select("doc_id", "n_tokens")


def op4_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir), public_vocabulary(PIECES))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like the template's own marks."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
        "conv_id long, turn long, role string, text string",
    )
    whole = turns.select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_conversations(whole))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(simhash.fingerprints(documents(spark, sf_dir), width=4), distance=4)
    return found.withColumn("fingerprint", simhash.hex_digits(F.col("fingerprint")))


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = supervision.judge(documents(spark, sf_dir))
    return judged.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        "base_failed",
        "kept",
        "posterior",
    )


def op8_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_edited(documents(spark, sf_dir))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pieces = packing.cut_pieces(docs, public_vocabulary(BYTE_BPE), tokens=1024, special_ids=True)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, packing.Capacity(), n_rows=docs.count())


def op10_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = documents(spark, sf_dir), public_vocabulary(WORD_BPE)
    read_back = bitplanes.round_trip(docs, vocabulary, special_ids=True)
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranking.ranked(documents(spark, sf_dir), items, k=10)


def op12_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(documents(spark, sf_dir)))


def op13_small_world_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality,
        op2_sainte_lague_mix,
        op3_separator_scan,
        op4_lattice_score,
        op5_chat_format,
        op6_simhash_dedup,
        op7_weak_supervision,
        op8_scaled_sketch,
        op9_vector_packing,
        op10_bitplane_ids,
        op11_block_max_search,
        op12_frequency_trie,
        op13_small_world_search,
    )
}

#: Terms of a text as its contract has them: A-Z alone are lower-cased.
TERMS = r"""unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLES: dict[str, str] = {
    "op11_block_max_search": f"""
WITH
words AS (SELECT doc_id, {TERMS} FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals GROUP BY term
),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {TERMS} FROM benchmark)),
scores AS (
    SELECT item_id, doc_id, sum(
        w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))
    )::BIGINT AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
""",
}
