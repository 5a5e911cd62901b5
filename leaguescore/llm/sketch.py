"""Threshold-scaled document sketches: every shingle hash below a fixed fraction.

A sketch keeps the hashes of a document's shingles up to ``2**64 / scale``. Two sketches hold
the same part of the hash space whatever their documents' sizes, so what they share estimates
containment even between a page and a book, and the sketch of a union is the union of sketches.
The fraction is one that short documents bear: of twenty shingles, three in a thousand documents have none
below a quarter. Such a document keeps its smallest hash, which is then a threshold of its own; two sketches are
held against each other up to the smaller of their thresholds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import (
    map_arrow,
    partition_count,
    pieces_of,
    row_cuts,
)

MIX = np.uint64(0x9E3779B97F4A7C15)
TOP = (1 << 64) - 1


@dataclass(frozen=True)
class Scale:
    """``width`` words a shingle; one in ``scale`` hashes kept."""

    width: int = 5
    scale: int = 4

    def threshold(self) -> int:
        return TOP // self.scale


@dataclass(frozen=True)
class Sketch:
    """Ascending hashes, and the largest value that would have been kept."""

    hashes: np.ndarray
    threshold: int

    def digits(self) -> str:
        """The hashes as hexadecimal digits, 16 each; equal documents have equal digits."""
        return self.hashes.astype(">u8").tobytes().hex()


def sketch_from(hashes: np.ndarray, how: Scale) -> Sketch:
    """Sketch of ascending distinct hashes that hold all up to the threshold, and the smallest of all, at least."""
    n = int(np.searchsorted(hashes, np.uint64(how.threshold()), side="right"))
    return sketch_of_kept(hashes[: max(1, n)], how)


def sketch_of_kept(hashes: np.ndarray, how: Scale) -> Sketch:
    """The threshold follows from what was kept; a document without shingles holds all there is."""
    if not len(hashes):
        return Sketch(hashes, TOP)
    return Sketch(hashes, max(how.threshold(), int(hashes[-1])))


def read_sketch(digits: str, how: Scale) -> Sketch:
    """A sketch from its digits: the one that they were made of."""
    return sketch_of_kept(np.frombuffer(bytes.fromhex(digits), dtype=">u8").astype(np.uint64), how)


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of both documents' shingles together."""
    threshold = min(a.threshold, b.threshold)
    both = np.union1d(a.hashes, b.hashes)
    return Sketch(both[both <= np.uint64(threshold)], threshold)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles of lower-cased (A-Z) words; no words: none."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(width, len(own))
    mixed = np.zeros(len(own) - size + 1, dtype=np.uint64)
    for k in range(size):
        mixed = (mixed ^ own[k : k + len(mixed)]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def sketch_of(text: str, how: Scale) -> Sketch:
    return sketch_from(shingle_hashes(text, how.width), how)


def shared(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Hashes of a, of b and of both below the smaller threshold."""
    low = np.uint64(min(a.threshold, b.threshold))
    x = a.hashes[: np.searchsorted(a.hashes, low, side="right")]
    y = b.hashes[: np.searchsorted(b.hashes, low, side="right")]
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated part of a's shingles that b has; 1 if a has none."""
    n, _, both = shared(a, b)
    return both / n if n else 1.0


def likeness(a: Sketch, b: Sketch) -> float:
    """The larger of both containments; two documents without words are alike, one is not."""
    n, m, both = shared(a, b)
    if not n or not m:
        return float(n == m)
    return both / min(n, m)


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def sketches(
    docs: DataFrame, how: Scale = Scale(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, fingerprint)`` of every document; a null text is empty."""
    kind = docs.schema[key].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text):
            digits = [sketch_of(t or "", how).digits() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digits, pa.string())], names=[key, "fingerprint"]
            )

    return map_arrow(docs.select(key, text), made, f"`{key}` {kind}, fingerprint string")


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents in ascending key order within ranges, each range closed by the next one's first.

    Columns ``range``, ``is_context``, ``k``, ``t``. Rows of one key are in the order of a hash of their texts, so
    they can be in several ranges. The context row of a range is the first document of the next, of the last range that of
    the first. Ranges start at rows of the table, so these are found by their key and hash, and one copy of each is sent.
    """
    n = partition_count(docs.sparkSession)
    cuts = row_cuts(docs, key, text, n)

    def placed(some: DataFrame) -> DataFrame:
        text_or_empty = F.coalesce(F.col(text), F.lit("")).alias("t")
        rows = some.select(cuts.place().alias("at"), F.col(key).alias("k"), text_or_empty)
        return rows.select(cuts.number(F.col("at")).alias("range"), F.lit(False).alias("is_context"), "at", "k", "t")

    rows = placed(docs)
    if cuts.rows:
        starts = F.get(cuts.table(), F.col("range"))
        before = F.pmod(F.col("range") - 1, F.lit(len(cuts.rows))).alias("range")
        first = placed(docs.where(cuts.may_start())).where(F.col("at") == starts).dropDuplicates(["range"])
        rows = rows.union(first.select(before, F.lit(True), "at", "k", "t"))
    return (
        rows.select("range", "is_context", "k", F.col("at.hash").alias("h"), "t")
        .repartition(n, "range")
        .sortWithinPartitions("range", "is_context", F.col("k").asc_nulls_last(), "h", "t")
        .select("range", "is_context", "k", "t")
    )


def compare_edited(
    docs: DataFrame, how: Scale = Scale(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Sketch every document and its text as edited with the next document's beginning.

    One row per document: ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The next document has the next higher key, after the last one
    comes the first. Rows of one key are ordered by a hash of their texts, rows with null keys come last. A null text is empty.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (range, key, text, sketch) of a document whose next is to come

        def row(document: tuple, following: str, next_sketch: Sketch) -> tuple:
            _, k, t, own = document
            changed = edited(t, following)
            other = sketch_of(changed, how)
            return (
                k,
                len(t),
                hashlib.sha256(changed.encode()).hexdigest(),
                own.digits(),
                other.digits(),
                likeness(own, other),
                likeness(own, next_sketch),
            )

        def batch_of(rows: list[tuple], like: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            kinds = [like, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[*names, "near_edited", "near_next"],
            )

        like = None
        for batch in pieces_of(batches, "t"):
            out, like = [], batch.column(2).type
            for number, is_context, k, t in zip(*[c.to_pylist() for c in batch.columns]):
                own = sketch_of(t, how)
                if waiting and waiting[0] == number:
                    out.append(row(waiting, t, own))
                elif waiting:
                    out.append(row(waiting, "", sketch_of("", how)))
                waiting = None if is_context else (number, k, t, own)
            yield batch_of(out, like)
        if waiting:
            yield batch_of([row(waiting, "", sketch_of("", how))], like)

    schema = (
        f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_arrow(with_next(docs, key, text), compared, schema)
