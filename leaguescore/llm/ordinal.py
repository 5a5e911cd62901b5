"""Quality classifier: ordinal regression with one weight vector and ordered thresholds.

Grades are ordered. A document has one score, the sum of the weights of its hashed features;
the probability of a grade of k or more is the logistic function of the score less threshold
k. The model is fitted on a bounded sample of labelled documents, and applied to all of them
where they are.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import bytes_of, map_arrow, pieces_of

BUCKETS = 1 << 18
LETTERS = re.compile(rb"[a-z\x80-\xff]+")
UPPER = bytes(range(65, 91))
NOT_UPPER = bytes(b for b in range(256) if b not in UPPER)
NOT_SYMBOL = bytes(b for b in range(256) if b not in b"#*$%&|<>")
NOT_SHOUT = bytes(b for b in range(256) if b not in b"!?")


@dataclass(frozen=True)
class Model:
    """Weights of hashed features; thresholds ascending, one fewer than there are grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """Probability of grade 1 or more, 2 or more, ..., a column each."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def level(part: int, whole: int) -> int:
    """A share as a whole number from 0 to 10, finer near zero."""
    return 0 if not part else 1 + int(9 * min(1.0, part / max(1, whole)) ** 0.5)


def feature_buckets(text: bytes) -> np.ndarray:
    """Distinct buckets of a text: its lower-cased words of letters, and its shape.

    The shape is a few shares (capitals, symbols, shouts, repeated and distinct words, doubled
    lines), with a word for each level that a share reaches.
    """
    lowered = text.lower()
    words = LETTERS.findall(lowered)
    distinct = set(words)
    n = len(words)
    lines = text.split(b"\n")
    shape = {
        "upper": level(len(text.translate(None, NOT_UPPER)), len(text)),
        "symbol": level(len(text.translate(None, NOT_SYMBOL)), n),
        "shout": level(len(text.translate(None, NOT_SHOUT)), n),
        "again": level(sum(map(operator.eq, words, words[1:])), n),
        "distinct": level(len(distinct), n),
        "lines": level(len(lines) - len(set(lines)), len(lines)),
        "size": n.bit_length(),
    }
    hashed = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct))
    marks = [
        zlib.crc32(f"\0{name}>={reached}".encode())
        for name, value in shape.items()
        for reached in range(value + 1)
    ]
    return np.unique(np.concatenate([hashed, marks]).astype(np.int64) % BUCKETS)


def graded_sample(
    docs: DataFrame, grades: DataFrame, max_rows: int, key: str, text: str
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Grades and features of at most ``max_rows`` labelled documents, the same every time."""
    chosen = (
        grades.where(F.col("grade").isNotNull() & F.col("label_key").isNotNull())
        .orderBy(F.xxhash64("label_key"), "label_key", "grade")
        .limit(max_rows)
    )
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(
        F.broadcast(chosen), F.col("k") == F.col("label_key")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "t"):
            found = [feature_buckets(t).astype(np.int32) for t in bytes_of(batch, "t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))],
                names=["k", "grade", "found"],
            )

    wanted = rows.select("k", "t", "grade")
    table = map_arrow(wanted, read, "k long, grade int, found array<int>").orderBy("k", "grade")
    arrow = table.limit(max_rows).toArrow()
    column = arrow.column("found").combine_chunks()
    found = [np.asarray(x.values) for x in column]
    return arrow.column("grade").to_numpy().astype(np.int64), found


def gained(seen: np.ndarray, docs: np.ndarray, part: float) -> np.ndarray:
    """Log likelihood that ``seen`` of ``docs`` gain by a share of their own over ``part``."""
    rest = docs - seen
    with np.errstate(divide="ignore", invalid="ignore"):
        hit = np.where(seen > 0, seen * np.log(seen / (docs * part)), 0.0)
        miss = np.where(rest > 0, rest * np.log(rest / (docs * (1 - part))), 0.0)
    return hit + miss


def fit(
    grades: np.ndarray,
    found: list[np.ndarray],
    n_grades: int,
    min_nats: float = 4.0,
    ridge: float = 0.2,
    rounds: int = 300,
) -> Model:
    """Cumulative-link regression by full-batch Adam with a ridge on the weights.

    A feature has a weight if grades are so different with it that a share of its own explains them better than the
    whole sample's by ``min_nats`` in log likelihood. Unlike a count of standard errors, that test holds for a feature of
    three documents as for one of thousands, so there is no floor of documents: rare words of rare
    languages count once they are telling. Without labelled documents the highest grade is certain for all.
    """
    if not len(grades):
        return Model(np.zeros(BUCKETS, np.float32), np.full(n_grades - 1, -50.0))
    columns = np.concatenate(found)
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    docs = np.bincount(columns, minlength=BUCKETS)
    telling = np.zeros(BUCKETS, dtype=bool)
    for grade in range(1, n_grades):  # is the share of higher grades another with the feature?
        higher = grades >= grade
        part = np.clip(higher.mean(), 0.5 / len(found), 1 - 0.5 / len(found))
        seen = np.bincount(columns, weights=higher[rows], minlength=BUCKETS)
        telling |= gained(seen, docs, part) > min_nats
    kept = telling[columns]
    names, columns = np.unique(columns[kept], return_inverse=True)
    rows = rows[kept]
    n, d = len(found), len(names)
    above = np.array([(grades >= k).mean() for k in range(1, n_grades)])
    above = np.clip(above, 0.5 / n, 1 - 0.5 / n)
    start = np.maximum.accumulate(-np.log(above / (1 - above)) + 1e-3 * np.arange(n_grades - 1))
    gaps = np.log(np.maximum(1e-3, np.diff(start)))
    values = np.concatenate([np.zeros(d), start[:1], gaps])
    first, second = np.zeros_like(values), np.zeros_like(values)
    pad = np.array([np.inf])
    for step in range(1, rounds + 1):
        weights, theta = values[:d], thresholds_of(values[d:])
        scores = np.bincount(rows, weights=weights[columns], minlength=n)
        edges = np.concatenate([-pad, theta, pad])
        low = sigmoid(scores - edges[grades])
        high = sigmoid(scores - edges[grades + 1])
        share = np.maximum(low - high, 1e-12)
        by_score = -(1 - low - high)
        by_edge = np.bincount(grades, weights=low * (1 - low) / share, minlength=n_grades + 1)
        by_edge -= np.bincount(grades + 1, weights=high * (1 - high) / share, minlength=n_grades + 1)
        slope = by_edge[1:-1]
        inner = np.cumsum(slope[::-1])[::-1]  # a gap moves all thresholds above it
        grad = np.concatenate(
            [
                np.bincount(columns, weights=by_score[rows], minlength=d) + ridge * weights,
                inner[:1],
                inner[1:] * np.exp(values[d + 1 :]),
            ]
        )
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = 0.05 * (1 - step / (rounds + 1)) + 0.002
        values = values - rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
    weights = np.zeros(BUCKETS, np.float32)
    weights[names] = values[:d]
    return Model(weights, thresholds_of(values[d:]))


def thresholds_of(values: np.ndarray) -> np.ndarray:
    """Ascending thresholds from the first one and the logs of the gaps."""
    return values[0] + np.concatenate([[0.0], np.cumsum(np.exp(values[1:]))])


def apply(
    docs: DataFrame,
    model: Model,
    keep_at: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, carry..., expected_grade, tail_probability, kept)`` of every document.

    The tail is the highest grade; a document is kept if its probability is ``keep_at`` or
    more. A null text is empty. No shuffle.
    """
    names = list(dict.fromkeys([key, text, *carry]))
    out = list(dict.fromkeys([key, *carry]))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in out)

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text):
            scores = np.array(
                [model.weights[feature_buckets(t)].sum(dtype=float) for t in bytes_of(batch, text)]
            )
            above = model.at_least(scores)
            kept = [batch.column(names.index(c)) for c in out]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, -1]),
                    pa.array(above[:, -1] >= keep_at),
                ],
                names=[*out, "expected_grade", "tail_probability", "kept"],
            )

    schema = f"{fields}, expected_grade double, tail_probability double, kept boolean"
    return map_arrow(docs.select(*names), graded, schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from labels: 0 toxic, 1 of low quality, 2 neither.

    Rows that miss what decides the grade have none.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
    known = F.col("toxic").isNotNull() & F.col("quality").isNotNull()
    return labels.select(
        F.col("doc_id").cast("long").alias("label_key"),
        grade.when(known, 2).cast("int").alias("grade"),
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 16_384,
    keep_at: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Fit on at most ``max_rows`` labelled documents, and grade all documents."""
    grades, found = graded_sample(docs, grades_of(labels), max_rows, key, text)
    return apply(docs, fit(grades, found, 3), keep_at, key, text, carry)
