"""What the operators share: session settings, stored tables, ranges of keys, Arrow helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, as in tests on one machine, a temporary folder is made and set; on a
    cluster, where executors would not find it, that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='leaguescore-')}")
            folder = context.getCheckpointDir()
    return folder


#: Folders made within ``own_tables``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Folders of the shared folder that are made within are removed at its end, and no others.

    Whatever is to last must have been written elsewhere by then: frames made within read these folders.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for folder in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: the plan starts anew there.

    Unlike a local checkpoint it outlives every executor, and scans read only
    the columns that they need. Writers and readers hold a group of rows at a time, which parquet
    measures from the hundredth row on only; tables of rows of megabytes give its ``group_rows``.
    """
    path = new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """What is run within hands Python batches of about ``size`` bytes, one row at least, for Spark's 64 MB.

    Both sides hold a batch or two, and Spark's buffers double as they fill. Any size gives the same rows.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def share_package(spark: SparkSession) -> None:
    """Let workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package from where the driver has it."""
    share_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def pieces_of(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of a text column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = batch.column(batch.schema.get_field_index(column)).nbytes
        step = max(1, int(batch.num_rows * limit / max(limit, total)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def merged(batches: Iterator[pa.RecordBatch], rows: int = 80_000) -> Iterator[pa.Table]:
    """The same rows in tables of about so many rows, where a call on few costs as much."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as a list; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8; null is the empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [t or b"" for t in values.to_pylist()]


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_starts(df: DataFrame, key: str, n: int) -> list:
    """Ascending keys that start about equal ranges of rows, the smallest key first.

    At most ``n`` keys of the table; none if it has no key that is not null. One
    aggregate that reads the key column only.
    """
    shares = [i / n for i in range(1, n)] or [0.5]
    found = df.agg(
        F.min(key).alias("least"),
        F.percentile_approx(key, shares, max(10_000, 10 * n)).alias("starts"),
    ).first()
    if found["least"] is None:
        return []
    starts = found["starts"] if n > 1 else []
    return [found["least"], *sorted({s for s in starts if s != found["least"]})]


def range_of(key: Column, starts: list) -> Column:
    """Number of the range that a key is in, by binary search; null keys are in the last one."""
    last = max(0, len(starts) - 1)
    if not last:
        return F.lit(0)
    table = F.array(*[F.lit(s) for s in starts[1:]])

    def halve(span: Column, _: Column) -> Column:
        middle = ((span["low"] + span["high"]) / 2).cast("int")
        right = (span["low"] < span["high"]) & (F.try_element_at(table, middle + 1) <= key)
        left = (span["low"] < span["high"]) & ~right
        return F.struct(
            F.when(right, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(left, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.array(*[F.lit(i) for i in range(last.bit_length() + 1)])
    whole = F.struct(F.lit(0).alias("low"), F.lit(last).alias("high"))
    found = F.aggregate(steps, whole, halve)["low"]
    return F.when(key.isNull(), F.lit(last)).otherwise(found)


@dataclass(frozen=True)
class Cuts:
    """Rows of a table that start about equal ranges of it, by key (null last), then a hash of the text.

    ``rows`` are ``(is_null, key, hash)``, ascending; the first is the table's first row.
    """

    rows: list[tuple[bool, object, int]]
    key: str
    text: str
    kind: str = "long"

    def place(self) -> Column:
        """Where a row is in the order: a struct that compares as the cuts do."""
        key, any_key = F.col(self.key), F.lit(self.rows[0][1] if self.rows else None)
        return F.struct(
            key.isNull().alias("is_null"),
            F.coalesce(key, any_key.cast(self.kind)).alias("key"),
            text_hash(F.col(self.text)).alias("hash"),
        )

    def may_start(self) -> Column:
        """Can a row be one of the cuts, by its key alone? A scan can pass over others."""
        keys = [k for is_null, k, _ in self.rows if not is_null]
        return F.col(self.key).isin(keys) | F.col(self.key).isNull()

    def table(self) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(is_null).alias("is_null"),
                    F.lit(key).cast(self.kind).alias("key"),
                    F.lit(hashed).cast("long").alias("hash"),
                )
                for is_null, key, hashed in self.rows
            ]
        )

    def number(self, place: Column) -> Column:
        """Number of the range that a place is in, by binary search."""
        last = len(self.rows) - 1
        if last < 1:
            return F.lit(0)
        table = self.table()

        def halve(span: Column, _: Column) -> Column:
            middle = F.ceil((span["low"] + span["high"]) / 2).cast("int")
            right = F.get(table, middle) <= place
            return F.struct(
                F.when(right, middle).otherwise(span["low"]).alias("low"),
                F.when(right, span["high"]).otherwise(F.greatest(span["low"], middle - 1)).alias("high"),
            )

        steps = F.array(*[F.lit(i) for i in range(last.bit_length() + 1)])
        whole = F.struct(F.lit(0).alias("low"), F.lit(last).alias("high"))
        return F.aggregate(steps, whole, halve)["low"]


def text_hash(text: Column) -> Column:
    """52 bits: quantiles are doubles, which hold them exactly."""
    return F.shiftright(F.xxhash64(F.coalesce(text, F.lit(""))), 12)


def row_cuts(df: DataFrame, key: str, text: str, n: int) -> Cuts:
    """Cuts of a table into about ``n`` ranges, at most twice as many, that also divide the rows of one key.

    A key that is several of the table's quantiles holds as many shares of it; its rows are cut at quantiles
    of their texts' hash, and so are rows without a key. One pass reads the key column, a second one the rows of those
    keys. Only rows alike in key and text stay together. The driver holds the cuts.
    """
    kind = df.schema[key].dataType.simpleString()
    shares = [i / n for i in range(1, n)] or [0.5]
    found = df.agg(
        F.min(key).alias("least"),
        F.percentile_approx(key, shares, max(10_000, 10 * n)).alias("starts"),
        F.count(F.lit(1)).alias("rows"),
        F.count(key).alias("known"),
    ).first()
    if not found["rows"]:
        return Cuts([], key, text, kind)
    parts = Counter((found["starts"] or []) if n > 1 else [])
    if found["least"] is not None:
        parts[found["least"]] += 1
    missing = found["rows"] - found["known"]
    if missing:
        parts[None] = max(1, round(n * missing / found["rows"]))
    least = found["least"]
    names = [k for k in parts if k is not None]
    some = df.where(F.col(key).isin(names) | F.col(key).isNull()) if names else df.where(F.col(key).isNull())
    hashed = some.select(F.col(key).alias("k"), text_hash(F.col(text)).alias("h"))
    firsts = {r["k"]: r["h"] for r in hashed.groupBy("k").agg(F.min("h").alias("h")).collect()}
    rows = {(k is None, least if k is None else k, h) for k, h in firsts.items()}
    hot = {k: m for k, m in parts.items() if m > 1}
    if hot:
        most = max(hot.values())
        wanted = F.col("k").isin([k for k in hot if k is not None])
        wanted = (wanted | F.col("k").isNull()) if None in hot else wanted
        cuts = F.percentile_approx("h", [i / most for i in range(1, most)], max(10_000, 10 * most))
        for r in hashed.where(wanted).groupBy("k").agg(cuts.alias("cuts")).collect():
            k, m = r["k"], hot[r["k"]]
            at = [r["cuts"][round(j * most / m) - 1] for j in range(1, m)]
            rows |= {(k is None, least if k is None else k, h) for h in at}
    if least is None:  # no key at all: any value stands for the missing ones
        rows = {(True, 0, h) for _, _, h in rows}
    return Cuts(sorted(rows), key, text, kind)
