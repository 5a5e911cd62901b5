"""Timestamped snapshots, named ``<handle>, <timestamp>.<extension>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME_PATTERN = r"^(.*), (.*)\.[^.]*$"

#: Newest names that are held on the driver and sent to every task; more are joined by a shuffle.
HELD_NAMES = 10_000

#: Newest names that a scan is asked for by value, so that it can pass over other row groups.
PUSHED_NAMES = 200


def named_snapshots(df: DataFrame, file_col: str) -> DataFrame:
    """Add ``handle`` and ``snapshot_ts``; rows of files named otherwise are left out."""
    return df.where(F.col(file_col).rlike(NAME_PATTERN)).withColumns(
        {
            "handle": F.regexp_extract(file_col, NAME_PATTERN, 1),
            "snapshot_ts": F.regexp_extract(file_col, NAME_PATTERN, 2),
        }
    )


def snapshot_names(df: DataFrame, file_col: str) -> DataFrame:
    """``(name, handle, snapshot_ts)``, once for each file name.

    The name is made to depend on the count of its rows, so that the optimizer cannot move the
    patterns below the aggregate and apply them to every row.
    """
    counted = df.groupBy(F.col(file_col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return named_snapshots(counted.select(F.when(F.col("n") > 0, F.col("name")).alias("name")), "name")


def snapshot_manifest(df: DataFrame, file_col: str) -> DataFrame:
    """Newest timestamp of every handle; timestamps order as text."""
    return snapshot_names(df, file_col).groupBy("handle").agg(
        F.max("snapshot_ts").alias("snapshot_ts")
    )


def newest_names(df: DataFrame, file_col: str) -> DataFrame:
    """``(name, handle, snapshot_ts)`` of the newest snapshot of each handle, with all its extensions."""
    stamped = snapshot_names(df, file_col).groupBy("handle", "snapshot_ts").agg(
        F.collect_list("name").alias("names")  # one for each extension
    )
    newest = stamped.groupBy("handle").agg(F.max(F.struct("snapshot_ts", "names")).alias("newest"))
    return newest.select(F.explode("newest.names").alias("name"), "handle", "newest.snapshot_ts")


def latest_snapshot(df: DataFrame, file_col: str) -> DataFrame:
    """Rows of the newest snapshot of each handle.

    The names are settled first, in a job of their own that reads the name column only: they are taken apart
    once each, and the newest of each handle is the maximum of one aggregate. The rows are then read
    once and joined to those names, as values that the optimizer cannot compute anew. A window per handle
    would sort all rows of a handle in one task. Over ``HELD_NAMES`` newest names are not held on the driver but
    joined by a shuffle.
    """
    spark, newest = df.sparkSession, newest_names(df, file_col)
    held = newest.limit(HELD_NAMES + 1).toArrow()
    if held.num_rows > HELD_NAMES:
        rows, names = df, newest.hint("merge")
    else:
        names = F.broadcast(spark.createDataFrame(held))
        rows = df
        if held.num_rows <= PUSHED_NAMES:
            rows = df.where(F.col(file_col).isin(held.column("name").to_pylist()))
    return rows.join(names, F.col(file_col) == F.col("name")).select(*df.columns, "handle", "snapshot_ts")


def snapshot_freshness(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Per remote handle: is there a local copy, and is its timestamp another one?

    A handle without a local copy is not stale, as there is nothing to replace.
    """
    remote_side = remote.select("handle", F.col("snapshot_ts").alias("remote_ts"))
    local_side = local.select("handle", F.col("snapshot_ts").alias("local_ts"))
    return remote_side.join(local_side, "handle", "left").withColumn(
        "is_stale",
        F.col("local_ts").isNotNull() & ~F.col("local_ts").eqNullSafe(F.col("remote_ts")),
    )


def list_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Files and folders of a folder as (path, file_name); their contents are not read.

    The listing comes from the folder's own file system, names as they are. It has a row for
    each snapshot. What Spark's writers leave beside their data is left out.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath() for status in store.listStatus(place)]
    names = [(str(p.toString()), str(p.getName())) for p in found]
    kept = [row for row in names if not row[1].startswith(("_", "."))]
    return spark.createDataFrame(kept, "path string, file_name string")


def read_latest(spark: SparkSession, folder: str, handle: str) -> DataFrame:
    """Open the newest parquet snapshot of one handle, a file or a folder; older ones are not read."""
    files = named_snapshots(list_snapshots(spark, folder), "file_name")
    newest = (
        files.where((F.col("handle") == handle) & F.col("file_name").endswith(".parquet"))
        .agg(F.max_by("path", "snapshot_ts").alias("path"))
        .first()["path"]
    )
    if newest is None:
        raise FileNotFoundError(f"no snapshot of {handle} in {folder}")
    return spark.read.parquet(newest)
