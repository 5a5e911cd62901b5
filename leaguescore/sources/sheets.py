"""Roster sheets: a folder of CSV files, one per fantasy team."""

from __future__ import annotations

import csv
from functools import reduce
from io import StringIO
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguescore.functions import rename_checked
from leaguescore.schemas import PICK_HEADERS, SHEET_HEADERS, SHEET_MARKS, SHEET_TYPES
from leaguescore.sources.scans import read_texts


#: The first record of a file, which may have line breaks within quotes.
HEADER = r'^\x{FEFF}?((?:"(?:[^"]|"")*"|[^"\r\n])*)'


def sheet_name(file_name: Column) -> Column:
    """A file's name from its URL form, where a plus sign is a plus sign."""
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def literally(text: str) -> str:
    """A text as a pattern of paths that matches nothing else."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in text)


def sheet_inventory(spark: SparkSession, folder: str, token: str) -> DataFrame:
    """``(sheet, path, n_bytes)`` of every sheet file by the folder's listing; no file is opened.

    So files are there that have no row to be read, or nothing at all: Spark's scans pass over files
    without a byte, whatever the format. The listing is the folder's own file system's.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in store.listStatus(place) if s.isFile()]
    named = [(str(s.getPath().getName()), str(s.getPath().toString()), int(s.getLen())) for s in found]
    wanted = [f for f in named if f[0].endswith(".csv") and token in f[0][:-4] and f[0][0] not in "._"]
    return spark.createDataFrame(wanted, "sheet string, path string, n_bytes long")


def wanted_files(token: str) -> dict[str, str]:
    return {"pathGlobFilter": f"*{literally(token)}*.csv"}


def scan_sheets(spark: SparkSession, folder: str, token: str) -> DataFrame:
    """All ``.csv`` files of a folder whose name holds the season token, as text.

    Files are selected while listing, so others are never opened. Each is read by its own
    header, so their columns may come in different orders. The inventory of files is left-joined
    to their rows: a file without rows is there once, without values and with ``is_row`` false, be it
    empty or only a header, and so is a file whose columns are not those of a sheet, with ``columns_ok`` false.
    It does not keep the others from being read. ``sheet`` is the file name.
    """
    whole = spark.read.options(**wanted_files(token)).text(folder, wholetext=True)
    heads = whole.select(
        F.regexp_extract("value", HEADER, 1).alias("header"), F.col("_metadata.file_path").alias("path")
    ).groupBy("header")
    frames, good = [], []
    for row in heads.agg(F.collect_list("path").alias("paths")).collect():  # one per sheet file
        columns = next(csv.reader(StringIO(row["header"], newline="")), [])
        if sorted(columns) != sorted(SHEET_HEADERS):
            continue
        paths = [literally(unquote(path)) for path in row["paths"]]
        good += [path.rpartition("/")[2] for path in row["paths"]]
        rows = read_texts(spark, paths, multi_line=True, header=columns)
        frames.append(
            rows.select(
                sheet_name(F.col("_metadata.file_name")).alias("sheet"),
                *[F.col(f"`{h}`") for h in SHEET_HEADERS],
                F.lit(True).alias("is_row"),
            )
        )
    files = sheet_inventory(spark, folder, token).select("sheet")
    if not frames:
        none = [F.lit(None).cast("string").alias(h) for h in SHEET_HEADERS]
        return files.select(*none, F.lit(False).alias("columns_ok"), F.lit(False).alias("is_row"), "sheet")
    names = spark.createDataFrame([(name,) for name in good], "name string")
    named = names.select(sheet_name(F.col("name")).alias("sheet"), F.lit(True).alias("columns_ok"))
    known = files.join(named, "sheet", "left")
    return known.join(reduce(DataFrame.unionByName, frames), "sheet", "left").select(
        *[F.col(f"`{h}`") for h in SHEET_HEADERS],
        F.coalesce("columns_ok", F.lit(False)).alias("columns_ok"),
        F.coalesce("is_row", F.lit(False)).alias("is_row"),
        "sheet",
    )


def check_sheet_columns(columns: list[str]) -> None:
    """A sheet has 12 columns and all of them are known ones, in any order."""
    if len(columns) != len(SHEET_HEADERS):
        raise ValueError(f"a sheet has {len(SHEET_HEADERS)} columns, not {len(columns)}")
    unknown = [c for c in columns if c not in SHEET_HEADERS]
    if unknown:
        raise ValueError(f"unknown sheet columns: {unknown}")


def sheets_from_headers(df: DataFrame, key: str = "sheet") -> DataFrame:
    """Check the columns of scanned sheets, and give them the report's names and types.

    Text that does not fit its type becomes missing, which the null check reports.
    """
    marks = [c for c in df.columns if c in {key, *SHEET_MARKS}]
    check_sheet_columns([c for c in df.columns if c not in marks])
    return df.select(
        *marks,
        *[
            F.col(f"`{header}`").try_cast(SHEET_TYPES.get(name, "string")).alias(name)
            for header, name in SHEET_HEADERS.items()
        ],
    )


def read_picks(spark: SparkSession, path: str) -> DataFrame:
    """Read consolidated rosters back, checking the header before renaming."""
    picks = rename_checked(read_texts(spark, path), PICK_HEADERS)
    return picks.withColumn("roster_index", F.col("roster_index").cast("int"))
