"""Parquet and CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: text that stands for a missing value in CSV input ---------

MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)

# --- end of fixed values -----------------------------------------------------


def scan_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Scan a parquet file, folder or table path; only the named columns, if any."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def markers_to_null(df: DataFrame) -> DataFrame:
    """Null for every text that marks a missing value."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {
            name: F.when(~F.col(f"`{name}`").isin(*MISSING_MARKERS), F.col(f"`{name}`"))
            for name in texts
        }
    )


def read_texts(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    header: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header, every column as text, missing markers as null.

    Quotes within quoted text are doubled, as spreadsheets write them. With ``multi_line``
    quoted text may have line breaks; a file is then one task. All files must have the
    header of the first one; another header fails rather than putting values into the
    wrong columns. A ``header`` that is known already is not read for a start.
    """
    dialect = {"header": True, "enforceSchema": False, "escape": '"', "multiLine": multi_line}
    reader = spark.read.options(**{**dialect, **options})
    if header:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
    return markers_to_null(reader.csv(path))


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """The columns of a declared schema, found in the header by name; others are not kept."""
    texts = read_texts(spark, path, multi_line, **options)
    return texts.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
    )
