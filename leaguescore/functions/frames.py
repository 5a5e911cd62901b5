"""Small frame-in, frame-out steps shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguescore.functions.columns import recode
from leaguescore.schemas import SEASON_LABELS


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float column.

    Spark sorts NaN above all numbers, so ``NaN >= 40`` would hold; as null it does not.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns(
        {name: F.when(~F.isnan(f"`{name}`"), F.col(f"`{name}`")) for name in floats}
    )


def in_seasons(df: DataFrame, seasons: Iterable[str]) -> DataFrame:
    """Keep the wanted season types and give them their long labels.

    The filter is on the stored codes, ahead of the recode, so it reaches the
    parquet scan (and prunes partitions where the table is partitioned by it).
    """
    wanted = list(seasons)
    stored = [code for code, label in SEASON_LABELS.items() if label in wanted]
    stored += [label for label in wanted if label not in SEASON_LABELS]
    return df.where(F.col("season_type").isin(stored)).withColumn(
        "season_type", recode(F.col("season_type"), SEASON_LABELS)
    )


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()}
    )


def rename_checked(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Rename by position, after checking that the header is the expected one, in order."""
    if df.columns != list(headers):
        raise ValueError(f"unexpected header {df.columns}, wanted {list(headers)}")
    return df.toDF(*headers.values())
