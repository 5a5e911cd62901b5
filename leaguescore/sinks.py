"""Files and published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leaguescore.operators.quality import contract_violations, null_counts
from leaguescore.schemas import PICK_HEADERS, PUBLISHED_TYPES, REPORT_COLUMNS


class ContractViolation(ValueError):
    """A column of the published table would hold missing values."""


#: Quotes are doubled and blanks kept, as other programs read and write them.
CSV_DIALECT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_parquet(df: DataFrame, base: str, run_ts: str) -> str:
    """Write one run under its own timestamp; an existing run is never overwritten."""
    path = f"{base}/run_ts={run_ts}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_csv(df: DataFrame, base: str, run_ts: str) -> str:
    path = f"{base}/run_ts={run_ts}"
    df.write.mode("errorifexists").options(**CSV_DIALECT).csv(path)
    return path


def write_picks(picks: DataFrame, base: str, run_ts: str) -> str:
    """Write consolidated rosters under the headers of the sheets."""
    headed = picks.select(*[F.col(n).alias(h) for h, n in PICK_HEADERS.items()])
    return write_csv(headed, base, run_ts)


def published(report: DataFrame) -> DataFrame:
    """The report in the types of the published table; a fraction that has no place there fails."""
    return report.select(
        *[published_value(c).alias(c) if c in PUBLISHED_TYPES else F.col(c) for c in REPORT_COLUMNS]
    )


def published_value(name: str) -> Column:
    value = F.col(name).cast(PUBLISHED_TYPES[name])
    if PUBLISHED_TYPES[name] != "int":
        return value
    cut = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), F.col(name)))
    return F.when(F.col(name).isNull() | (value == F.col(name)), value).otherwise(cut)


def check_counts(counts: dict[str, int]) -> None:
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ContractViolation(", ".join(f"{name}: {n}" for name, n in broken.items()))


def check_contract(report: DataFrame) -> None:
    """Fail when a published column has missing values. At most 18 counts reach the driver."""
    rows = contract_violations(report).collect()
    check_counts({row["column_name"]: row["null_count"] for row in rows})


def staging_name(table: str) -> str:
    """A name beside the table's that no other publish has, and no user would choose."""
    quote = "`" if table.endswith("`") else ""
    return f"{table.removesuffix('`')}__staging_{uuid.uuid4().hex}{quote}"


def publish(
    report: DataFrame,
    table: str,
    mode: str = "overwrite",
    enforce_not_null: bool = False,
    source: str | None = None,
    **options: str,
) -> None:
    """Replace (``overwrite``) or extend (``append``) the published table.

    ``enforce_not_null`` runs the report once, into a staging table of a name of its own, counts missing values
    in that same run, and publishes from there, or nothing if one is missing. The staging table is created here or
    the publish fails; only a table created here is dropped, so no table of a user or of another publish at the
    same time can be. A driver that dies on the way leaves it behind. Rows go in as a batch from all tasks.
    ``source="jdbc"`` with its options writes to a database in place of the catalog.
    """
    if enforce_not_null:
        staging, missing = staging_name(table), Observation()
        spark = report.sparkSession
        counted = report.select(*REPORT_COLUMNS).observe(missing, *null_counts(REPORT_COLUMNS))
        if spark.catalog.tableExists(staging):
            raise ValueError(f"{staging} is there already")
        try:
            counted.write.mode("errorifexists").saveAsTable(staging)
            check_counts(missing.get)
            publish(spark.table(staging), table, mode, source=source, **options)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {staging}")
        return
    writer = published(report).write.mode(mode).options(**options)
    if source == "jdbc":
        writer.format("jdbc").option("dbtable", table).save()
    else:
        (writer.format(source) if source else writer).saveAsTable(table)


def read_published(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
