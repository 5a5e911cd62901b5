"""Checks: roster sheets, audits of scored rows, and the published contract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from leaguescore.functions import not_in
from leaguescore.schemas import (
    BONUS_POSITIONS,
    EXTRA_POSITIONS,
    MINIMUM_POSITIONS,
    REPORT_COLUMNS,
    SHEET_MARKS,
    SHEET_ROWS,
)

SHEET_RULES = (
    "length",
    "unique_ids",
    "team_name",
    "cross_unique",
    "min_positions",
    "extra_position",
    "nulls",
)


def codes_seen(code: str) -> Column:
    """One bit for each minimum position code; a fixed-size state for any number of rows."""
    bits = [f"WHEN '{wanted}' THEN {1 << n}" for n, wanted in enumerate(MINIMUM_POSITIONS)]
    return F.expr(f"bit_or(CASE {code} {' '.join(bits)} ELSE 0 END)")


def sheet_facts(sheets: DataFrame) -> DataFrame:
    """What the checks need to know of each sheet, from one pass over the rows.

    Sheets scanned from files have a mark, ``is_row``, that is false where a file has no rows: such a sheet
    has its facts too, with a count of zero. A missing value counts as one more distinct value. Every row is taken
    twice, by its id and by its team name, and grouped by (sheet, value) before the sheet's rows meet, so a sheet of
    any length is spread over tasks. The two groupings are written out here: Spark's own plan for two distinct
    counts puts them in an order that changes from use to use, so that uses of one frame of picks do not share it.
    """
    columns = [c for c in sheets.columns if c not in SHEET_MARKS]
    scanned = "columns_ok" in sheets.columns
    is_row = F.col("is_row") if "is_row" in sheets.columns else F.lit(True)
    any_null = F.expr(" OR ".join(f"`{name}` IS NULL" for name in columns))
    by_name, real = F.col("_by_name"), F.col("_rows") > 0

    def among(condition: Column) -> Column:
        return F.count_if(~by_name & is_row & condition)

    both = sheets.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_by_name"))
    values = both.groupBy(
        "sheet",
        "_by_name",
        F.when(~by_name, F.col("player_id")).alias("_id"),
        F.when(by_name, F.col("fantasy_team")).alias("_name"),
    ).agg(
        F.count_if(is_row).alias("_rows"),
        F.count_if(F.col("roster_index") == 2).alias("_second"),
        codes_seen("position_code").alias("codes"),
        among(not_in(F.col("position_code"), MINIMUM_POSITIONS)).alias("n_extra"),
        among(not_in(F.col("position_code"), MINIMUM_POSITIONS + EXTRA_POSITIONS)).alias("n_foreign"),
        among(any_null).alias("n_null"),
        *([F.bool_and("columns_ok").alias("columns")] if scanned else []),
    )
    return values.groupBy("sheet").agg(
        F.sum(F.when(by_name, 0).otherwise(F.col("_rows"))).alias("n_rows"),
        F.count_if(~by_name & real).alias("n_ids"),
        F.count_if(by_name & real).alias("n_names"),
        F.coalesce(F.min(F.when(F.col("_second") > 0, F.col("_name"))), F.min("_name")).alias("team_name"),
        F.bit_or("codes").alias("codes"),
        *[F.sum(name).alias(name) for name in ("n_extra", "n_foreign", "n_null")],
        *([F.bool_and("columns").alias("columns")] if scanned else []),
    )


def length_ok() -> Column:
    return F.col("n_rows") == SHEET_ROWS


def unique_ids_ok() -> Column:
    return F.col("n_ids") == F.col("n_rows")


def team_name_ok(strict: bool = False) -> Column:
    """The team name repeats within the sheet; strictly, it is the same on every row."""
    return F.col("n_names") == 1 if strict else F.col("n_names") < F.col("n_rows")


def min_positions_ok() -> Column:
    return F.col("codes") == (1 << len(MINIMUM_POSITIONS)) - 1


def extra_position_ok() -> Column:
    return (F.col("n_extra") == 1) & (F.col("n_foreign") == 0)


def nulls_ok() -> Column:
    return F.col("n_null") == 0


def with_cross_unique(facts: DataFrame) -> DataFrame:
    """Add ``cross_unique``: no other sheet has the sheet's team name.

    Names are counted by an aggregate and joined back; rows of one name are
    never gathered.
    """
    shared = facts.groupBy("team_name").agg(F.count(F.lit(1)).alias("n_sheets"))
    return facts.join(shared.where("n_sheets > 1"), "team_name", "left").withColumn(
        "cross_unique", F.col("n_sheets").isNull()
    )


def own_verdicts(facts: DataFrame, strict: bool = False) -> dict[str, Column]:
    """The rules that a sheet's own facts decide."""
    return {
        "length": length_ok(),
        "unique_ids": unique_ids_ok(),
        "team_name": team_name_ok(strict),
        "min_positions": min_positions_ok(),
        "extra_position": extra_position_ok(),
        "nulls": nulls_ok(),
        **{c: F.col(c) for c in ("columns",) if c in facts.columns},
    }


def sheet_verdicts(sheets: DataFrame, strict: bool = False) -> DataFrame:
    """One row per sheet, one boolean per rule; ``columns`` if the sheets were scanned from files."""
    facts = sheet_facts(sheets)
    own = own_verdicts(facts, strict)
    rules = [r for r in (*SHEET_RULES, "columns") if r in own or r == "cross_unique"]
    return with_cross_unique(facts).select(
        "sheet", *[own[r].alias(r) if r in own else F.col(r) for r in rules]
    )


def valid_sheets(sheets: DataFrame, strict: bool = False) -> DataFrame:
    """``sheet``: those that meet every rule, from one pass over the sheets.

    A team name that is on one sheet only has its own sheet's facts in its group, so the group decides for
    that sheet, and no sheet is joined back. A missing team name is shared with no other sheet.
    """
    facts = sheet_facts(sheets)
    good = reduce(lambda a, b: a & b, own_verdicts(facts, strict).values())
    alone = F.when(F.col("team_name").isNull(), F.col("sheet")).alias("unnamed")
    names = facts.select("sheet", "team_name", alone, F.coalesce(good, F.lit(False)).alias("good"))
    grouped = names.groupBy("team_name", "unnamed").agg(
        F.count(F.lit(1)).alias("n_sheets"),
        F.any_value("sheet").alias("sheet"),
        F.bool_and("good").alias("good"),
    )
    return grouped.where("n_sheets = 1 AND good").select("sheet")


def rules_of(verdicts: DataFrame) -> list[str]:
    return [c for c in verdicts.columns if c != "sheet"]


def sheet_violations(sheets: DataFrame, strict: bool = False) -> DataFrame:
    """One row per sheet and rule: ``(sheet, rule, ok)``."""
    verdicts = sheet_verdicts(sheets, strict)
    return verdicts.unpivot(["sheet"], rules_of(verdicts), "rule", "ok")


#: What is worth a warning, as conditions on rows.
CONDITIONS = {
    "traded": "subsequently_traded",
    "without_player": "player_name IS NULL",
    "out_of_scope": "position IS NULL OR position NOT IN ({})".format(
        ", ".join(f"'{p}'" for p in BONUS_POSITIONS)
    ),
    "unscored": "fantasy_points IS NULL",
}

#: The conditions that mean something for each source of rows.
AUDITS = {
    "offense": ("traded", "without_player"),
    "kicking": ("traded", "without_player"),
    "player_bonus": ("traded", "without_player", "out_of_scope"),
    "points_allowed": ("unscored",),
}


def audit_columns(source: str, copies: int = 1) -> list[Column]:
    """Counts of a source's conditions; a wide row counts ``copies`` times, once per stat."""
    return [
        (F.expr(f"count_if({CONDITIONS[name]})") * F.lit(copies).cast("bigint")).alias(name)
        for name in AUDITS[source]
    ]


def audit_counts(rows: DataFrame, source: str, copies: int = 1) -> DataFrame:
    """One row: the source and its counts."""
    counts = rows.agg(*audit_columns(source, copies))
    return counts.select(F.lit(source).alias("source"), "*")


def audited(
    rows: DataFrame, source: str, seen: Observation | None, copies: int = 1
) -> DataFrame:
    """The same rows, counted into ``seen`` by the job that first uses them: no second pass."""
    return rows if seen is None else rows.observe(seen, *audit_columns(source, copies))


def new_audits() -> dict[str, Observation]:
    """An observation for each source, to be filled by one run."""
    return {source: Observation(source) for source in AUDITS}


def null_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def contract_violations(
    report: DataFrame, columns: Sequence[str] = REPORT_COLUMNS
) -> DataFrame:
    """Missing values per column that must have none, in one aggregation."""
    counts = report.agg(*null_counts(columns))
    return counts.unpivot([], list(columns), "column_name", "null_count")
