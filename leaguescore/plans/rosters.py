"""Roster consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.functions import short_owner
from leaguescore.operators.joins import Dimension, measured
from leaguescore.operators.quality import sheet_violations, valid_sheets
from leaguescore.schemas import PICK_COLUMNS


#: Violations that an error names.
SHOWN = 20


class SheetViolation(ValueError):
    """At least one roster sheet breaks a rule."""


def drop_personal(sheets: DataFrame) -> DataFrame:
    """Drop the email and the sheet's helper columns, by keeping the others."""
    return sheets.select(*PICK_COLUMNS)


def consolidate(sheets: DataFrame, on_violation: str = "raise", strict: bool = False) -> DataFrame:
    """One table of picks from all roster sheets.

    ``on_violation="raise"`` stops when any sheet breaks a rule; the error counts the violations
    and names some of them, ``sheet_violations`` lists all. ``"drop"`` leaves such sheets out.
    """
    if on_violation not in ("raise", "drop"):
        raise ValueError(f"on_violation is raise or drop, not {on_violation}")
    if on_violation == "raise":
        broken = sheet_violations(sheets, strict).where(~F.col("ok"))
        total = broken.count()
        if total:
            some = [f"{row['sheet']}: {row['rule']}" for row in broken.limit(SHOWN).collect()]
            raise SheetViolation(
                f"{total} violations (sheet_violations lists them), {len(some)} here: "
                + ", ".join(some)
            )
        kept = sheets
    else:
        kept = sheets.join(valid_sheets(sheets, strict), "sheet", "left_semi")
    return drop_personal(kept.withColumn("fantasy_owner", short_owner(F.col("fantasy_owner"))))


def measured_picks(
    sheets: DataFrame, on_violation: str = "raise", strict: bool = False
) -> Dimension:
    """``consolidate`` as a dimension, measured on the sheets as they are.

    Consolidation only leaves rows out and shortens names, so that size is an upper
    bound, and finding it needs no check.
    """
    whole = measured(drop_personal(sheets))
    return Dimension(consolidate(sheets, on_violation, strict), whole.fits, whole.rows)
