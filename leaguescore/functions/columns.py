"""Column expressions.

Missing values are null here. Comparisons that the data model counts as true on
a missing value (inequality, "not in", the boolean cast) are spelled out, since
SQL would answer null and a filter would drop the row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values; leave every other value as it is."""
    result = None
    for old, new in mapping.items():
        hit = value == F.lit(old)
        result = F.when(hit, F.lit(new)) if result is None else result.when(hit, F.lit(new))
    return value if result is None else result.otherwise(value)


def fill_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def floor_div(value: Column, divisor: float) -> Column:
    """Floor of a quotient; negative values round down."""
    return F.floor(value / F.lit(divisor))


def exact_long(value: Column) -> Column:
    """Cast a number to bigint, failing on a fraction rather than cutting it off."""
    return (
        F.when(value.isNull(), F.lit(None).cast("bigint"))
        .when(value == F.floor(value), value.cast("bigint"))
        .otherwise(
            F.raise_error(F.concat(F.lit("not a whole number: "), value.cast("string"))).cast(
                "bigint"
            )
        )
    )


def true_if_missing(flag: Column) -> Column:
    """Boolean cast under which a missing flag counts as true."""
    return F.coalesce(flag, F.lit(True))


def differs(left: Column, right: Column) -> Column:
    """Inequality that is true when either side, or both, is missing."""
    return F.coalesce(left != right, F.lit(True))


def is_not(value: Column, other: str) -> Column:
    """Inequality with a constant that keeps missing values."""
    return ~value.eqNullSafe(F.lit(other))


def not_in(value: Column, listed: Iterable[str]) -> Column:
    """True for values outside the list; a missing value is outside every list."""
    return ~F.coalesce(value.isin(*listed), F.lit(False))


def player_label(position: Column, team: Column, name: Column, division: Column) -> Column:
    """``position, TEAM: name (division)``; null when any part is null."""
    return F.concat(
        position, F.lit(", "), team, F.lit(": "), name, F.lit(" ("), division, F.lit(")")
    )


def team_label(position: Column, team: Column, division: Column) -> Column:
    """``position, TEAM (division)``; null when any part is null."""
    return F.concat(position, F.lit(", "), team, F.lit(" ("), division, F.lit(")"))


def short_owner(name: Column) -> Column:
    """All but the last name, and its initial; null for a name without a space."""
    return F.nullif(F.regexp_extract(name, "(^.* .)", 1), F.lit(""))
