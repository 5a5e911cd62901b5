"""Wide to long, unions, and the two-sided view of a game."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.functions import exact_long


def melt(df: DataFrame, ids: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row per stat, missing values kept."""
    return df.select(*ids, *[F.col(s).cast("double").alias(s) for s in stats]).unpivot(
        list(ids), list(stats), "stat_label", "football_value"
    )


def melt_scored(
    df: DataFrame,
    ids: Sequence[str],
    stats: Sequence[str],
    scores: Mapping[str, Callable[[str], str]],
) -> DataFrame:
    """One row per stat with its points.

    Each stat is stacked as (label, value, points), so its rule is picked when
    the plan is built and not row by row through a long CASE on the label. The
    exact cast comes once, after the stack, which keeps the generated code small
    enough to be compiled. Missing values count as 0; so do stats without a rule.
    """
    cells = []
    for stat in stats:
        value = f"coalesce(cast({stat} AS double), 0D)"
        score = scores[stat](value) if stat in scores else "0"
        cells += [f"'{stat}'", value, f"cast({score} AS double)"]
    stacked = F.expr(f"stack({len(stats)}, {', '.join(cells)})")
    return df.select(*ids, stacked.alias("stat_label", "football_value", "score")).select(
        *ids,
        "stat_label",
        "football_value",
        exact_long(F.col("score")).alias("fantasy_points"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)


def points_against(games: DataFrame) -> DataFrame:
    """Both teams of a game with the points scored against them, in one scan.

    Equal rows are made one within the home side and within the away side, not
    across them; hence the side is part of the distinct key.
    """
    sides = F.expr(
        """inline(array(
            struct('home' AS side, home_team AS team_abbr,
                   cast(away_score AS double) AS football_value),
            struct('away' AS side, away_team AS team_abbr,
                   cast(home_score AS double) AS football_value)))"""
    )
    return games.select("week", "season_type", sides).distinct().drop("side")
