"""Scored stat rows of players and defenses."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leaguescore.functions import add_constants, in_seasons, nan_to_null
from leaguescore.operators.joins import (
    Dimension,
    describe_players,
    join_teams,
    measured,
    people_dimension,
)
from leaguescore.operators.quality import audited
from leaguescore.operators.reshape import melt_scored, points_against
from leaguescore.rules import (
    KICKING_RULES,
    OFFENSE_RULES,
    POINTS_ALLOWED_BANDS,
    POINTS_ALLOWED_LABEL,
    Band,
    FloorDiv,
    Linear,
    compile_bands,
    scores_by_label,
)
from leaguescore.schemas import (
    DEFENSE_POSITION,
    KICKING_STATS,
    NO_PLAYER,
    OFFENSE_POSITIONS,
    OFFENSE_STATS,
    SCORED_COLUMNS,
    STAT_IDS,
)

SCORED_IDS = SCORED_COLUMNS[:10]


def offense_wide(raw: DataFrame, seasons: Iterable[str]) -> DataFrame:
    """Weekly offense rows in scope: id columns and 13 stats."""
    scoped = in_seasons(raw, seasons).where(F.col("position").isin(*OFFENSE_POSITIONS))
    named = scoped.withColumnRenamed("recent_team", "team_abbr")
    return nan_to_null(named.select(*STAT_IDS, *OFFENSE_STATS))


def kicking_wide(raw: DataFrame, seasons: Iterable[str]) -> DataFrame:
    """Weekly kicking rows in scope: id columns and 7 stats.

    The 50-plus column is the sum of two ranges, missing when either is missing.
    """
    named = nan_to_null(in_seasons(raw, seasons)).withColumnRenamed("team", "team_abbr")
    return (
        named.withColumn("position", F.lit("K"))
        .withColumn("fg_made_50plus", F.col("fg_made_50_59") + F.col("fg_made_60_"))
        .select(*STAT_IDS, *KICKING_STATS)
    )


def score_described(
    described: DataFrame,
    stats: Sequence[str],
    rules: Sequence[Linear | FloorDiv],
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Melt and score wide rows that have their dimensions; ``carry`` names more columns to keep."""
    return melt_scored(described, (*SCORED_IDS, *carry), stats, scores_by_label(rules))


def score_wide(
    wide: DataFrame,
    stats: Sequence[str],
    rules: Sequence[Linear | FloorDiv],
    teams: DataFrame | Dimension,
    people: Dimension,
    carry: tuple[str, ...] = (),
    source: str = "offense",
    seen: Observation | None = None,
) -> DataFrame:
    """Join the dimensions to the wide rows, then melt and score.

    The join keys are id columns, so joining ahead of the melt gives the same
    rows and joins (and, without a broadcast, shuffles) one row per player-week
    in place of one per stat. The audit of ``seen`` is taken there too. ``carry``
    names columns of the wide rows to keep.
    """
    described = audited(describe_players(wide, teams, people), source, seen, len(stats))
    return score_described(described, stats, rules, carry)


def offense_stats(
    raw: DataFrame,
    seasons: Iterable[str],
    players: DataFrame | Dimension,
    teams: DataFrame | Dimension,
    rules: Sequence[Linear | FloorDiv] = OFFENSE_RULES,
    seen: Observation | None = None,
) -> DataFrame:
    people = people_dimension(players)
    wide = offense_wide(raw, seasons)
    return score_wide(wide, OFFENSE_STATS, rules, teams, people, source="offense", seen=seen)


def kicker_stats(
    raw: DataFrame,
    seasons: Iterable[str],
    players: DataFrame | Dimension,
    teams: DataFrame | Dimension,
    rules: Sequence[Linear | FloorDiv] = KICKING_RULES,
    seen: Observation | None = None,
) -> DataFrame:
    people = people_dimension(players)
    wide = kicking_wide(raw, seasons)
    return score_wide(wide, KICKING_STATS, rules, teams, people, source="kicking", seen=seen)


def describe_defense(rows: DataFrame, teams: DataFrame | Dimension) -> DataFrame:
    """Complete team-level rows: the team stands where a player would."""
    dim = measured(teams)
    named = Dimension(
        dim.frame.select(
            "team_abbr",
            F.col("team_name").alias("player_name"),
            "team_conf",
            "team_division",
            "lookup_string",
        ).distinct(),
        dim.fits,
    )
    joined = join_teams(
        rows, named, "player_name", "team_conf", "team_division", "lookup_string"
    )
    return add_constants(
        joined,
        {
            "position": DEFENSE_POSITION,
            "player_id": NO_PLAYER,
            "subsequently_traded": False,
        },
    ).select(*SCORED_COLUMNS)


def points_allowed(
    games: DataFrame,
    seasons: Iterable[str],
    teams: DataFrame | Dimension,
    bands: Sequence[Band] = POINTS_ALLOWED_BANDS,
    seen: Observation | None = None,
) -> DataFrame:
    """Points of every defense for the scores against it, from games or from plays."""
    against = points_against(nan_to_null(in_seasons(games, seasons)))
    scored = against.withColumn("stat_label", F.lit(POINTS_ALLOWED_LABEL)).withColumn(
        "fantasy_points", compile_bands(bands, "football_value")
    )
    return describe_defense(audited(scored, "points_allowed", seen), teams)
