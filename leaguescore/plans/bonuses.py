"""Bonus rows counted from plays."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leaguescore.functions import in_seasons, nan_to_null, recode
from leaguescore.operators.events import count_events, events_of
from leaguescore.operators.joins import (
    Dimension,
    people_dimension,
    with_people,
    with_teams,
)
from leaguescore.operators.quality import audited
from leaguescore.plans.stats import describe_defense
from leaguescore.rules import DEFENSE_EVENTS, OFFENSE_EVENTS, EventRule
from leaguescore.schemas import BONUS_POSITIONS, NO_PLAYER, PLAY_COLUMNS, SCORED_COLUMNS


def plays(raw: DataFrame, seasons: Iterable[str]) -> DataFrame:
    """Plays in scope, the columns the rules and reports may use."""
    return nan_to_null(in_seasons(raw, seasons).select(*PLAY_COLUMNS))


def bonus_counts(play_rows: DataFrame, rules: Sequence[EventRule]) -> DataFrame:
    return count_events(events_of(play_rows, rules))


def shared_counts(
    play_rows: DataFrame,
    player_rules: Sequence[EventRule] = OFFENSE_EVENTS,
    team_rules: Sequence[EventRule] = DEFENSE_EVENTS,
) -> DataFrame:
    """Counts of player and team rules from one aggregate over the plays, to be used for both.

    ``side`` is 2 for a player, 1 for a team, 0 for a player row with the team marker as its id. It is an
    aggregate of its group, not a key: so a filter on it stays above the aggregate, and the scan and shuffle
    below are the same for either use and run once.
    """
    of_team = F.col("stat_label").isin(*[rule.label for rule in team_rules])
    side = F.max(F.when(of_team, 1).when(F.col("player_id") == NO_PLAYER, 0).otherwise(2))
    return count_events(events_of(play_rows, (*player_rules, *team_rules)), side=side)


def player_counts(counts: DataFrame) -> DataFrame:
    return counts.where("side <> 1").drop("side")


def team_counts(counts: DataFrame) -> DataFrame:
    return counts.where("side = 1").drop("side", "player_id", "player_name")


def with_bonus_people(counts: DataFrame, people: Dimension) -> DataFrame:
    """Player bonus rows with their people; the rostered position is kept for the label.

    Only the position column turns a fullback into a running back.
    """
    named = with_people(counts, people).withColumn("rostered", F.col("position"))
    return named.withColumn("position", recode(F.col("position"), {"FB": "RB"}))


def with_bonus_teams(
    named: DataFrame, teams: DataFrame | Dimension, carry: tuple[str, ...] = ()
) -> DataFrame:
    return with_teams(named, teams, "rostered").select(*SCORED_COLUMNS, *carry)


def describe_player_bonus(
    counts: DataFrame,
    teams: DataFrame | Dimension,
    people: Dimension,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Complete player bonus rows, of whatever position."""
    return with_bonus_teams(with_bonus_people(counts, people), teams, carry)


def offense_bonus(
    play_rows: DataFrame,
    players: DataFrame | Dimension,
    teams: DataFrame | Dimension,
    rules: Sequence[EventRule] = OFFENSE_EVENTS,
    seen: Observation | None = None,
) -> DataFrame:
    """Player bonuses, kept for the offense positions only; ``seen`` counts the others too."""
    return scored_bonus(bonus_counts(play_rows, rules), players, teams, seen)


def scored_bonus(
    counts: DataFrame,
    players: DataFrame | Dimension,
    teams: DataFrame | Dimension,
    seen: Observation | None = None,
) -> DataFrame:
    """Player bonuses from counts."""
    rows = describe_player_bonus(counts, teams, people_dimension(players))
    return audited(rows, "player_bonus", seen).where(F.col("position").isin(*BONUS_POSITIONS))


def defense_bonus(
    play_rows: DataFrame,
    teams: DataFrame | Dimension,
    rules: Sequence[EventRule] = DEFENSE_EVENTS,
) -> DataFrame:
    return describe_defense(
        bonus_counts(play_rows, rules).drop("player_id", "player_name"), teams
    )
