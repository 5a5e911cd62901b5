"""Scored fantasy report: rosters joined to scored stats."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from leaguescore.functions import is_not, true_if_missing
from leaguescore.operators.joins import (
    Dimension,
    attach,
    attach_in_shares,
    counted,
    measured,
    people_dimension,
    with_people,
    with_teams,
)
from leaguescore.operators.quality import audited
from leaguescore.operators.reshape import union_all
from leaguescore.plans.bonuses import (
    player_counts,
    scored_bonus,
    shared_counts,
    team_counts,
    with_bonus_people,
    with_bonus_teams,
)
from leaguescore.plans.stats import (
    describe_defense,
    kicker_stats,
    kicking_wide,
    offense_stats,
    offense_wide,
    points_allowed,
    score_described,
)
from leaguescore.rules import KICKING_RULES, OFFENSE_RULES
from leaguescore.schemas import (
    BONUS_POSITIONS,
    DEFENSE_PICK,
    KICKING_STATS,
    NO_PLAYER,
    OFFENSE_STATS,
    REPORT_COLUMNS,
)

PLAYER_PICK_COLUMNS = (
    "roster_index",
    "position_code",
    "fantasy_owner",
    "fantasy_team",
    "position_type",
)

#: Picks of any kind to a share in ``score_defense_picks``; a roster has one defense in 14.
SHARE_PICKS = 16_384


@dataclass(frozen=True)
class League:
    """The inputs of a report: raw fact frames and prepared dimensions."""

    offense: DataFrame
    kicking: DataFrame
    plays: DataFrame
    games: DataFrame
    teams: Dimension
    players: DataFrame
    seasons: tuple[str, ...]


def player_picks(picks: DataFrame) -> DataFrame:
    """Picks of players. A missing position code counts as one."""
    return picks.where(is_not(F.col("position_code"), DEFENSE_PICK)).drop("team_abbr")


def defense_picks(picks: DataFrame) -> DataFrame:
    return picks.where(F.col("position_code") == DEFENSE_PICK).drop("player_id")


def score_player_picks(picks: DataFrame, scored: DataFrame) -> DataFrame:
    """Picks of players with their scored rows; picks without any are left out."""
    chosen = measured(player_picks(picks).withColumnRenamed("player_id", "picked_id"))
    rows = scored.where(is_not(F.col("player_id"), NO_PLAYER) & F.col("stat_label").isNotNull())
    return attach(rows, chosen, "player_id", "picked_id", "inner").select(*REPORT_COLUMNS)


def score_defense_picks(picks: DataFrame | Dimension, scored: DataFrame) -> DataFrame:
    """Picks of a defense with its scored rows; a pick without any stays, flagged as traded.

    All picks stay, so they cannot be the side that Spark broadcasts, whatever their size. To send them to the
    scored rows and then add the picks that found none would evaluate the scored rows twice. So picks are the left
    side of one join: adaptive execution sends the scored rows to them where those are small, and splits hot teams
    where they are not. Each pick gets all rows of its team, a thousand and more. Measured picks that are many are
    therefore dealt to shares by their number, as their bytes say nothing of that.
    """
    frame, count = (picks.frame, picks.rows) if isinstance(picks, Dimension) else (picks, 0)
    chosen = defense_picks(frame).withColumnRenamed("team_abbr", "picked_team")
    rows = scored.where(F.col("player_id") == NO_PLAYER)
    if count > SHARE_PICKS:
        shares = -(-count // SHARE_PICKS)
        joined = attach_in_shares(chosen, rows, "picked_team", "team_abbr", shares)
    else:
        joined = chosen.join(rows, F.col("picked_team").eqNullSafe(F.col("team_abbr")), "left")
    return (
        joined.withColumn("team_abbr", F.col("picked_team"))
        .withColumn("subsequently_traded", true_if_missing(F.col("subsequently_traded")))
        .select(*REPORT_COLUMNS)
    )


def scored_report(picks: DataFrame, scored: DataFrame) -> DataFrame:
    """The report over scored rows from anywhere, a stored table for example."""
    return union_all(
        score_player_picks(picks, scored), score_defense_picks(counted(picks), scored)
    )


def all_scored_stats(
    league: League, audits: Mapping[str, Observation] | None = None
) -> DataFrame:
    """Every scored row of the league; the run that first uses them fills ``new_audits()``."""
    people, seen = people_dimension(league.players), audits or {}
    facts = {"players": people, "teams": league.teams}
    counts = shared_counts(league.plays)
    return union_all(
        offense_stats(league.offense, league.seasons, **facts, seen=seen.get("offense")),
        scored_bonus(player_counts(counts), **facts, seen=seen.get("player_bonus")),
        kicker_stats(league.kicking, league.seasons, **facts, seen=seen.get("kicking")),
        points_allowed(
            league.games, league.seasons, league.teams, seen=seen.get("points_allowed")
        ),
        describe_defense(team_counts(counts), league.teams),
    )


def league_report(
    picks: DataFrame | Dimension,
    league: League,
    audits: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """The report straight from the raw facts; same rows as ``scored_report``.

    Picks are joined to the wide weekly rows first, before the melt multiplies them by 13,
    so rows of players nobody picked go no further; players and teams come after them. With
    picks from ``measured_picks``, no check of the sheets runs while the plan is made. A player
    row of the facts with the team marker as its id is left out, as in ``scored_report``.

    With ``new_audits()``, the run that first uses the report fills in the counts that ``all_scored_stats`` would
    give. They are about all rows, so there the players come first, then the observation, then the picks.
    """
    sheet_rows, people, seen = measured(picks), people_dimension(league.players), audits or {}
    chosen = player_picks(sheet_rows.frame).withColumnRenamed("player_id", "picked_id")
    chosen = Dimension(chosen, sheet_rows.fits)

    def picked(rows: DataFrame) -> DataFrame:
        return attach(rows, chosen, "player_id", "picked_id", "inner")

    def named_picks(
        rows: DataFrame, source: str, name: Callable[..., DataFrame], real: Column, copies: int = 1
    ) -> DataFrame:
        if source not in seen:
            return name(picked(rows.where(real)), people)
        return picked(audited(name(rows, people), source, seen[source], copies).where(real))

    def scored(rows: DataFrame, source: str, stats: Sequence[str], rules: Sequence) -> DataFrame:
        real = is_not(F.col("player_id"), NO_PLAYER)
        named = named_picks(rows, source, with_people, real, len(stats))
        return score_described(with_teams(named, league.teams), stats, rules, PLAYER_PICK_COLUMNS)

    counts = shared_counts(league.plays)
    bonus = named_picks(
        counts.where("side <> 1"), "player_bonus", with_bonus_people, F.col("side") == 2
    )
    bonus = bonus.where(F.col("position").isin(*BONUS_POSITIONS))
    offense = offense_wide(league.offense, league.seasons)
    kicking = kicking_wide(league.kicking, league.seasons)
    player_rows = (
        scored(offense, "offense", OFFENSE_STATS, OFFENSE_RULES),
        scored(kicking, "kicking", KICKING_STATS, KICKING_RULES),
        with_bonus_teams(bonus, league.teams, PLAYER_PICK_COLUMNS),
    )
    defense_rows = union_all(
        points_allowed(league.games, league.seasons, league.teams, seen=seen.get("points_allowed")),
        describe_defense(team_counts(counts), league.teams),
    )
    return union_all(
        *[rows.select(*REPORT_COLUMNS) for rows in player_rows],
        score_defense_picks(sheet_rows, defense_rows),
    )


def sorted_report(report: DataFrame) -> DataFrame:
    """Report order, missing values last; only for an output that needs an order."""
    keys: Iterable[str] = ("fantasy_team", "fantasy_owner", "roster_index")
    return report.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
