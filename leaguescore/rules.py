"""Scoring rules as data.

A league changes its scoring by passing other rule lists; no plan names a rule.
Rules turn into SQL expressions over the columns they are about.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaguescore.schemas import NO_PLAYER


@dataclass(frozen=True)
class Linear:
    """``value * weight``"""

    label: str
    weight: int

    def score(self, value: str) -> str:
        return f"{value} * {self.weight}"


@dataclass(frozen=True)
class FloorDiv:
    """``floor(value / divisor)``, and a bonus from ``bonus_at`` on."""

    label: str
    divisor: int
    bonus_at: int
    bonus: int

    def score(self, value: str) -> str:
        bonus = f"IF({value} >= {self.bonus_at}, {self.bonus}, 0)"
        return f"floor({value} / {self.divisor}) + {bonus}"


@dataclass(frozen=True)
class Band:
    """Points for values from ``low`` to ``high``, both included; no ``high``, no end."""

    low: int
    high: int | None
    points: int


@dataclass(frozen=True)
class EventRule:
    """Points for each play that meets a SQL condition.

    The credit goes to the team in column ``team`` and, with a ``role``, to the
    player in ``<role>_player_id`` and ``<role>_player_name``.
    """

    label: str
    when: str
    team: str
    points: int
    role: str | None = None

    def credit(self) -> str:
        """The credit of one play, null when the play does not meet the condition."""
        nobody = f"'{NO_PLAYER}'"
        player_id = f"{self.role}_player_id" if self.role else nobody
        player_name = f"{self.role}_player_name" if self.role else nobody
        return (
            f"IF({self.when}, struct({self.team} AS team_abbr, {player_name} AS player_name,"
            f" {player_id} AS player_id, {self.points}L AS points_each), NULL)"
        )


# --- fixed values: the league's scoring --------------------------------------

OFFENSE_RULES = (
    FloorDiv("passing_yards", 50, 400, 2),
    FloorDiv("rushing_yards", 10, 200, 2),
    FloorDiv("receiving_yards", 10, 200, 2),
    Linear("passing_tds", 6),
    Linear("rushing_tds", 6),
    Linear("receiving_tds", 6),
    Linear("passing_2pt_conversions", 2),
    Linear("rushing_2pt_conversions", 2),
    Linear("receiving_2pt_conversions", 2),
    Linear("interceptions", -2),
    Linear("sack_fumbles_lost", -2),
    Linear("rushing_fumbles_lost", -2),
    Linear("receiving_fumbles_lost", -2),
)

# Missed and blocked field goals have no rule: they score 0.
KICKING_RULES = (
    Linear("fg_made", 3),
    Linear("fg_made_40_49", 1),
    Linear("fg_made_50plus", 2),
    Linear("pat_made", 1),
    Linear("pat_missed", -1),
)

POINTS_ALLOWED_BANDS = (
    Band(0, 0, 10),
    Band(1, 6, 7),
    Band(7, 13, 4),
    Band(14, 17, 1),
    Band(18, 21, 0),
    Band(22, 27, -1),
    Band(28, 34, -4),
    Band(35, 45, -7),
    Band(46, None, -10),
)

POINTS_ALLOWED_LABEL = "def_points_allowed"

# On a kickoff the returning team is ``posteam``, on a punt it is ``defteam``.
OFFENSE_EVENTS = (
    EventRule(
        "forty_yd_plus_passing_td_qb_bonus",
        "pass_touchdown = 1 AND passing_yards >= 40",
        "posteam",
        2,
        "passer",
    ),
    EventRule(
        "forty_yd_plus_passing_td_receiver_bonus",
        "pass_touchdown = 1 AND passing_yards >= 40",
        "posteam",
        2,
        "receiver",
    ),
    EventRule(
        "forty_yd_plus_rushing_td_bonus",
        "rush_touchdown = 1 AND rushing_yards >= 40",
        "posteam",
        2,
        "rusher",
    ),
    EventRule(
        "forty_yd_plus_kickoff_return_td_bonus",
        "play_type = 'kickoff' AND return_touchdown = 1 AND return_yards >= 40",
        "posteam",
        2,
        "kickoff_returner",
    ),
    EventRule(
        "forty_yd_plus_punt_return_td_bonus",
        "play_type = 'punt' AND return_touchdown = 1 AND return_yards >= 40",
        "defteam",
        2,
        "punt_returner",
    ),
)

DEFENSE_EVENTS = (
    EventRule("sack_bonus", "sack = 1", "defteam", 1),
    EventRule("safety_bonus", "safety = 1 AND safety_player_id IS NOT NULL", "defteam", 1),
    EventRule(
        "fumble_recovery_bonus",
        "fumble = 1 AND fumble_lost = 1 AND NOT (play_type <=> 'punt')",
        "defteam",
        2,
    ),
    EventRule(
        "fumble_recovery_punt_bonus",
        "fumble = 1 AND fumble_lost = 1 AND play_type = 'punt'",
        "posteam",
        2,
    ),
    EventRule("interception_bonus", "interception = 1", "defteam", 2),
    EventRule("block_bonus", "blocked_player_name IS NOT NULL", "defteam", 2),
    EventRule(
        "def_td_return_bonus",
        "return_touchdown = 1 AND play_type IN ('pass', 'run')",
        "defteam",
        6,
    ),
    EventRule(
        "punt_def_td_return_bonus", "return_touchdown = 1 AND play_type = 'punt'", "defteam", 6
    ),
    EventRule(
        "kickoff_def_td_return_bonus",
        "return_touchdown = 1 AND play_type = 'kickoff'",
        "posteam",
        6,
    ),
)

# --- end of fixed values -----------------------------------------------------


def scores_by_label(
    rules: Sequence[Linear | FloorDiv],
) -> dict[str, Callable[[str], str]]:
    """The rule of every label, for ``melt_scored``."""
    return {rule.label: rule.score for rule in rules}


def compile_bands(bands: Sequence[Band], value: str) -> Column:
    """Points of the band a value is in; null for a missing value and between bands."""
    cases = []
    for band in bands:
        inside = f"{value} >= {band.low}"
        if band.high is not None:
            inside += f" AND {value} <= {band.high}"
        cases.append(f"WHEN {inside} THEN {band.points}L")
    return F.expr(f"CASE {' '.join(cases)} END")
