"""Event bonuses on hand-made plays."""

import math

import pytest

from leaguescore.operators.events import count_events, events_of
from leaguescore.plans.bonuses import defense_bonus, offense_bonus, plays
from leaguescore.rules import DEFENSE_EVENTS, OFFENSE_EVENTS
from leaguescore.schemas import PLAY_COLUMNS, SCORED_COLUMNS

NUMBERS = {
    "touchdown", "pass_touchdown", "rush_touchdown", "return_touchdown", "interception", "fumble",
    "fumble_lost", "sack", "safety", "two_point_attempt", "extra_point_attempt",
    "field_goal_attempt", "yards_gained", "rushing_yards", "passing_yards", "return_yards",
    "kick_distance",
}
INTS = {"week", "home_score", "away_score"}
SCHEMA = ", ".join(
    f"`{c}` {'double' if c in NUMBERS else 'int' if c in INTS else 'string'}" for c in PLAY_COLUMNS
)
BASE = {
    "week": 1,
    "season_type": "REG",
    "posteam": "T01",
    "defteam": "T02",
    "passer_player_id": "p1",
    "passer_player_name": "Pat",
    "receiver_player_id": "r1",
    "receiver_player_name": "Rex",
    "rusher_player_id": "u1",
    "rusher_player_name": "Ulf",
    "kickoff_returner_player_id": "k1",
    "kickoff_returner_player_name": "Kim",
    "punt_returner_player_id": "q1",
    "punt_returner_player_name": "Quin",
}


def made(spark, *changes):
    rows = [tuple({**BASE, **change}.get(c) for c in PLAY_COLUMNS) for change in changes]
    return plays(spark.createDataFrame(rows, SCHEMA), ["Regular", "Post"])


def counted(df, rules):
    rows = count_events(events_of(df, rules)).collect()
    return sorted((r["stat_label"], r["team_abbr"], r["player_id"], r["fantasy_points"]) for r in rows)


@pytest.mark.parametrize(
    "yards, hit", [(39.9, False), (40.0, True), (math.nan, False), (None, False)]
)
def test_forty_yard_boundary(spark, yards, hit):
    df = made(spark, {"pass_touchdown": 1.0, "passing_yards": yards})
    expected = [
        ("forty_yd_plus_passing_td_qb_bonus", "T01", "p1", 2),
        ("forty_yd_plus_passing_td_receiver_bonus", "T01", "r1", 2),
    ]
    assert counted(df, OFFENSE_EVENTS) == (expected if hit else [])


def test_returns_credit_the_returning_team(spark):
    returned = {"return_touchdown": 1.0, "return_yards": 55.0}
    df = made(spark, {"play_type": "kickoff", **returned}, {"play_type": "punt", **returned})
    assert counted(df, OFFENSE_EVENTS) == [
        ("forty_yd_plus_kickoff_return_td_bonus", "T01", "k1", 2),
        ("forty_yd_plus_punt_return_td_bonus", "T02", "q1", 2),
    ]
    assert counted(df, DEFENSE_EVENTS) == [
        ("kickoff_def_td_return_bonus", "T01", "N/A", 6),
        ("punt_def_td_return_bonus", "T02", "N/A", 6),
    ]


def test_events_are_counted_and_weighted(spark):
    df = made(spark, *[{"interception": 1.0, "sack": 1.0}] * 3)
    assert counted(df, DEFENSE_EVENTS) == [
        ("interception_bonus", "T02", "N/A", 6),
        ("sack_bonus", "T02", "N/A", 3),
    ]


def test_lost_fumbles(spark):
    lost = {"fumble": 1.0, "fumble_lost": 1.0}
    df = made(spark, lost, {**lost, "play_type": "punt"}, {"fumble": 1.0, "fumble_lost": None})
    assert counted(df, DEFENSE_EVENTS) == [
        ("fumble_recovery_bonus", "T02", "N/A", 2),
        ("fumble_recovery_punt_bonus", "T01", "N/A", 2),
    ]


def test_safety_and_block_need_a_player(spark):
    df = made(
        spark,
        {"safety": 1.0},
        {"safety": 1.0, "safety_player_id": "s"},
        {"blocked_player_name": "Bo"},
    )
    assert counted(df, DEFENSE_EVENTS) == [
        ("block_bonus", "T02", "N/A", 2),
        ("safety_bonus", "T02", "N/A", 1),
    ]


def test_group_with_a_missing_key_does_not_count(spark):
    big = {"pass_touchdown": 1.0, "passing_yards": 50.0}
    df = made(spark, {**big, "passer_player_name": None, "receiver_player_id": None})
    assert counted(df, OFFENSE_EVENTS) == []
    assert counted(made(spark, {"sack": 1.0, "defteam": None}), DEFENSE_EVENTS) == []


TEAMS = "season int, team_name string, team_abbr string, team_conf string, team_division string, lookup_string string"
PLAYERS = "player_id string, team_abbr string, position string, player_name string"


def test_offense_bonus_positions_and_labels(spark):
    teams = spark.createDataFrame([(2024, "One", "T01", "C", "D1", "Defense, T01 (D1)")], TEAMS)
    players = spark.createDataFrame(
        [("p1", "T01", "FB", "Pat Full"), ("r1", "T09", "K", "Rex")], PLAYERS
    )
    df = made(
        spark,
        {"pass_touchdown": 1.0, "passing_yards": 41.0},
        {"rush_touchdown": 1.0, "rushing_yards": 90.0},
    )
    rows = offense_bonus(df, players, teams).collect()
    assert len(rows) == 1  # the kicker and the unknown rusher are out of scope
    row = rows[0]
    assert row.__fields__ == list(SCORED_COLUMNS)
    assert (row["position"], row["player_name"]) == ("RB", "Pat Full")
    assert row["lookup_string"] == "FB, T01: Pat Full (D1)"
    assert row["subsequently_traded"] is False


def test_defense_bonus_rows(spark):
    teams = spark.createDataFrame([(2024, "Two", "T02", "C", "D2", "Defense, T02 (D2)")], TEAMS)
    row = defense_bonus(made(spark, {"sack": 1.0}), teams).first()
    assert (row["player_id"], row["player_name"], row["position"]) == ("N/A", "Two", "Defense")
    assert (row["football_value"], row["fantasy_points"]) == (1.0, 1)
