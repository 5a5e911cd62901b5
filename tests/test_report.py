"""Joins, dimensions and the report."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import leaguescore as ls
from leaguescore.operators.joins import Dimension, measured, people_dimension
from leaguescore.operators.quality import (
    AUDITS,
    contract_violations,
    new_audits,
    sheet_violations,
    valid_sheets,
)
from leaguescore.plans import dimensions, report, rosters, stats
from leaguescore.registry import QUERIES, SEASONS, Inputs
from leaguescore.schemas import (
    KICKING_STATS,
    PICK_COLUMNS,
    REPORT_COLUMNS,
    SCORED_SCHEMA,
    TEAM_LIST_SCHEMA,
)

SF_DIR = "/root/testdata/sf0.001"

TEAM_LIST = "season int, team string, full string"
TEAM_DESC = "team_abbr string, team_conf string, team_division string, team_logo_espn string"
ROSTER = "season int, team string, position string, status string, full_name string, gsis_id string"
KICKS = (
    "week int, season_type string, player_id string, player_name string, team string, fg_made int,"
    "fg_made_40_49 int, fg_made_50_59 int, fg_made_60_ int, fg_missed int, fg_blocked int,"
    "pat_made int, pat_missed int"
)
PICKS = (
    "fantasy_owner string, fantasy_team string, player_id string, roster_index int,"
    "position_type string, position_code string, team_abbr string"
)


@pytest.fixture(scope="module")
def teams(spark):
    listed = [(2024, "T01", "One"), (2023, "T01", "Old One"), (2024, "T02", "Two")]
    described = [("T01", "C1", "D1", "l1")] * 2
    return dimensions.teams(
        spark.createDataFrame(listed, TEAM_LIST), spark.createDataFrame(described, TEAM_DESC), 2024
    )


@pytest.fixture(scope="module")
def players(spark, teams):
    rows = [
        (2024, "T01", "P", "ACT", "Al Punter", "a"),
        (2024, "T02", "QB", "ACT", "No Id", None),
        (2024, "T02", "DL", "ACT", "Line Man", "z"),
    ]
    return dimensions.players(spark.createDataFrame(rows, ROSTER), teams)


def kicks(spark, *keys):
    return spark.createDataFrame(
        [(1, "REG", player, "x", team, 2, 0, 0, 0, 0, 0, 0, 0) for player, team in keys], KICKS
    )


def scored_kicks(spark, players, teams, *keys):
    return stats.kicker_stats(kicks(spark, *keys), SEASONS, players, teams)


def test_teams(teams):
    rows = {r["team_abbr"]: r for r in teams.collect()}
    assert len(rows) == 2
    assert rows["T01"]["lookup_string"] == "Defense, T01 (D1)"
    assert rows["T01"]["team_name_w_abbr"] == "One (T01)"
    assert rows["T02"]["lookup_string"] is None


def test_players(players):
    rows = {r["player_id"]: r for r in players.collect()}
    assert rows.keys() == {"a", None}
    assert rows["a"]["position"] == "K"
    assert rows["a"]["lookup_string"] == "K, T01: Al Punter (D1)"


def test_stat_rows(spark, players, teams):
    df = scored_kicks(spark, players, teams, ("a", "T02"), (None, "T02"), ("unknown", "T01"))
    assert df.schema.simpleString() == SCORED_SCHEMA.simpleString()
    rows = {r["player_id"]: r for r in df.where("stat_label = 'fg_made'").collect()}
    assert df.count() == 3 * len(KICKING_STATS)
    assert rows["a"]["subsequently_traded"] and rows["a"]["fantasy_points"] == 6
    assert rows[None]["player_name"] == "No Id" and not rows[None]["subsequently_traded"]
    lost = rows["unknown"]
    assert lost["player_name"] is lost["position"] is lost["lookup_string"] is None
    assert lost["subsequently_traded"]


def test_same_rows_without_a_broadcast(spark, players, teams):
    keys = [("a", "T01"), (None, "T02"), ("b", None)]
    wide = stats.kicking_wide(kicks(spark, *keys), SEASONS)
    people = people_dimension(players)
    results = []
    for fits in (True, False):
        results.append(
            stats.score_wide(
                wide,
                KICKING_STATS,
                stats.KICKING_RULES,
                Dimension(teams, fits),
                Dimension(people.frame, fits),
            )
        )
    small, large = results
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_measured_limit(teams):
    assert measured(teams).fits
    assert not measured(teams, limit=10).fits
    assert measured(measured(teams, limit=10)).fits is False
    assert not measured(teams.select(F.array("team_abbr").alias("nested"))).fits


def test_picks(spark, players, teams):
    scored = scored_kicks(spark, players, teams, ("a", "T01"))
    picks = spark.createDataFrame(
        [
            ("O 1", "F1", "a", 1, "Player", "K", "T01"),
            ("O 2", "F2", "a", 1, "Player", "K", "T01"),
            ("O 2", "F2", "nobody", 2, "Player", "QB1", "T01"),
            ("O 2", "F2", "T77", 14, "Defense", "D", "T77"),
        ],
        PICKS,
    )
    df = report.scored_report(picks, scored)
    assert df.columns == list(REPORT_COLUMNS)
    rows = df.where("stat_label = 'fg_made' OR stat_label IS NULL").collect()
    assert sorted(r["fantasy_team"] for r in rows if r["position_code"] == "K") == ["F1", "F2"]
    defense = [r for r in rows if r["position_code"] == "D"]
    assert len(defense) == 1 and len(rows) == 3
    assert defense[0]["subsequently_traded"] is True
    assert defense[0]["stat_label"] is None and defense[0]["team_abbr"] == "T77"


def test_defense_pick_gets_its_team(spark, teams):
    games = spark.createDataFrame(
        [(1, "REG", "T01", "T02", 3, 0)],
        "week int, season_type string, home_team string, away_team string, home_score int, away_score int",
    )
    scored = stats.points_allowed(games, SEASONS, teams)
    picks = spark.createDataFrame([("O 1", "F1", "T01", 14, "Defense", "D", "T01")], PICKS)
    row = report.scored_report(picks, scored).first()
    assert (row["player_id"], row["player_name"], row["fantasy_points"]) == ("N/A", "One", 10)


def test_league_report_equals_report_over_scored_rows(spark):
    inputs = Inputs(spark, SF_DIR)
    league, picks = inputs.league(), inputs.picks()
    direct = report.league_report(picks, league)
    generic = report.scored_report(picks, report.all_scored_stats(league))
    assert direct.columns == generic.columns == list(REPORT_COLUMNS)
    assert direct.exceptAll(generic).isEmpty() and generic.exceptAll(direct).isEmpty()
    assert not direct.isEmpty()


def test_contract_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "week int, position string")
    found = contract_violations(df, ["week", "position"]).collect()
    assert {r["column_name"]: r["null_count"] for r in found} == {"week": 0, "position": 2}


def test_audit_is_taken_on_the_way(spark, players, teams):
    seen = new_audits()["kicking"]
    wide = kicks(spark, ("a", "T02"), ("unknown", "T01"))
    rows = stats.kicker_stats(wide, SEASONS, players, teams, seen=seen)
    rows.write.format("noop").mode("overwrite").save()
    n = len(KICKING_STATS)
    assert seen.get == {"traded": 2 * n, "without_player": n}


def test_one_run_fills_the_audits_of_all_sources(spark):
    audits = new_audits()
    rows = report.all_scored_stats(Inputs(spark, SF_DIR).league(), audits)
    rows.write.format("noop").mode("overwrite").save()
    counted = {r["source"]: r.asDict() for r in QUERIES["audit_counts"](spark, SF_DIR).collect()}
    assert counted.keys() == audits.keys() == AUDITS.keys()
    for source, seen in audits.items():
        assert seen.get == {name: counted[source][name] for name in AUDITS[source]}
        assert {k for k, v in counted[source].items() if v is not None} == {"source", *AUDITS[source]}


def test_one_run_of_the_report_fills_the_same_audits(spark):
    """The picks leave most rows out; the counts are about all of them all the same."""
    inputs = Inputs(spark, SF_DIR)
    league, picks = inputs.league(), inputs.picks().where("fantasy_team LIKE '%1'")
    audits, whole = new_audits(), new_audits()
    direct = report.league_report(picks, league, audits)
    rows = direct.collect()
    report.all_scored_stats(league, whole).write.format("noop").mode("overwrite").save()
    assert {k: v.get for k, v in audits.items()} == {k: v.get for k, v in whole.items()}
    assert audits["offense"].get["traded"] > 0 and audits["player_bonus"].get["out_of_scope"] > 0
    plain = report.league_report(picks, league)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, plain.collect())) and rows


def test_a_player_with_the_team_marker_is_in_no_report(spark, players, teams):
    inputs = Inputs(spark, SF_DIR)
    league = inputs.league()
    marked = league.plays.withColumn("passer_player_id", F.lit("N/A"))
    league = replace(league, plays=marked)
    picks = inputs.picks().withColumn("player_id", F.lit("N/A"))
    direct = report.league_report(picks, league).where("stat_label LIKE 'forty%' AND player_id = 'N/A'")
    assert direct.isEmpty()
    assert not league.plays.where("pass_touchdown = 1 AND passing_yards >= 40").isEmpty()


def test_valid_sheets_are_those_without_a_violation(spark):
    sheets = Inputs(spark, "/root/testdata/sf0.01").sheets()
    unnamed = sheets.where("sheet = 1 OR sheet = 2").withColumn("fantasy_team", F.lit(None).cast("string"))
    some = sheets.where("sheet > 2").union(unnamed)
    for rows in (sheets, some):
        for strict in (False, True):
            broken = sheet_violations(rows, strict).where("NOT ok").select("sheet").distinct()
            wanted = {r[0] for r in rows.select("sheet").exceptAll(broken.join(rows, "sheet").select("sheet")).distinct().collect()}
            assert {r[0] for r in valid_sheets(rows, strict).collect()} == wanted and wanted


def test_sorted_report_puts_missing_last(spark):
    df = spark.createDataFrame(
        [(None, "a", 1), ("F1", None, 2), ("F1", "b", 3)],
        "fantasy_team string, fantasy_owner string, roster_index int",
    )
    assert [r["roster_index"] for r in report.sorted_report(df).collect()] == [3, 2, 1]


def test_consolidated_columns(spark):
    picks = rosters.consolidate(Inputs(spark, SF_DIR).sheets(), on_violation="drop")
    assert picks.columns == list(PICK_COLUMNS)
    assert picks.where(F.col("fantasy_owner").contains("@")).isEmpty()


def test_from_files_to_report(spark, tmp_path):
    """Raw files on disk, plays standing in for games, sheets as CSV, one published path."""
    inputs, raw = Inputs(spark, SF_DIR), {}
    for view in ("v_offense", "v_kicking", "v_pbp", "v_roster", "v_team_desc"):
        inputs.view(view).write.parquet(str(tmp_path / view))
        raw[view] = ls.scan_parquet(spark, str(tmp_path / view))
    inputs.view("v_team_list").coalesce(1).write.option("header", True).csv(str(tmp_path / "teams"))
    listed = ls.scan_csv(spark, str(tmp_path / "teams"), TEAM_LIST_SCHEMA)
    team_dim = ls.measured(ls.teams(listed, raw["v_team_desc"], 2024))
    league = ls.League(
        offense=raw["v_offense"],
        kicking=raw["v_kicking"],
        plays=ls.plays(raw["v_pbp"], SEASONS),
        games=raw["v_pbp"],
        teams=team_dim,
        players=ls.players(raw["v_roster"], team_dim),
        seasons=SEASONS,
    )
    picks = ls.consolidate(inputs.sheets(), on_violation="drop")
    path = ls.write_parquet(ls.league_report(picks, league), str(tmp_path / "out"), "1")
    written = spark.read.parquet(path)
    assert written.columns == list(REPORT_COLUMNS)
    generic = ls.scored_report(picks, ls.all_scored_stats(league))
    assert written.exceptAll(generic).isEmpty() and generic.exceptAll(written).isEmpty()
    labels = {r["stat_label"] for r in written.select("stat_label").distinct().collect()}
    assert {"def_points_allowed", "sack_bonus", "passing_yards", "fg_made"} <= labels
