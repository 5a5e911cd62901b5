"""Edge rows of the column expressions, rules and melts."""

import math

import pytest
from pyspark.sql import functions as F

from leaguescore import functions as fn
from leaguescore.operators.reshape import melt, melt_scored, points_against
from leaguescore.plans.stats import kicking_wide, offense_wide
from leaguescore.rules import (
    KICKING_RULES,
    OFFENSE_RULES,
    POINTS_ALLOWED_BANDS,
    compile_bands,
    scores_by_label,
)
from leaguescore.schemas import KICKING_STATS, OFFENSE_STATS


def column(spark, values, kind, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["out"] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "stat, values, expected",
    [
        ("passing_yards", [399, 400, 49, 50, -3, None], [7, 10, 0, 1, -1, 0]),
        ("rushing_yards", [199, 200, 9, 10, -3, None], [19, 22, 0, 1, -1, 0]),
        ("receiving_yards", [199, 200, 9, 10, -3, None], [19, 22, 0, 1, -1, 0]),
        ("passing_tds", [0, 2, None], [0, 12, 0]),
        ("interceptions", [0, 3, None], [0, -6, 0]),
        ("rushing_2pt_conversions", [1], [2]),
        ("receiving_fumbles_lost", [1], [-2]),
    ],
)
def test_offense_points(spark, stat, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {stat} int")
    rows = melt_scored(df, ["i"], [stat], scores_by_label(OFFENSE_RULES)).orderBy("i").collect()
    assert [r["fantasy_points"] for r in rows] == expected
    assert [r["football_value"] for r in rows] == [float(v or 0) for v in values]


def test_kicking_points(spark):
    raw = spark.createDataFrame(
        [(1, "REG", "1", "A", "T01", 2.0, 1.0, 1.0, None, 3.0, 1.0, 4.0, 1.0)],
        "week int, season_type string, player_id string, player_name string, team string,"
        "fg_made double, fg_made_40_49 double, fg_made_50_59 double, fg_made_60_ double,"
        "fg_missed double, fg_blocked double, pat_made double, pat_missed double",
    )
    wide = kicking_wide(raw, ["Regular"])
    rows = melt_scored(wide, ["player_id"], KICKING_STATS, scores_by_label(KICKING_RULES))
    points = {r["stat_label"]: r["fantasy_points"] for r in rows.collect()}
    assert [points[s] for s in KICKING_STATS] == [6, 1, 0, 0, 0, 4, -1]


def test_fraction_of_a_point_fails(spark):
    df = spark.createDataFrame([(0.3,)], "passing_tds double")
    with pytest.raises(Exception, match="not a whole number"):
        melt_scored(df, [], ["passing_tds"], scores_by_label(OFFENSE_RULES)).collect()


def test_points_allowed_bands(spark):
    scores = [0, 1, 6, 7, 13, 14, 17, 18, 21, 22, 27, 28, 34, 35, 45, 46, None]
    expected = [10, 7, 7, 4, 4, 1, 1, 0, 0, -1, -1, -4, -4, -7, -7, -10, None]
    rule = compile_bands(POINTS_ALLOWED_BANDS, "v")
    assert column(spark, scores, "int", lambda v: rule) == expected


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, math.nan), (2, 40.0), (3, None)], "i int, `a.b` double")
    kept = fn.nan_to_null(df).where(F.col("`a.b`") >= 40).collect()
    assert [r["i"] for r in kept] == [2]


def test_missing_value_rules(spark):
    values = ["punt", "pass", None]
    assert column(spark, values, "string", lambda v: fn.is_not(v, "punt")) == [False, True, True]
    assert column(spark, values, "string", lambda v: fn.not_in(v, ["punt"])) == [False, True, True]
    assert column(spark, [True, False, None], "boolean", fn.true_if_missing) == [True, False, True]
    pairs = spark.createDataFrame(
        [(0, "a", "a"), (1, "a", "b"), (2, "a", None), (3, None, None)], "i int, x string, y string"
    )
    flags = pairs.orderBy("i").select(fn.differs(F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in flags] == [False, True, True, True]


def test_recode_keeps_other_values(spark):
    assert column(
        spark, ["REG", "PRE", None], "string", lambda v: fn.recode(v, {"REG": "Regular"})
    ) == ["Regular", "PRE", None]


def test_short_owner(spark):
    names = ["Ada Byron", "Mary Jo Smith", "Cher", "Ann ", None]
    assert column(spark, names, "string", fn.short_owner) == [
        "Ada B",
        "Mary Jo S",
        None,
        None,
        None,
    ]


def test_floor_div_rounds_down(spark):
    assert column(spark, [-3.0, 9.0, 10.0, None], "double", lambda v: fn.floor_div(v, 10)) == [
        -1,
        0,
        1,
        None,
    ]


def test_exact_long(spark):
    assert column(spark, [-0.0, 3.0, None], "double", fn.exact_long) == [0, 3, None]


def test_label_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("QB", "T01", "Al", None)], "p string, t string, n string, d string")
    label = fn.player_label(F.col("p"), F.col("t"), F.col("n"), F.col("d"))
    assert df.select(label).first()[0] is None


@pytest.mark.parametrize(
    "seasons, kept",
    [(["Regular", "Post"], 3), (["Post"], 1), (["PRE"], 1), (["REG"], 0), ([], 0)],
)
def test_in_seasons(spark, seasons, kept):
    df = spark.createDataFrame([("REG",), ("Regular",), ("POST",), ("PRE",)], "season_type string")
    rows = fn.in_seasons(df, seasons).collect()
    assert len(rows) == kept
    assert {r["season_type"] for r in rows} <= set(seasons)


def test_rename_checked(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert fn.rename_checked(df, {"a": "x", "b": "y"}).columns == ["x", "y"]
    with pytest.raises(ValueError):
        fn.rename_checked(df, {"b": "y", "a": "x"})


def test_melt_keeps_missing(spark):
    df = spark.createDataFrame([(1, 2, None)], "i int, a int, b double")
    rows = melt(df, ["i"], ["a", "b"]).orderBy("stat_label").collect()
    assert [(r["stat_label"], r["football_value"]) for r in rows] == [("a", 2.0), ("b", None)]


def test_points_against_is_distinct_per_side(spark):
    schema = "week int, season_type string, home_team string, away_team string, home_score int, away_score int"
    twice = spark.createDataFrame([(1, "REG", "A", "B", 3, 7)] * 2, schema)
    assert points_against(twice).count() == 2
    across = spark.createDataFrame(
        [(1, "REG", "A", "B", 3, 7), (1, "REG", "C", "A", 7, 0)], schema
    )
    both = points_against(across).where("team_abbr = 'A' AND football_value = 7")
    assert both.count() == 2


def test_offense_scope(spark):
    ids = "position string, week int, season_type string, player_id string, player_name string, recent_team string"
    schema = ids + "".join(f", {s} double" for s in OFFENSE_STATS)
    stats = [0.0] * len(OFFENSE_STATS)
    rows = [
        ("FB", 1, "REG", "1", "a", "T01", *stats),
        ("K", 1, "REG", "2", "b", "T01", *stats),
        ("QB", 1, "PRE", "3", "c", "T01", *stats),
        ("QB", 1, "POST", "4", "d", "T01", *stats),
    ]
    wide = offense_wide(spark.createDataFrame(rows, schema), ["Regular", "Post"])
    assert sorted(r["player_id"] for r in wide.collect()) == ["1", "4"]
