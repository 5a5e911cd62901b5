"""Shapes of the physical plans: scans, shuffles, join strategies, skew."""

import re
import tempfile
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.functions import in_seasons
from leaguescore.operators.events import count_events, events_of
from leaguescore.operators.joins import Dimension, describe_players, measured
from leaguescore.operators import quality
from leaguescore.plans import report, rosters
from leaguescore.plans.bonuses import plays, shared_counts
from leaguescore.registry import QUERIES, Inputs
from leaguescore.rules import DEFENSE_EVENTS, OFFENSE_EVENTS
from leaguescore.schemas import NO_PLAYER, SCORED_SCHEMA
from leaguescore.sources import latest_snapshot, snapshots
from leaguescore.sources.snapshots import newest_names

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(plan, table):
    return len(re.findall(rf"FileScan parquet.*/{table}\.parquet", plan))


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert node not in plan


def test_all_event_rules_take_one_scan_and_one_shuffle(spark):
    plays_in_scope = Inputs(spark, SF_DIR).plays()
    plan = plan_of(count_events(events_of(plays_in_scope, OFFENSE_EVENTS + DEFENSE_EVENTS)))
    assert scans_of(plan, "events") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_event_rules_have_methods_that_java_compiles(spark, conf):
    """Java leaves methods of over 8,000 bytes interpreted: events then took four times the CPU time."""
    conf(adaptive__enabled="false")  # generated code is only there once a plan is final
    counts = shared_counts(Inputs(spark, SF_DIR).plays())
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenString(counts._jdf.queryExecution().executedPlan())
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(-?\d+)", code)]
    assert sizes and 0 < min(sizes) and max(sizes) < 8000


@pytest.mark.parametrize("name", ["offense_stats", "kicker_stats", "defense_points_allowed"])
def test_dimensions_are_broadcast_to_the_facts(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_offense_facts_are_not_shuffled(spark):
    plan = plan_of(QUERIES["offense_stats"](spark, SF_DIR))
    assert scans_of(plan, "lineitem") == 1
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert all("player_id" not in keys for keys in shuffled)


def final_plan_of(df):
    """The plan that ran, after exchanges were shared."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["scored_report", "all_scored_stats"])
def test_report_scans_each_fact_once(spark, name):
    plan = final_plan_of(QUERIES[name](spark, SF_DIR))
    assert scans_of(plan, "lineitem") == 1
    assert scans_of(plan, "events") == 1  # one aggregate over plays, its shuffle used by both sides
    assert "ReusedExchange" in plan


def test_sheets_and_dimensions_are_scanned_less(spark):
    """Sheets twice for each use of picks (rows and verdicts), players and facts; most are shared at run time."""
    df = QUERIES["scored_report"](spark, SF_DIR)
    assert scans_of(plan_of(df), "customer") < 18
    assert scans_of(final_plan_of(df), "customer") <= 10


def test_valid_sheets_take_one_scan(spark):
    sheets = Inputs(spark, SF_DIR).sheets()
    plan = plan_of(quality.valid_sheets(sheets))
    assert scans_of(plan, "customer") == 1 and "Join" not in plan


@pytest.mark.parametrize("uses", [2, 5])
def test_uses_of_picks_share_the_check_of_the_sheets(spark, conf, uses):
    """Rows of the sheets are taken by their two values, and checked, once for all uses of the picks."""
    conf(adaptive__enabled="false")  # exchanges are shared when the plan is made
    picks = rosters.consolidate(Inputs(spark, SF_DIR).sheets(), on_violation="drop")
    parts = [picks.where(F.col("roster_index") == n).select("player_id") for n in range(uses)]
    plan = plan_of(reduce(DataFrame.union, parts))
    assert len(re.findall(r"(?:Generate explode|Expand )", plan)) == 1


def test_picks_are_measured_without_a_check_of_the_sheets(spark):
    sheets = Inputs(spark, SF_DIR).sheets()

    def jobs_of(name, build):
        spark.sparkContext.setJobGroup(name, name)
        build()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    direct = jobs_of("raw sheets", lambda: rosters.measured_picks(sheets, on_violation="drop"))
    checked = jobs_of(
        "checked sheets", lambda: measured(rosters.consolidate(sheets, on_violation="drop"))
    )
    assert 0 < direct < checked


def snapshot_rows(spark, handles=40, stamps=25):
    name = F.concat(
        F.lit("handle "), F.col("id") % handles, F.lit(", 2024-12-"), F.lpad((F.col("id") % stamps).cast("string"), 2, "0"),
        F.when(F.col("id") % 2 == 0, F.lit(" 1 UTC.parquet")).otherwise(F.lit(" 1 UTC.csv")),
    )
    path = tempfile.mkdtemp(prefix="snapshots-") + "/rows"
    spark.range(0, 20_000, 1, 4).select(name.alias("file_name"), F.col("id").alias("n")).write.parquet(path)
    return spark.read.parquet(path)


def test_snapshot_names_are_taken_apart_once_each(spark):
    """Two scans in all, one for names and one for rows; no pattern is applied to rows."""
    rows = snapshot_rows(spark)
    names = plan_of(newest_names(rows, "file_name"))
    scan, aggregate = names.index("FileScan"), names.rindex(" HashAggregate")
    assert names.count("FileScan") == 1 and names.rfind("SortAggregate") < aggregate  # rows are not sorted
    assert "RLIKE" in names and names.rindex("RLIKE") < aggregate < scan  # above the aggregate, in the tree
    assert names.rindex("regexp_extract") < aggregate
    df = latest_snapshot(rows, "file_name")
    plan = plan_of(df)
    assert plan.count("FileScan") == 1 and "RLIKE" not in plan and "regexp" not in plan
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan
    assert "In(file_name" in plan
    assert {r["snapshot_ts"] for r in df.select("snapshot_ts").distinct().collect()} <= {
        f"2024-12-{i:02} 1 UTC" for i in range(25)
    }


def test_many_newest_names_are_joined_by_a_shuffle(spark, monkeypatch):
    rows = snapshot_rows(spark)
    few = latest_snapshot(rows, "file_name")
    monkeypatch.setattr(snapshots, "HELD_NAMES", 3)
    many = latest_snapshot(rows, "file_name")
    assert "SortMergeJoin" in plan_of(many) and not few.isEmpty()
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_season_filter_reaches_the_scan(spark):
    path = tempfile.mkdtemp(prefix="seasons-") + "/plays"
    spark.createDataFrame([("REG", 1), ("PRE", 2)], "season_type string, n int").write.parquet(path)
    plan = plan_of(in_seasons(spark.read.parquet(path), ["Regular", "Post"]).select("n"))
    assert "PushedFilters: [In(season_type" in plan


def test_plays_scan_is_pruned(spark, conf):
    conf(maxMetadataStringLength="10000")
    path = tempfile.mkdtemp(prefix="plays-") + "/plays"
    Inputs(spark, SF_DIR).view("v_pbp").write.parquet(path)
    scoped = plays(spark.read.parquet(path), ["Regular"])
    plan = plan_of(count_events(events_of(scoped, DEFENSE_EVENTS)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "passer_player_id" not in schema and "sack" in schema
    assert len(schema.split(",")) <= 13


# Sizes for test data; as many partitions per hot key as a cluster would have, and more.
SKEW = {
    "adaptive__advisoryPartitionSizeInBytes": "64k",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "shuffle__partitions": "64",
}


def hot_rows(spark, n):
    """A third of the rows belong to one player, and as many have no player."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.col("id").cast("string")
    )
    return spark.range(0, n, 1, 8).select(
        key.alias("player_id"),
        F.lit("T01").alias("team_abbr"),
        F.sha2(F.col("id").cast("string"), 256).alias("detail"),
    )


def test_hot_player_is_split_when_players_are_not_broadcast(spark, conf):
    conf(**SKEW)
    n = 120_000
    people = spark.range(0, n, 2).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("p"),
    )
    people = people.select(
        F.col("p").alias("roster_player_id"),
        F.lit("T01").alias("roster_team_abbr"),
        F.lit("QB").alias("position"),
        F.col("p").alias("player_name"),
    )
    teams = spark.createDataFrame(
        [("T01", "C1", "D1")], "team_abbr string, team_conf string, team_division string"
    )
    df = describe_players(hot_rows(spark, n), teams, Dimension(people, fits=False))
    assert len(df.collect()) == n
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def test_hot_team_of_defense_picks_is_split(spark, conf):
    conf(**SKEW, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    n = 60_000
    picks = spark.range(0, n, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("fantasy_owner"),
        F.col("id").cast("string").alias("fantasy_team"),
        F.lit("x").alias("player_id"),
        F.lit(14).alias("roster_index"),
        F.lit("Defense").alias("position_type"),
        F.lit("D").alias("position_code"),
        F.when(F.col("id") % 3 == 0, "T00").otherwise(F.concat(F.lit("T"), F.col("id") % 32)).alias(
            "team_abbr"
        ),
    )
    row = dict.fromkeys(SCORED_SCHEMA.fieldNames())
    scored = spark.createDataFrame(
        [
            tuple({**row, "team_abbr": t, "player_id": NO_PLAYER, "stat_label": "s"}.values())
            for t in ("T00", "T1", "T2")
        ],
        SCORED_SCHEMA,
    )
    df = report.score_defense_picks(picks, scored)
    assert len(df.collect()) == n
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def test_measured_defense_picks_are_dealt_by_their_number(spark, monkeypatch):
    """A few kilobytes of picks with many rows each are many tasks; copies, a hot team and missing keys do no harm."""
    n, a_team = 6_000, 40
    monkeypatch.setattr(report, "SHARE_PICKS", 200, raising=False)
    picks = spark.range(0, n, 1, 1).select(
        F.lit("O 1").alias("fantasy_owner"),
        F.when(F.col("id") % 2 == 0, "copy").otherwise(F.col("id").cast("string")).alias("fantasy_team"),
        F.lit("x").alias("player_id"),
        F.lit(14).alias("roster_index"),
        F.lit("Defense").alias("position_type"),
        F.lit("D").alias("position_code"),
        F.when(F.col("id") % 3 == 0, "T00")
        .when(F.col("id") % 101 != 1, F.concat(F.lit("T"), F.col("id") % 9))
        .alias("team_abbr"),
    )
    row = dict.fromkeys(SCORED_SCHEMA.fieldNames())
    scored = spark.createDataFrame(
        [
            tuple({**row, "team_abbr": t, "player_id": NO_PLAYER, "stat_label": f"s{i}"}.values())
            for t in ("T00", "T1", "T2", "", None)
            for i in range(a_team)
        ],
        SCORED_SCHEMA,
    )
    df = report.score_defense_picks(measured(picks), scored)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < sum(sizes) / 4
    plain = report.score_defense_picks(picks, scored)
    assert sum(sizes) == plain.count() > n * a_team / 3
    assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()


def test_counts_of_a_hot_credit_are_combined_before_the_shuffle(spark):
    plan = plan_of(QUERIES["bonus_defense"](spark, SF_DIR))
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert "partial_count" in before
