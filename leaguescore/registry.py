"""One query per operator, over the staging views and whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguescore.functions import (
    add_constants,
    differs,
    exact_long,
    fill_zero,
    floor_div,
    in_seasons,
    is_not,
    nan_to_null,
    not_in,
    player_label,
    recode,
    short_owner,
    true_if_missing,
)
from leaguescore.operators import quality
from leaguescore.operators.events import count_events, events_of
from leaguescore.operators.joins import Dimension, counted, describe_players, join_teams, measured, people_dimension
from leaguescore.operators.reshape import melt, melt_scored, points_against, union_all
from leaguescore.plans import bonuses, dimensions, report, rosters, stats
from leaguescore.rules import (
    DEFENSE_EVENTS,
    KICKING_RULES,
    OFFENSE_EVENTS,
    OFFENSE_RULES,
    POINTS_ALLOWED_BANDS,
    FloorDiv,
    compile_bands,
    scores_by_label,
)
from leaguescore.schemas import (
    BONUS_POSITIONS,
    DEFENSE_POSITION,
    EVENT_KEYS,
    KICKING_STATS,
    NO_PLAYER,
    OFFENSE_STATS,
    SEASON_LABELS,
    STAT_IDS,
)
from leaguescore.sources import latest_snapshot, snapshot_freshness, snapshot_manifest
from leaguescore.staging import staged

SEASON = 2024
SEASONS = ("Regular", "Post")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


class Inputs:
    """Staged frames and dimensions of one data folder, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.table = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        self.view = cache(lambda name: staged(spark, name, self.table))

    def teams(self) -> Dimension:
        return measured(
            dimensions.teams(self.view("v_team_list"), self.view("v_team_desc"), SEASON)
        )

    def players(self, teams: Dimension) -> DataFrame:
        return dimensions.players(self.view("v_roster"), teams)

    def offense(self) -> DataFrame:
        return stats.offense_wide(self.view("v_offense"), SEASONS)

    def kicking(self) -> DataFrame:
        return stats.kicking_wide(self.view("v_kicking"), SEASONS)

    def plays(self) -> DataFrame:
        return bonuses.plays(self.view("v_pbp"), SEASONS)

    def games(self) -> DataFrame:
        return in_seasons(self.view("v_games"), SEASONS)

    def sheets(self) -> DataFrame:
        return self.view("v_sheets")

    def picks(self) -> DataFrame:
        return rosters.drop_personal(self.sheets())

    def league(self) -> report.League:
        teams = self.teams()
        return report.League(
            offense=self.view("v_offense"),
            kicking=self.view("v_kicking"),
            plays=self.plays(),
            games=self.view("v_games"),
            teams=teams,
            players=self.players(teams),
            seasons=SEASONS,
        )


# Sources


@query
def scan_parquet(spark, sf_dir):
    columns = ("game_id", "week", "season_type", "posteam", "defteam", "play_type")
    return Inputs(spark, sf_dir).view("v_pbp").select(*columns)


@query
def latest_snapshot_(spark, sf_dir):
    rows = Inputs(spark, sf_dir).view("v_snapshots")
    return latest_snapshot(rows.select("file_name", "o_orderkey", "o_totalprice"), "file_name")


@query
def snapshot_freshness_(spark, sf_dir):
    """The local copies are those of finished orders; one handle has none."""
    rows = Inputs(spark, sf_dir).view("v_snapshots")
    local = rows.where((F.col("o_orderstatus") == "F") & ~F.col("file_name").startswith("5-LOW"))
    return snapshot_freshness(
        snapshot_manifest(rows, "file_name"), snapshot_manifest(local, "file_name")
    )


# Projections


@query
def project_columns(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_offense")
    return nan_to_null(raw.withColumnRenamed("recent_team", "team_abbr")).select(
        *STAT_IDS, *OFFENSE_STATS
    )


@query
def rename_columns(spark, sf_dir):
    return (
        Inputs(spark, sf_dir)
        .view("v_roster")
        .withColumnsRenamed(
            {"team": "team_abbr", "full_name": "player_name", "gsis_id": "player_id"}
        )
    )


@query
def drop_pii_columns(spark, sf_dir):
    return Inputs(spark, sf_dir).picks()


@query
def literal_columns(spark, sf_dir):
    games = Inputs(spark, sf_dir).view("v_games")
    return add_constants(
        games.select("week", "home_team"),
        {"position": DEFENSE_POSITION, "player_id": NO_PLAYER, "subsequently_traded": False},
    )


@query
def derived_sum(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_kicking")
    return raw.select(
        "player_id",
        "week",
        "fg_made_50_59",
        "fg_made_60_",
        (F.col("fg_made_50_59") + F.col("fg_made_60_")).alias("fg_made_50plus"),
    )


@query
def recode_season_type(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_offense")
    return raw.select(
        "player_id", "week", recode(F.col("season_type"), SEASON_LABELS).alias("season_type")
    )


@query
def recode_position(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_roster")
    return raw.select(
        "gsis_id",
        recode(F.col("position"), {"P": "K"}).alias("roster_position"),
        recode(F.col("position"), {"FB": "RB"}).alias("stat_position"),
    )


@query
def lookup_string(spark, sf_dir):
    """Labels of kickers' stat rows: null where the team has no division."""
    inputs = Inputs(spark, sf_dir)
    rows = join_teams(inputs.kicking(), inputs.teams(), "team_division")
    return rows.select(
        "player_id",
        "week",
        player_label(
            F.col("position"), F.col("team_abbr"), F.col("player_name"), F.col("team_division")
        ).alias("lookup_string"),
    )


@query
def fill_missing(spark, sf_dir):
    raw = nan_to_null(Inputs(spark, sf_dir).view("v_offense"))
    filled = ("receiving_yards", "interceptions", "receiving_2pt_conversions")
    return raw.select("player_id", "week", *[fill_zero(F.col(c)).alias(c) for c in filled])


@query
def cast_points(spark, sf_dir):
    raw = nan_to_null(Inputs(spark, sf_dir).view("v_offense"))
    return raw.select(
        "player_id",
        "week",
        exact_long(F.col("receiving_yards")).alias("whole_yards"),
        true_if_missing(F.col("interceptions") > 0).alias("flag"),
    )


@query
def truncate_owner(spark, sf_dir):
    sheets = Inputs(spark, sf_dir).sheets()
    return sheets.select(
        "sheet", "roster_index", short_owner(F.col("fantasy_owner")).alias("fantasy_owner")
    )


@query
def floor_div_(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_offense")
    return raw.select(
        "player_id",
        "week",
        floor_div(F.col("passing_yards"), 50).alias("passing_points"),
        floor_div(F.col("rushing_yards"), 10).alias("rushing_points"),
    )


# Filters


@query
def filter_season(spark, sf_dir):
    return Inputs(spark, sf_dir).view("v_team_list").where(F.col("season") == SEASON)


@query
def filter_isin(spark, sf_dir):
    scoped = in_seasons(Inputs(spark, sf_dir).view("v_offense"), ("Regular",))
    return scoped.where(F.col("position").isin(*BONUS_POSITIONS)).select(
        "player_id", "week", "season_type", "position", "passing_tds"
    )


@query
def filter_not_in(spark, sf_dir):
    plays = Inputs(spark, sf_dir).plays()
    return plays.where(not_in(F.col("play_type"), ("pass", "run"))).select(
        "game_id", "play_type", "posteam", "yards_gained"
    )


@query
def filter_big_plays(spark, sf_dir):
    plays = Inputs(spark, sf_dir).plays()
    return plays.where((F.col("pass_touchdown") == 1) & (F.col("passing_yards") >= 40)).select(
        "game_id", "week", "posteam", "passer_player_id", "passing_yards"
    )


@query
def filter_null_safe_ne(spark, sf_dir):
    plays = Inputs(spark, sf_dir).plays()
    return plays.where(is_not(F.col("play_type"), "punt")).select(
        "game_id", "week", "play_type", "defteam"
    )


@query
def filter_not_null(spark, sf_dir):
    plays = Inputs(spark, sf_dir).plays()
    return plays.where(
        F.col("safety_player_id").isNotNull() & F.col("blocked_player_name").isNotNull()
    ).select("game_id", "week", "safety_player_id", "blocked_player_name")


@query
def split_by_predicate(spark, sf_dir):
    picks = Inputs(spark, sf_dir).picks()
    players = picks.where("NOT (position_code <=> 'D')").withColumn("part", F.lit("player"))
    defenses = picks.where("position_code = 'D'").withColumn("part", F.lit("defense"))
    return union_all(players, defenses)


# Joins


@query
def join_team_dim(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return join_teams(inputs.kicking(), inputs.teams()).select(
        "week", "season_type", "team_abbr", "team_conf", "team_division", "player_id", "fg_made"
    )


@query
def join_player_dim(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    teams = inputs.teams()
    people = people_dimension(inputs.players(teams))
    return describe_players(inputs.offense(), teams, people).select(
        "week", "team_abbr", "player_id", "position", "player_name", "passing_yards"
    )


@query
def join_null_safe(spark, sf_dir):
    """Offense rows without an id, with the rostered players without an id, and all others."""
    inputs = Inputs(spark, sf_dir)
    rostered = measured(
        inputs.view("v_roster").select(F.col("gsis_id").alias("rostered_id"), "full_name")
    )
    rows = inputs.offense().select("player_id", "week", "passing_yards")
    return rows.join(
        rostered.side(rostered.frame),
        F.col("player_id").eqNullSafe(F.col("rostered_id")),
        "left",
    ).select("player_id", "week", "passing_yards", "full_name")


@query
def score_player_picks(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    teams = inputs.teams()
    scored = stats.kicker_stats(
        inputs.view("v_kicking"), SEASONS, inputs.players(teams), teams
    )
    return report.score_player_picks(inputs.picks(), scored)


@query
def score_defense_picks(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    scored = stats.points_allowed(inputs.view("v_games"), SEASONS, inputs.teams())
    return report.score_defense_picks(counted(inputs.picks()), scored)


@query
def join_fanout(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    picks = measured(inputs.picks().select("fantasy_team", "roster_index", "player_id"))
    return inputs.kicking().join(picks.side(picks.frame), "player_id").select(
        "fantasy_team", "roster_index", "player_id", "week", "fg_made"
    )


@query
def trade_flag(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    people = people_dimension(inputs.players(inputs.teams()))
    return (
        inputs.kicking()
        .select("player_id", "week", "team_abbr")
        .join(
            people.side(people.frame.select("roster_player_id", "roster_team_abbr")),
            F.col("player_id").eqNullSafe(F.col("roster_player_id")),
            "left",
        )
        .select(
            "player_id",
            "week",
            "team_abbr",
            "roster_team_abbr",
            differs(F.col("team_abbr"), F.col("roster_team_abbr")).alias("subsequently_traded"),
        )
    )


# Aggregation, distinct, validation


@query
def event_count_player(spark, sf_dir):
    return count_events(events_of(Inputs(spark, sf_dir).plays(), OFFENSE_EVENTS)).select(
        *EVENT_KEYS, "football_value"
    )


@query
def event_count_team(spark, sf_dir):
    return count_events(events_of(Inputs(spark, sf_dir).plays(), DEFENSE_EVENTS)).select(
        "week", "season_type", "team_abbr", "stat_label", "football_value"
    )


@query
def distinct_rows(spark, sf_dir):
    games = Inputs(spark, sf_dir).view("v_games")
    return games.select("week", "season_type", "away_team", "home_score").distinct()


def sheet_check(spark: SparkSession, sf_dir: str, ok: Column) -> DataFrame:
    facts = quality.sheet_facts(Inputs(spark, sf_dir).sheets())
    return facts.select("sheet", ok.alias("ok"))


@query
def sheet_check_length(spark, sf_dir):
    return sheet_check(spark, sf_dir, quality.length_ok())


@query
def sheet_check_unique_ids(spark, sf_dir):
    return sheet_check(spark, sf_dir, quality.unique_ids_ok())


@query
def sheet_check_team_name(spark, sf_dir):
    facts = quality.sheet_facts(Inputs(spark, sf_dir).sheets())
    return facts.select(
        "sheet",
        quality.team_name_ok().alias("ok"),
        quality.team_name_ok(strict=True).alias("ok_strict"),
    )


@query
def sheet_check_cross_unique(spark, sf_dir):
    facts = quality.sheet_facts(Inputs(spark, sf_dir).sheets())
    return quality.with_cross_unique(facts).select("sheet", F.col("cross_unique").alias("ok"))


@query
def sheet_check_min_positions(spark, sf_dir):
    return sheet_check(spark, sf_dir, quality.min_positions_ok())


@query
def sheet_check_extra_position(spark, sf_dir):
    return sheet_check(spark, sf_dir, quality.extra_position_ok())


@query
def sheet_check_nulls(spark, sf_dir):
    return sheet_check(spark, sf_dir, quality.nulls_ok())


@query
def sheet_violations(spark, sf_dir):
    return quality.sheet_violations(Inputs(spark, sf_dir).sheets())


@query
def audit_counts(spark, sf_dir):
    """Each source's own counts; null where a condition means nothing for it."""
    inputs = Inputs(spark, sf_dir)
    league = inputs.league()
    people = people_dimension(league.players)
    teams, bonus = league.teams, bonuses.bonus_counts(league.plays, OFFENSE_EVENTS)
    parts = {
        "offense": (describe_players(inputs.offense(), teams, people), len(OFFENSE_STATS)),
        "kicking": (describe_players(inputs.kicking(), teams, people), len(KICKING_STATS)),
        "player_bonus": (bonuses.describe_player_bonus(bonus, teams, people), 1),
        "points_allowed": (stats.points_allowed(league.games, SEASONS, teams), 1),
    }
    counts = [quality.audit_counts(df, name, copies) for name, (df, copies) in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)


# Set operations, reshape, sort


@query
def union_all_stats(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return union_all(
        melt(inputs.offense(), STAT_IDS, OFFENSE_STATS),
        melt(inputs.kicking(), STAT_IDS, KICKING_STATS),
    )


@query
def points_against_(spark, sf_dir):
    return points_against(Inputs(spark, sf_dir).games())


@query
def melt_offense(spark, sf_dir):
    return melt(Inputs(spark, sf_dir).offense(), STAT_IDS, OFFENSE_STATS)


@query
def melt_kicking(spark, sf_dir):
    return melt(Inputs(spark, sf_dir).kicking(), STAT_IDS, KICKING_STATS)


@query
def sort_roster(spark, sf_dir):
    raw = Inputs(spark, sf_dir).view("v_roster")
    return raw.orderBy(F.col("position").asc_nulls_last(), F.col("gsis_id").asc_nulls_last())


# Scoring rules


def score(df: DataFrame, stat_columns, rules) -> DataFrame:
    return melt_scored(df, ("player_id", "week"), stat_columns, scores_by_label(rules))


@query
def score_yardage(spark, sf_dir):
    rules = [r for r in OFFENSE_RULES if isinstance(r, FloorDiv)]
    return score(Inputs(spark, sf_dir).offense(), [r.label for r in rules], rules)


@query
def score_linear(spark, sf_dir):
    rules = [r for r in OFFENSE_RULES if not isinstance(r, FloorDiv)]
    return score(Inputs(spark, sf_dir).offense(), [r.label for r in rules], rules)


@query
def score_kicking(spark, sf_dir):
    return score(Inputs(spark, sf_dir).kicking(), KICKING_STATS, KICKING_RULES)


@query
def score_bands(spark, sf_dir):
    games = Inputs(spark, sf_dir).view("v_games")
    return games.select(
        "week",
        "home_team",
        "home_score",
        compile_bands(POINTS_ALLOWED_BANDS, "home_score").alias("fantasy_points"),
    )


@query
def bonus_offense(spark, sf_dir):
    return bonuses.bonus_counts(Inputs(spark, sf_dir).plays(), OFFENSE_EVENTS)


@query
def bonus_defense(spark, sf_dir):
    return bonuses.bonus_counts(Inputs(spark, sf_dir).plays(), DEFENSE_EVENTS).drop(
        "player_id", "player_name"
    )


# Composite operators


@query
def dim_teams(spark, sf_dir):
    return Inputs(spark, sf_dir).teams().frame


@query
def dim_players(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return inputs.players(inputs.teams())


@query
def offense_stats(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    teams = inputs.teams()
    return stats.offense_stats(inputs.view("v_offense"), SEASONS, inputs.players(teams), teams)


@query
def kicker_stats(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    teams = inputs.teams()
    return stats.kicker_stats(inputs.view("v_kicking"), SEASONS, inputs.players(teams), teams)


@query
def plays(spark, sf_dir):
    return Inputs(spark, sf_dir).plays()


@query
def offense_bonus(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    teams = inputs.teams()
    return bonuses.offense_bonus(inputs.plays(), inputs.players(teams), teams)


@query
def defense_bonus(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return bonuses.defense_bonus(inputs.plays(), inputs.teams())


@query
def defense_points_allowed(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    return stats.points_allowed(inputs.view("v_games"), SEASONS, inputs.teams())


@query
def consolidated_rosters(spark, sf_dir):
    return rosters.consolidate(Inputs(spark, sf_dir).sheets(), on_violation="drop")


@query
def all_scored_stats(spark, sf_dir):
    return report.all_scored_stats(Inputs(spark, sf_dir).league())


@query
def scored_report(spark, sf_dir):
    """The flagship: valid rosters with every scored row of their picks."""
    inputs = Inputs(spark, sf_dir)
    picks = rosters.measured_picks(inputs.sheets(), on_violation="drop")
    return report.league_report(picks, inputs.league())


@query
def publish_contract(spark, sf_dir):
    return quality.contract_violations(scored_report(spark, sf_dir))
