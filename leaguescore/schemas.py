"""Column lists and schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and order of the published data sets ---------

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("week", T.IntegerType()),
        T.StructField("season_type", T.StringType()),
        T.StructField("team_abbr", T.StringType()),
        T.StructField("team_conf", T.StringType()),
        T.StructField("team_division", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("player_id", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("lookup_string", T.StringType()),
        T.StructField("subsequently_traded", T.BooleanType()),
        T.StructField("stat_label", T.StringType()),
        T.StructField("football_value", T.DoubleType()),
        T.StructField("fantasy_points", T.LongType()),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("roster_index", T.IntegerType()),
        T.StructField("position_code", T.StringType()),
        T.StructField("fantasy_owner", T.StringType()),
        T.StructField("fantasy_team", T.StringType()),
        T.StructField("season_type", T.StringType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("team_abbr", T.StringType()),
        T.StructField("team_conf", T.StringType()),
        T.StructField("team_division", T.StringType()),
        T.StructField("position_type", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("player_id", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("lookup_string", T.StringType()),
        T.StructField("subsequently_traded", T.BooleanType()),
        T.StructField("stat_label", T.StringType()),
        T.StructField("football_value", T.DoubleType()),
        T.StructField("fantasy_points", T.LongType()),
    ]
)

# Types of the published SQL table, where they differ from the report.
PUBLISHED_TYPES = {
    "subsequently_traded": "string",
    "football_value": "int",
    "fantasy_points": "int",
}

TEAM_COLUMNS = (
    "season",
    "team_name",
    "team_abbr",
    "team_name_w_abbr",
    "team_conf",
    "team_division",
    "position",
    "lookup_string",
    "team_logo_espn",
)

ROSTER_COLUMNS = ("season", "team_abbr", "position", "status", "player_name", "player_id")

OFFENSE_STATS = (
    "passing_yards",
    "passing_tds",
    "rushing_yards",
    "rushing_tds",
    "receiving_yards",
    "receiving_tds",
    "interceptions",
    "sack_fumbles_lost",
    "rushing_fumbles_lost",
    "receiving_fumbles_lost",
    "passing_2pt_conversions",
    "rushing_2pt_conversions",
    "receiving_2pt_conversions",
)

KICKING_STATS = (
    "fg_made",
    "fg_made_40_49",
    "fg_made_50plus",
    "fg_missed",
    "fg_blocked",
    "pat_made",
    "pat_missed",
)

STAT_IDS = ("position", "week", "season_type", "player_id", "player_name", "team_abbr")

PLAY_COLUMNS = (
    "game_id",
    "game_date",
    "week",
    "season_type",
    "home_team",
    "away_team",
    "home_score",
    "away_score",
    "posteam",
    "defteam",
    "play_type",
    "time",
    "desc",
    "fixed_drive_result",
    "touchdown",
    "pass_touchdown",
    "rush_touchdown",
    "return_touchdown",
    "yards_gained",
    "rushing_yards",
    "passing_yards",
    "return_yards",
    "return_team",
    "interception",
    "interception_player_name",
    "interception_player_id",
    "fumble",
    "fumble_lost",
    "fumble_recovery_1_team",
    "passer_player_name",
    "passer_player_id",
    "receiver_player_name",
    "receiver_player_id",
    "rusher_player_name",
    "rusher_player_id",
    "td_player_name",
    "td_player_id",
    "kicker_player_name",
    "kicker_player_id",
    "kickoff_returner_player_name",
    "kickoff_returner_player_id",
    "punt_returner_player_name",
    "punt_returner_player_id",
    "fumbled_1_player_name",
    "fumbled_1_player_id",
    "fumble_recovery_1_player_name",
    "fumble_recovery_1_player_id",
    "sack",
    "sack_player_name",
    "sack_player_id",
    "half_sack_1_player_name",
    "half_sack_1_player_id",
    "half_sack_2_player_name",
    "half_sack_2_player_id",
    "safety",
    "safety_player_name",
    "safety_player_id",
    "two_point_conv_result",
    "two_point_attempt",
    "extra_point_result",
    "extra_point_attempt",
    "field_goal_result",
    "field_goal_attempt",
    "kick_distance",
    "blocked_player_name",
    "blocked_player_id",
)

# Header of a roster sheet, in order, and the name each column has in the report.
SHEET_HEADERS = {
    "Fantasy Owner": "fantasy_owner",
    "Fantasy Owner Email": "fantasy_owner_email",
    "Fantasy Team Name": "fantasy_team",
    "Automation Mapping": "player_id",
    "Roster": "roster_index",
    "Position Type": "position_type",
    "Position Code": "position_code",
    "Position Group": "position_group",
    "Team Abbr.": "team_abbr",
    "Selection": "selection",
    "Check 1 - Selection is Unique": "selection_is_unique",
    "Check 2 - Team is Unique": "team_is_unique",
}

# Types of the sheet columns that are not text.
SHEET_TYPES = {
    "roster_index": "int",
    "selection_is_unique": "boolean",
    "team_is_unique": "boolean",
}

# Dropped at consolidation: personal data and the sheet's own helper columns.
SHEET_DROPPED = (
    "Fantasy Owner Email",
    "Position Group",
    "Selection",
    "Check 1 - Selection is Unique",
    "Check 2 - Team is Unique",
)

PICK_HEADERS = {
    header: name for header, name in SHEET_HEADERS.items() if header not in SHEET_DROPPED
}

PICK_COLUMNS = tuple(PICK_HEADERS.values())

TEAM_LIST_SCHEMA = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("team", T.StringType()),
        T.StructField("full", T.StringType()),
    ]
)

SHEET_ROWS = 14

MINIMUM_POSITIONS = (
    "K",
    "QB1",
    "QB2",
    "QB3",
    "RB1",
    "RB2",
    "RB3",
    "TE1",
    "TE2",
    "WR1",
    "WR2",
    "WR3",
    "D",
)

EXTRA_POSITIONS = ("RB4", "WR4", "TE3")

# What a bonus is counted by.
EVENT_KEYS = ("week", "season_type", "team_abbr", "player_name", "player_id", "stat_label")

SEASON_LABELS = {"REG": "Regular", "POST": "Post"}

ROSTER_POSITIONS = ("QB", "P", "K", "TE", "RB", "FB", "WR")

OFFENSE_POSITIONS = ("QB", "RB", "FB", "WR", "TE")

BONUS_POSITIONS = ("QB", "RB", "WR", "TE")

DEFENSE_POSITION = "Defense"

DEFENSE_PICK = "D"

NO_PLAYER = "N/A"

# --- end of fixed values -----------------------------------------------------

# What a scan of sheet files adds to a sheet's own columns: its file's name, whether the file has the columns
# of a sheet, and whether this is one of its rows or stands for a file without any.
SHEET_MARKS = ("sheet", "columns_ok", "is_row")

SCORED_COLUMNS = tuple(SCORED_SCHEMA.fieldNames())

REPORT_COLUMNS = tuple(REPORT_SCHEMA.fieldNames())
