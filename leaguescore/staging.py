"""League-shaped inputs derived from the test tables.

Each view is one SELECT that Spark and DuckDB both run as it stands; names in
braces are tables or other views. The test tables hold no missing values, so the
views make some, as null and as NaN. They also have a team, players and a season
type that the dimensions or the scope do not know.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # Teams of two seasons.
    "v_team_list": """
SELECT 2024 AS season, 'T' || lpad(cast(n_nationkey AS string), 2, '0') AS team, n_name AS full
FROM {nation}
UNION ALL
SELECT 2023 AS season, 'T' || lpad(cast(n_nationkey AS string), 2, '0') AS team,
    'Old ' || n_name AS full
FROM {nation}
""",
    # Every team twice.
    "v_team_desc": """
SELECT
    'T' || lpad(cast(n_nationkey AS string), 2, '0') AS team_abbr,
    r_name AS team_conf,
    r_name || ' D' || cast(n_nationkey % 4 AS string) AS team_division,
    'logo/' || lower(n_name) || '.png' AS team_logo_espn
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT
    'T' || lpad(cast(n_nationkey AS string), 2, '0') AS team_abbr,
    r_name AS team_conf,
    r_name || ' D' || cast(n_nationkey % 4 AS string) AS team_division,
    'logo/' || lower(n_name) || '.png' AS team_logo_espn
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
""",
    # Two ids are missing; one segment is out of the scoring positions.
    "v_roster": """
SELECT
    2024 AS season,
    'T' || lpad(cast(c_nationkey AS string), 2, '0') AS team,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'QB' WHEN 'BUILDING' THEN 'FB'
        WHEN 'FURNITURE' THEN 'WR' WHEN 'HOUSEHOLD' THEN 'P' ELSE 'DL' END AS position,
    'ACT' AS status,
    c_name AS full_name,
    CASE WHEN c_custkey IN (7, 57) THEN NULL ELSE cast(c_custkey AS string) END AS gsis_id
FROM {customer}
""",
    "v_offense": """
SELECT
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'QB' WHEN 'BUILDING' THEN 'FB'
        WHEN 'FURNITURE' THEN 'WR' WHEN 'HOUSEHOLD' THEN 'TE' ELSE 'P' END AS position,
    cast(month(o_orderdate) AS int) AS week,
    CASE WHEN month(o_orderdate) >= 11 THEN 'POST' WHEN month(o_orderdate) = 1 THEN 'PRE'
        ELSE 'REG' END AS season_type,
    CASE WHEN c_custkey = 107 THEN NULL ELSE cast(c_custkey AS string) END AS player_id,
    c_name AS player_name,
    'T' || lpad(cast(s_nationkey AS string), 2, '0') AS recent_team,
    l_quantity * 10 AS passing_yards,
    l_linenumber AS passing_tds,
    l_quantity * 5 - 10 AS rushing_yards,
    l_linenumber % 3 AS rushing_tds,
    CASE WHEN l_quantity = 13 THEN cast('NaN' AS double)
        ELSE nullif(l_quantity * 6 - 20, 100) END AS receiving_yards,
    l_linenumber % 2 AS receiving_tds,
    nullif(l_linenumber % 4, 3) AS interceptions,
    l_linenumber % 2 AS sack_fumbles_lost,
    l_linenumber % 3 AS rushing_fumbles_lost,
    l_linenumber % 4 AS receiving_fumbles_lost,
    l_linenumber % 5 AS passing_2pt_conversions,
    l_linenumber % 6 AS rushing_2pt_conversions,
    nullif(l_linenumber % 7, 1) AS receiving_2pt_conversions
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    JOIN {customer} ON o_custkey = c_custkey JOIN {supplier} ON l_suppkey = s_suppkey
""",
    "v_kicking": """
SELECT
    cast(month(o_orderdate) AS int) AS week,
    CASE WHEN month(o_orderdate) >= 11 THEN 'POST' WHEN month(o_orderdate) = 1 THEN 'PRE'
        ELSE 'REG' END AS season_type,
    cast(o_custkey AS string) AS player_id,
    'K' || cast(o_custkey AS string) AS player_name,
    'T' || lpad(cast(o_orderkey % 26 AS string), 2, '0') AS team,
    cast(o_orderkey % 5 AS int) AS fg_made,
    cast(o_orderkey % 3 AS int) AS fg_made_40_49,
    nullif(cast(o_orderkey % 2 AS int), 1) AS fg_made_50_59,
    cast(o_orderkey % 7 AS int) AS fg_made_60_,
    cast(o_orderkey % 4 AS int) AS fg_missed,
    cast(o_orderkey % 9 AS int) AS fg_blocked,
    cast(o_orderkey % 6 AS int) AS pat_made,
    nullif(cast(o_orderkey % 8 AS int), 5) AS pat_missed
FROM {orders}
""",
    "v_pbp": """
SELECT
    'G' || cast(user_id AS string) AS game_id,
    cast(cast(ts AS date) AS string) AS game_date,
    cast(floor((day(ts) - 1) / 7.0) AS int) AS week,
    CASE WHEN day(ts) > 21 THEN 'POST' WHEN day(ts) < 4 THEN 'PRE' ELSE 'REG' END AS season_type,
    'T' || lpad(cast(c_nationkey AS string), 2, '0') AS home_team,
    'T' || lpad(cast(event_id % 26 AS string), 2, '0') AS away_team,
    cast(floor(value) AS int) % 60 AS home_score,
    nullif(cast(event_id % 53 AS int), 52) AS away_score,
    'T' || lpad(cast(c_nationkey AS string), 2, '0') AS posteam,
    CASE WHEN event_id % 13 = 0 THEN NULL
        ELSE 'T' || lpad(cast(event_id % 26 AS string), 2, '0') END AS defteam,
    CASE event_type WHEN 'purchase' THEN 'pass' WHEN 'click' THEN 'run' WHEN 'view' THEN 'punt'
        WHEN 'signup' THEN 'kickoff' END AS play_type,
    lpad(cast(hour(ts) AS string), 2, '0') || ':' || lpad(cast(minute(ts) AS string), 2, '0') AS time,
    event_type || ' by ' || c_name AS desc,
    CASE event_type WHEN 'purchase' THEN 'Touchdown' ELSE 'Punt' END AS fixed_drive_result,
    cast(event_id % 2 AS int) AS touchdown,
    CASE WHEN event_id % 29 = 0 THEN cast('NaN' AS double)
        ELSE cast(event_id % 3 AS double) END AS pass_touchdown,
    cast(event_id % 2 AS int) AS rush_touchdown,
    cast(event_id % 4 AS int) AS return_touchdown,
    value AS yards_gained,
    value / 2 AS rushing_yards,
    CASE WHEN event_id % 19 = 0 THEN cast('NaN' AS double) ELSE nullif(value, 0.01) END AS passing_yards,
    value / 3 AS return_yards,
    'T' || lpad(cast(event_id % 26 AS string), 2, '0') AS return_team,
    cast(event_id % 7 AS int) AS interception,
    'I' || cast(user_id AS string) AS interception_player_name,
    cast(user_id + 5 AS string) AS interception_player_id,
    cast(event_id % 2 AS int) AS fumble,
    cast(event_id % 3 AS int) AS fumble_lost,
    'T' || lpad(cast(event_id % 25 AS string), 2, '0') AS fumble_recovery_1_team,
    c_name AS passer_player_name,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(user_id AS string) END AS passer_player_id,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'R' || cast(user_id AS string) END AS receiver_player_name,
    cast(user_id + 1 AS string) AS receiver_player_id,
    'U' || cast(user_id AS string) AS rusher_player_name,
    cast(user_id + 2 AS string) AS rusher_player_id,
    'S' || cast(user_id AS string) AS td_player_name,
    cast(user_id + 6 AS string) AS td_player_id,
    'K' || cast(user_id AS string) AS kicker_player_name,
    cast(user_id + 7 AS string) AS kicker_player_id,
    'KR' || cast(user_id AS string) AS kickoff_returner_player_name,
    cast(user_id + 3 AS string) AS kickoff_returner_player_id,
    'PR' || cast(user_id AS string) AS punt_returner_player_name,
    cast(user_id + 4 AS string) AS punt_returner_player_id,
    'F' || cast(user_id AS string) AS fumbled_1_player_name,
    cast(user_id + 8 AS string) AS fumbled_1_player_id,
    'FR' || cast(user_id AS string) AS fumble_recovery_1_player_name,
    cast(user_id + 9 AS string) AS fumble_recovery_1_player_id,
    CASE WHEN event_id % 23 = 0 THEN cast('NaN' AS double)
        ELSE cast(event_id % 5 AS double) END AS sack,
    'SK' || cast(user_id AS string) AS sack_player_name,
    cast(user_id + 10 AS string) AS sack_player_id,
    'H1' || cast(user_id AS string) AS half_sack_1_player_name,
    cast(user_id + 11 AS string) AS half_sack_1_player_id,
    'H2' || cast(user_id AS string) AS half_sack_2_player_name,
    cast(user_id + 12 AS string) AS half_sack_2_player_id,
    nullif(cast(event_id % 6 AS int), 3) AS safety,
    'SF' || cast(user_id AS string) AS safety_player_name,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE cast(event_id AS string) END AS safety_player_id,
    CASE WHEN event_type = 'purchase' THEN 'success' END AS two_point_conv_result,
    cast(event_id % 9 AS int) AS two_point_attempt,
    CASE WHEN event_type = 'click' THEN 'good' END AS extra_point_result,
    cast(event_id % 8 AS int) AS extra_point_attempt,
    CASE WHEN event_type = 'view' THEN 'made' END AS field_goal_result,
    cast(event_id % 10 AS int) AS field_goal_attempt,
    nullif(value * 2, 50) AS kick_distance,
    CASE WHEN event_id % 9 = 0 THEN 'B' || cast(user_id AS string) END AS blocked_player_name,
    CASE WHEN event_id % 9 = 0 THEN cast(user_id + 13 AS string) END AS blocked_player_id
FROM {events} JOIN {customer} ON user_id = c_custkey
""",
    "v_games": """
SELECT
    cast(month(o_orderdate) AS int) AS week,
    CASE WHEN month(o_orderdate) >= 11 THEN 'POST' WHEN month(o_orderdate) = 1 THEN 'PRE'
        ELSE 'REG' END AS season_type,
    'T' || lpad(cast(o_orderkey % 25 AS string), 2, '0') AS home_team,
    'T' || lpad(cast((o_orderkey + 7) % 26 AS string), 2, '0') AS away_team,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE cast(floor(o_totalprice) AS bigint) % 60 END AS home_score,
    o_custkey % 53 AS away_score
FROM {orders}
""",
    # Fourteen rows to a sheet. Some sheets repeat an id, some lack a position, some
    # share a team name, some have a missing value; the last may be short.
    "v_sheets": """
SELECT
    cast(floor(c_custkey / 14.0) AS int) AS sheet,
    CASE WHEN floor(c_custkey / 14.0) % 5 = 3 THEN 'Solo'
        ELSE 'Owner Number' || cast(cast(floor(c_custkey / 14.0) AS int) AS string) || ' Zed' END AS fantasy_owner,
    'me@example.org' AS fantasy_owner_email,
    'FT' || cast(CASE WHEN cast(floor(c_custkey / 14.0) AS int) % 10 = 7
        THEN cast(floor(c_custkey / 14.0) AS int) - 1
        ELSE cast(floor(c_custkey / 14.0) AS int) END AS string)
        || CASE WHEN floor(c_custkey / 14.0) % 20 = 9 THEN ' row ' || cast(c_custkey % 14 AS string)
            WHEN c_custkey % 280 = 181 THEN ' typo' ELSE '' END AS fantasy_team,
    CASE WHEN c_custkey % 140 = 20 THEN cast(c_custkey - 1 AS string)
        WHEN c_custkey % 14 = 13 THEN 'T' || lpad(cast(c_nationkey AS string), 2, '0')
        ELSE cast(c_custkey AS string) END AS player_id,
    cast(c_custkey % 14 AS int) + 1 AS roster_index,
    CASE WHEN c_custkey % 14 = 13 THEN 'Defense' ELSE 'Player' END AS position_type,
    CASE WHEN c_custkey % 140 = 66 THEN 'TE2' ELSE CASE cast(c_custkey % 14 AS int)
        WHEN 0 THEN 'K' WHEN 1 THEN 'QB1' WHEN 2 THEN 'QB2' WHEN 3 THEN 'QB3' WHEN 4 THEN 'RB1'
        WHEN 5 THEN 'RB2' WHEN 6 THEN 'RB3' WHEN 7 THEN 'RB4' WHEN 8 THEN 'TE1' WHEN 9 THEN 'TE2'
        WHEN 10 THEN 'WR1' WHEN 11 THEN 'WR2' WHEN 12 THEN 'WR3' ELSE 'D' END END AS position_code,
    'group ' || c_mktsegment AS position_group,
    CASE WHEN c_custkey % 280 = 13 THEN 'T99'
        ELSE 'T' || lpad(cast(c_nationkey AS string), 2, '0') END AS team_abbr,
    CASE WHEN c_custkey % 500 = 1 THEN NULL ELSE 'sel ' || c_name END AS selection,
    c_acctbal > 0 AS selection_is_unique,
    c_acctbal > 1000 AS team_is_unique
FROM {customer}
""",
    "v_snapshots": """
SELECT
    o_orderpriority || ', ' || cast(cast(o_orderdate AS date) AS string) || ' 181500 UTC.parquet' AS file_name,
    o_orderstatus,
    o_orderkey,
    o_totalprice
FROM {orders}
""",
}


def inputs_of(view: str) -> list[str]:
    """Tables a view reads."""
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[view])))


def staged(spark: SparkSession, view: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """A view over the frames that ``table`` gives for the names it reads."""
    return spark.sql(VIEWS[view], **{name: table(name) for name in inputs_of(view)})


def view_sql(view: str) -> str:
    """The view as plain SQL over tables of their own names."""
    return VIEWS[view].format(**{name: name for name in inputs_of(view)})
