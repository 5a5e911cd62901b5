"""ANSI SQL that gives the same rows as each registered query.

Written from the rules themselves, filter by filter and stat by stat, and not
from the Spark plans, so that the two can disagree.
"""

from __future__ import annotations

import re

from leaguescore.staging import VIEWS, view_sql

# --- fixed values: the rules, as SQL -----------------------------------------

YARDAGE_POINTS = {
    "passing_yards": "floor({v} / 50) + CASE WHEN {v} >= 400 THEN 2 ELSE 0 END",
    "rushing_yards": "floor({v} / 10) + CASE WHEN {v} >= 200 THEN 2 ELSE 0 END",
    "receiving_yards": "floor({v} / 10) + CASE WHEN {v} >= 200 THEN 2 ELSE 0 END",
}

LINEAR_POINTS = {
    "passing_tds": "{v} * 6",
    "rushing_tds": "{v} * 6",
    "receiving_tds": "{v} * 6",
    "passing_2pt_conversions": "{v} * 2",
    "rushing_2pt_conversions": "{v} * 2",
    "receiving_2pt_conversions": "{v} * 2",
    "interceptions": "{v} * -2",
    "sack_fumbles_lost": "{v} * -2",
    "rushing_fumbles_lost": "{v} * -2",
    "receiving_fumbles_lost": "{v} * -2",
}

KICKING_POINTS = {
    "fg_made": "{v} * 3",
    "fg_made_40_49": "{v} * 1",
    "fg_made_50plus": "{v} * 2",
    "fg_missed": "0",
    "fg_blocked": "0",
    "pat_made": "{v} * 1",
    "pat_missed": "{v} * -1",
}

PLAYER_BONUSES = [
    ("forty_yd_plus_passing_td_qb_bonus", "pass_touchdown = 1 AND passing_yards >= 40", "posteam", "passer"),
    ("forty_yd_plus_passing_td_receiver_bonus", "pass_touchdown = 1 AND passing_yards >= 40", "posteam", "receiver"),
    ("forty_yd_plus_rushing_td_bonus", "rush_touchdown = 1 AND rushing_yards >= 40", "posteam", "rusher"),
    (
        "forty_yd_plus_kickoff_return_td_bonus",
        "play_type = 'kickoff' AND return_touchdown = 1 AND return_yards >= 40",
        "posteam",
        "kickoff_returner",
    ),
    (
        "forty_yd_plus_punt_return_td_bonus",
        "play_type = 'punt' AND return_touchdown = 1 AND return_yards >= 40",
        "defteam",
        "punt_returner",
    ),
]

TEAM_BONUSES = [
    ("sack_bonus", "sack = 1", "defteam", 1),
    ("safety_bonus", "safety = 1 AND safety_player_id IS NOT NULL", "defteam", 1),
    (
        "fumble_recovery_bonus",
        "fumble = 1 AND fumble_lost = 1 AND play_type IS DISTINCT FROM 'punt'",
        "defteam",
        2,
    ),
    ("fumble_recovery_punt_bonus", "fumble = 1 AND fumble_lost = 1 AND play_type = 'punt'", "posteam", 2),
    ("interception_bonus", "interception = 1", "defteam", 2),
    ("block_bonus", "blocked_player_name IS NOT NULL", "defteam", 2),
    ("def_td_return_bonus", "return_touchdown = 1 AND play_type IN ('pass', 'run')", "defteam", 6),
    ("punt_def_td_return_bonus", "return_touchdown = 1 AND play_type = 'punt'", "defteam", 6),
    ("kickoff_def_td_return_bonus", "return_touchdown = 1 AND play_type = 'kickoff'", "posteam", 6),
]

BAND_CASE = """CASE WHEN {v} = 0 THEN 10 WHEN {v} BETWEEN 1 AND 6 THEN 7 WHEN {v} BETWEEN 7 AND 13 THEN 4
    WHEN {v} BETWEEN 14 AND 17 THEN 1 WHEN {v} BETWEEN 18 AND 21 THEN 0 WHEN {v} BETWEEN 22 AND 27 THEN -1
    WHEN {v} BETWEEN 28 AND 34 THEN -4 WHEN {v} BETWEEN 35 AND 45 THEN -7 WHEN {v} >= 46 THEN -10 END"""

MINIMUM_CODES = "('K', 'QB1', 'QB2', 'QB3', 'RB1', 'RB2', 'RB3', 'TE1', 'TE2', 'WR1', 'WR2', 'WR3', 'D')"

ALLOWED_CODES = (
    "('K', 'QB1', 'QB2', 'QB3', 'RB1', 'RB2', 'RB3', 'TE1', 'TE2', 'WR1', 'WR2', 'WR3', 'D',"
    " 'RB4', 'WR4', 'TE3')"
)

REPORT = [
    "roster_index", "position_code", "fantasy_owner", "fantasy_team", "season_type", "week",
    "team_abbr", "team_conf", "team_division", "position_type", "position", "player_id",
    "player_name", "lookup_string", "subsequently_traded", "stat_label", "football_value",
    "fantasy_points",
]

# --- end of fixed values -----------------------------------------------------

OFFENSE_POINTS = {**YARDAGE_POINTS, **LINEAR_POINTS}

SEASON_CASE = "CASE season_type WHEN 'REG' THEN 'Regular' WHEN 'POST' THEN 'Post' ELSE season_type END"

LABEL = "{t}.position || ', ' || {s}.team_abbr || ': ' || {t}.player_name || ' (' || {s}.team_division || ')'"


def melted(source: str, ids: str, stats, keep_missing: bool = True) -> str:
    value = "cast({s} AS double)" if keep_missing else "coalesce(cast({s} AS double), 0)"
    return "\nUNION ALL\n".join(
        f"SELECT {ids}, '{s}' AS stat_label, {value.format(s=s)} AS football_value FROM {source}"
        for s in stats
    )


def scored(source: str, ids: str, points: dict[str, str]) -> str:
    branches = []
    for stat, rule in points.items():
        value = f"coalesce(cast({stat} AS double), 0)"
        branches.append(
            f"SELECT {ids}, '{stat}' AS stat_label, {value} AS football_value,"
            f" cast({rule.format(v=value)} AS bigint) AS fantasy_points FROM {source}"
        )
    return "\nUNION ALL\n".join(branches)


STAT_IDS = "position, week, season_type, player_id, player_name, team_abbr"

SCORED = (
    "week, season_type, team_abbr, team_conf, team_division, position, player_id, player_name,"
    " lookup_string, subsequently_traded, stat_label, football_value, fantasy_points"
)


def player_rows(source: str) -> str:
    """Scored rows with their team and player columns, as a left join would give them."""
    return f"""
SELECT s.week, s.season_type, s.team_abbr, s.team_conf, s.team_division, p.position, s.player_id,
    p.player_name, {LABEL.format(t="p", s="s")} AS lookup_string,
    coalesce(s.team_abbr <> p.team_abbr, true) AS subsequently_traded,
    s.stat_label, s.football_value, s.fantasy_points
FROM (SELECT x.*, t.team_conf, t.team_division FROM {source} x LEFT JOIN c_teams t ON x.team_abbr = t.team_abbr) s
LEFT JOIN c_players p ON s.player_id IS NOT DISTINCT FROM p.player_id"""


def defense_rows(source: str) -> str:
    return f"""
SELECT x.week, x.season_type, x.team_abbr, t.team_conf, t.team_division, 'Defense' AS position,
    'N/A' AS player_id, t.team_name AS player_name, t.lookup_string, false AS subsequently_traded,
    x.stat_label, x.football_value, x.fantasy_points
FROM {source} x LEFT JOIN c_teams t ON x.team_abbr = t.team_abbr"""


def bonus_branch(label: str, when: str, team: str, role: str) -> str:
    player_id, name = f"{role}_player_id", f"{role}_player_name"
    return f"""
SELECT week, season_type, {team} AS team_abbr, {name} AS player_name, {player_id} AS player_id,
    '{label}' AS stat_label, cast(count(*) AS double) AS football_value, count(*) * 2 AS fantasy_points
FROM c_plays
WHERE {when} AND week IS NOT NULL AND season_type IS NOT NULL AND {team} IS NOT NULL
    AND {name} IS NOT NULL AND {player_id} IS NOT NULL
GROUP BY ALL"""


def team_bonus_branch(label: str, when: str, team: str, weight: int) -> str:
    return f"""
SELECT week, season_type, {team} AS team_abbr, '{label}' AS stat_label,
    cast(count(*) AS double) AS football_value, count(*) * {weight} AS fantasy_points
FROM c_plays
WHERE {when} AND week IS NOT NULL AND season_type IS NOT NULL AND {team} IS NOT NULL
GROUP BY week, season_type, {team}"""


def report_rows(picks: str, rows: str) -> tuple[str, str]:
    own = ["roster_index", "position_code", "fantasy_owner", "fantasy_team", "position_type"]
    player = ", ".join(f"p.{c}" if c in own else f"s.{c}" for c in REPORT)
    defense = ", ".join(
        "coalesce(s.subsequently_traded, true) AS subsequently_traded"
        if c == "subsequently_traded"
        else f"p.{c}" if c in own or c == "team_abbr" else f"s.{c}"
        for c in REPORT
    )
    return (
        f"SELECT {player} FROM {picks} p JOIN {rows} s ON p.player_id IS NOT DISTINCT FROM s.player_id"
        " WHERE p.position_code IS DISTINCT FROM 'D' AND s.player_id IS DISTINCT FROM 'N/A'"
        " AND s.stat_label IS NOT NULL",
        f"SELECT {defense} FROM (SELECT * FROM {picks} WHERE position_code = 'D') p"
        f" LEFT JOIN (SELECT * FROM {rows} WHERE player_id = 'N/A') s"
        " ON p.team_abbr IS NOT DISTINCT FROM s.team_abbr",
    )


PICKS = "fantasy_owner, fantasy_team, player_id, roster_index, position_type, position_code, team_abbr"

COMMON = {
    "c_teams": """
SELECT l.season, l."full" AS team_name, l.team AS team_abbr, l."full" || ' (' || l.team || ')' AS team_name_w_abbr,
    d.team_conf, d.team_division, 'Defense' AS position,
    'Defense, ' || l.team || ' (' || d.team_division || ')' AS lookup_string, d.team_logo_espn
FROM v_team_list l LEFT JOIN (SELECT DISTINCT * FROM v_team_desc) d ON l.team = d.team_abbr
WHERE l.season = 2024""",
    "c_rostered": """
SELECT season, team AS team_abbr, CASE WHEN position = 'P' THEN 'K' ELSE position END AS position, status,
    full_name AS player_name, gsis_id AS player_id
FROM v_roster WHERE position IN ('QB', 'P', 'K', 'TE', 'RB', 'FB', 'WR')""",
    "c_players": f"""
SELECT r.*, t.team_name, t.team_name_w_abbr, t.team_conf, t.team_division,
    {LABEL.format(t="r", s="r").replace("r.team_division", "t.team_division")} AS lookup_string
FROM c_rostered r LEFT JOIN c_teams t ON r.team_abbr = t.team_abbr""",
    "c_offense": f"""
SELECT position, week, {SEASON_CASE} AS season_type, player_id, player_name, recent_team AS team_abbr,
    * EXCLUDE (position, week, season_type, player_id, player_name, recent_team)
    REPLACE (CASE WHEN isnan(receiving_yards) THEN NULL ELSE receiving_yards END AS receiving_yards)
FROM v_offense
WHERE season_type IN ('REG', 'POST') AND position IN ('QB', 'RB', 'FB', 'WR', 'TE')""",
    "c_kicking": f"""
SELECT 'K' AS position, week, {SEASON_CASE} AS season_type, player_id, player_name, team AS team_abbr,
    fg_made, fg_made_40_49, fg_made_50_59 + fg_made_60_ AS fg_made_50plus, fg_missed, fg_blocked,
    pat_made, pat_missed
FROM v_kicking
WHERE season_type IN ('REG', 'POST')""",
    "c_plays": f"""
SELECT * REPLACE ({SEASON_CASE} AS season_type,
    CASE WHEN NOT isnan(passing_yards) THEN passing_yards END AS passing_yards,
    CASE WHEN NOT isnan(pass_touchdown) THEN pass_touchdown END AS pass_touchdown,
    CASE WHEN NOT isnan(sack) THEN sack END AS sack)
FROM v_pbp
WHERE season_type IN ('REG', 'POST')""",
    "c_against": f"""
SELECT DISTINCT week, {SEASON_CASE} AS season_type, home_team AS team_abbr, cast(away_score AS double) AS football_value
FROM v_games WHERE season_type IN ('REG', 'POST')
UNION ALL
SELECT DISTINCT week, {SEASON_CASE} AS season_type, away_team AS team_abbr, cast(home_score AS double) AS football_value
FROM v_games WHERE season_type IN ('REG', 'POST')""",
    "c_allowed": f"""
SELECT *, 'def_points_allowed' AS stat_label,
    cast({BAND_CASE.format(v="football_value")} AS bigint) AS fantasy_points
FROM c_against""",
    "c_offense_scored": scored("c_offense", STAT_IDS, OFFENSE_POINTS),
    "c_kicking_scored": scored("c_kicking", STAT_IDS, KICKING_POINTS),
    "c_player_bonus": "\nUNION ALL\n".join(bonus_branch(*b) for b in PLAYER_BONUSES),
    "c_team_bonus": "\nUNION ALL\n".join(team_bonus_branch(*b) for b in TEAM_BONUSES),
    "c_offense_stats": player_rows("c_offense_scored"),
    "c_kicker_stats": player_rows("c_kicking_scored"),
    "c_bonus_rows": f"""
SELECT * REPLACE (CASE WHEN position = 'FB' THEN 'RB' ELSE position END AS position)
FROM ({player_rows("c_player_bonus")}) b""",
    "c_offense_bonus": "SELECT * FROM c_bonus_rows WHERE position IN ('QB', 'RB', 'WR', 'TE')",
    "c_defense_bonus": defense_rows("c_team_bonus"),
    "c_points_allowed": defense_rows("c_allowed"),
    "c_all_scored": "\nUNION ALL\n".join(
        f"SELECT {SCORED} FROM {part}"
        for part in (
            "c_offense_stats",
            "c_offense_bonus",
            "c_kicker_stats",
            "c_points_allowed",
            "c_defense_bonus",
        )
    ),
    "c_names": """
SELECT sheet, coalesce(min(fantasy_team) FILTER (WHERE roster_index = 2), min(fantasy_team)) AS name
FROM v_sheets GROUP BY sheet""",
    "c_checks": f"""
SELECT s.sheet,
    count(*) = 14 AS "length",
    count(DISTINCT coalesce(s.player_id, '(missing)')) = count(*) AS unique_ids,
    count(DISTINCT coalesce(s.fantasy_team, '(missing)')) < count(*) AS team_name,
    count(DISTINCT coalesce(s.fantasy_team, '(missing)')) = 1 AS team_name_strict,
    max(n.name) NOT IN (SELECT name FROM c_names GROUP BY name HAVING count(*) > 1) AS cross_unique,
    count(DISTINCT s.position_code) FILTER (WHERE s.position_code IN {MINIMUM_CODES}) = 13 AS min_positions,
    count(*) FILTER (WHERE s.position_code IS NULL OR s.position_code NOT IN {MINIMUM_CODES}) = 1
        AND count(*) FILTER (WHERE s.position_code IS NULL OR s.position_code NOT IN {ALLOWED_CODES}) = 0
        AS extra_position,
    count(*) FILTER (WHERE s.fantasy_owner IS NULL OR s.fantasy_owner_email IS NULL
        OR s.fantasy_team IS NULL OR s.player_id IS NULL OR s.roster_index IS NULL
        OR s.position_type IS NULL OR s.position_code IS NULL OR s.position_group IS NULL
        OR s.team_abbr IS NULL OR s.selection IS NULL OR s.selection_is_unique IS NULL
        OR s.team_is_unique IS NULL) = 0 AS nulls
FROM v_sheets s JOIN c_names n ON s.sheet = n.sheet
GROUP BY s.sheet""",
    "c_picks": f"SELECT {PICKS} FROM v_sheets",
    "c_consolidated": f"""
SELECT * REPLACE (nullif(regexp_extract(fantasy_owner, '(^.* .)', 1), '') AS fantasy_owner)
FROM (
    SELECT {PICKS} FROM v_sheets
    WHERE sheet IN (SELECT sheet FROM c_checks WHERE "length" AND unique_ids AND team_name
        AND cross_unique AND min_positions AND extra_position AND nulls)
) s""",
    "c_manifest": """
SELECT regexp_extract(file_name, '^(.*), (.*)\\.[^.]*$', 1) AS handle,
    regexp_extract(file_name, '^(.*), (.*)\\.[^.]*$', 2) AS snapshot_ts,
    file_name, o_orderstatus, o_orderkey, o_totalprice
FROM v_snapshots""",
    "c_report": "\nUNION ALL\n".join(report_rows("c_consolidated", "c_all_scored")),
}


def with_inputs(body: str) -> str:
    """Prepend the views a body uses, and those they use, in order of definition."""
    texts = {**{name: view_sql(name) for name in VIEWS}, **COMMON}
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\b[vc]_\w+", pending.pop()))
        for name in words & texts.keys() - needed:
            needed.add(name)
            pending.append(texts[name])
    ctes = [f"{name} AS ({text})" for name, text in texts.items() if name in needed]
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body


RULES = ("length", "unique_ids", "team_name", "cross_unique", "min_positions", "extra_position", "nulls")

BODIES = {
    "scan_parquet": "SELECT game_id, week, season_type, posteam, defteam, play_type FROM v_pbp",
    "latest_snapshot": """
SELECT m.file_name, m.o_orderkey, m.o_totalprice, m.handle, m.snapshot_ts FROM c_manifest m
WHERE m.snapshot_ts = (SELECT max(n.snapshot_ts) FROM c_manifest n WHERE n.handle = m.handle)""",
    "snapshot_freshness": """
SELECT r.handle, r.remote_ts, l.local_ts, l.local_ts IS NOT NULL AND l.local_ts <> r.remote_ts AS is_stale
FROM (SELECT handle, max(snapshot_ts) AS remote_ts FROM c_manifest GROUP BY handle) r
LEFT JOIN (SELECT handle, max(snapshot_ts) AS local_ts FROM c_manifest
    WHERE o_orderstatus = 'F' AND handle <> '5-LOW' GROUP BY handle) l ON r.handle = l.handle""",
    "project_columns": """
SELECT position, week, season_type, player_id, player_name, recent_team AS team_abbr,
    * EXCLUDE (position, week, season_type, player_id, player_name, recent_team)
    REPLACE (CASE WHEN isnan(receiving_yards) THEN NULL ELSE receiving_yards END AS receiving_yards)
FROM v_offense""",
    "rename_columns": """
SELECT season, team AS team_abbr, position, status, full_name AS player_name, gsis_id AS player_id FROM v_roster""",
    "drop_pii_columns": "SELECT * FROM c_picks",
    "literal_columns": """
SELECT week, home_team, 'Defense' AS position, 'N/A' AS player_id, false AS subsequently_traded FROM v_games""",
    "derived_sum": """
SELECT player_id, week, fg_made_50_59, fg_made_60_, fg_made_50_59 + fg_made_60_ AS fg_made_50plus FROM v_kicking""",
    "recode_season_type": f"SELECT player_id, week, {SEASON_CASE} AS season_type FROM v_offense",
    "recode_position": """
SELECT gsis_id, CASE WHEN position = 'P' THEN 'K' ELSE position END AS roster_position,
    CASE WHEN position = 'FB' THEN 'RB' ELSE position END AS stat_position FROM v_roster""",
    "lookup_string": """
SELECT k.player_id, k.week,
    k.position || ', ' || k.team_abbr || ': ' || k.player_name || ' (' || t.team_division || ')' AS lookup_string
FROM c_kicking k LEFT JOIN c_teams t ON k.team_abbr = t.team_abbr""",
    "fill_missing": """
SELECT player_id, week,
    CASE WHEN receiving_yards IS NULL OR isnan(receiving_yards) THEN 0 ELSE receiving_yards END AS receiving_yards,
    coalesce(interceptions, 0) AS interceptions,
    coalesce(receiving_2pt_conversions, 0) AS receiving_2pt_conversions
FROM v_offense""",
    "cast_points": """
SELECT player_id, week,
    cast(CASE WHEN NOT isnan(receiving_yards) THEN receiving_yards END AS bigint) AS whole_yards,
    coalesce(interceptions > 0, true) AS flag
FROM v_offense""",
    "truncate_owner": """
SELECT sheet, roster_index, nullif(regexp_extract(fantasy_owner, '(^.* .)', 1), '') AS fantasy_owner FROM v_sheets""",
    "floor_div": """
SELECT player_id, week, cast(floor(passing_yards / 50) AS bigint) AS passing_points,
    cast(floor(rushing_yards / 10) AS bigint) AS rushing_points
FROM v_offense""",
    "filter_season": "SELECT * FROM v_team_list WHERE season = 2024",
    "filter_isin": """
SELECT player_id, week, 'Regular' AS season_type, position, passing_tds FROM v_offense
WHERE season_type = 'REG' AND position IN ('QB', 'RB', 'WR', 'TE')""",
    "filter_not_in": """
SELECT game_id, play_type, posteam, yards_gained FROM c_plays
WHERE play_type IS NULL OR play_type NOT IN ('pass', 'run')""",
    "filter_big_plays": """
SELECT game_id, week, posteam, passer_player_id, passing_yards FROM c_plays
WHERE pass_touchdown = 1 AND passing_yards >= 40""",
    "filter_null_safe_ne": """
SELECT game_id, week, play_type, defteam FROM c_plays WHERE play_type IS DISTINCT FROM 'punt'""",
    "filter_not_null": """
SELECT game_id, week, safety_player_id, blocked_player_name FROM c_plays
WHERE safety_player_id IS NOT NULL AND blocked_player_name IS NOT NULL""",
    "split_by_predicate": """
SELECT *, CASE WHEN position_code = 'D' THEN 'defense' ELSE 'player' END AS part FROM c_picks""",
    "join_team_dim": """
SELECT k.week, k.season_type, k.team_abbr, t.team_conf, t.team_division, k.player_id, k.fg_made
FROM c_kicking k LEFT JOIN c_teams t ON k.team_abbr = t.team_abbr""",
    "join_player_dim": """
SELECT o.week, o.team_abbr, o.player_id, p.position, p.player_name, o.passing_yards
FROM c_offense o LEFT JOIN c_players p ON o.player_id IS NOT DISTINCT FROM p.player_id""",
    "join_null_safe": """
SELECT o.player_id, o.week, o.passing_yards, r.full_name
FROM c_offense o LEFT JOIN v_roster r ON o.player_id IS NOT DISTINCT FROM r.gsis_id""",
    "score_player_picks": report_rows("c_picks", "c_kicker_stats")[0],
    "score_defense_picks": report_rows("c_picks", "c_points_allowed")[1],
    "join_fanout": """
SELECT p.fantasy_team, p.roster_index, p.player_id, k.week, k.fg_made
FROM c_picks p JOIN c_kicking k ON p.player_id = k.player_id""",
    "trade_flag": """
SELECT k.player_id, k.week, k.team_abbr, p.team_abbr AS roster_team_abbr,
    k.team_abbr IS NULL OR p.team_abbr IS NULL OR k.team_abbr <> p.team_abbr AS subsequently_traded
FROM c_kicking k LEFT JOIN c_players p ON k.player_id IS NOT DISTINCT FROM p.player_id""",
    "event_count_player": "SELECT * EXCLUDE (fantasy_points) FROM c_player_bonus",
    "event_count_team": "SELECT * EXCLUDE (fantasy_points) FROM c_team_bonus",
    "distinct_rows": "SELECT DISTINCT week, season_type, away_team, home_score FROM v_games",
    "sheet_check_length": 'SELECT sheet, "length" AS ok FROM c_checks',
    "sheet_check_unique_ids": "SELECT sheet, unique_ids AS ok FROM c_checks",
    "sheet_check_team_name": "SELECT sheet, team_name AS ok, team_name_strict AS ok_strict FROM c_checks",
    "sheet_check_cross_unique": "SELECT sheet, cross_unique AS ok FROM c_checks",
    "sheet_check_min_positions": "SELECT sheet, min_positions AS ok FROM c_checks",
    "sheet_check_extra_position": "SELECT sheet, extra_position AS ok FROM c_checks",
    "sheet_check_nulls": "SELECT sheet, nulls AS ok FROM c_checks",
    "sheet_violations": "\nUNION ALL\n".join(
        f"SELECT sheet, '{rule}' AS rule, \"{rule}\" AS ok FROM c_checks" for rule in RULES
    ),
    "audit_counts": """
SELECT 'offense' AS source, count(*) FILTER (WHERE subsequently_traded) AS traded,
    count(*) FILTER (WHERE player_name IS NULL) AS without_player,
    cast(NULL AS bigint) AS out_of_scope, cast(NULL AS bigint) AS unscored
FROM c_offense_stats
UNION ALL
SELECT 'kicking', count(*) FILTER (WHERE subsequently_traded),
    count(*) FILTER (WHERE player_name IS NULL), NULL, NULL
FROM c_kicker_stats
UNION ALL
SELECT 'player_bonus', count(*) FILTER (WHERE subsequently_traded),
    count(*) FILTER (WHERE player_name IS NULL),
    count(*) FILTER (WHERE position IS NULL OR position NOT IN ('QB', 'RB', 'WR', 'TE')), NULL
FROM c_bonus_rows
UNION ALL
SELECT 'points_allowed', NULL, NULL, NULL, count(*) FILTER (WHERE fantasy_points IS NULL)
FROM c_points_allowed""",
    "union_all_stats": melted("c_offense", STAT_IDS, OFFENSE_POINTS)
    + "\nUNION ALL\n"
    + melted("c_kicking", STAT_IDS, KICKING_POINTS),
    "points_against": "SELECT * FROM c_against",
    "melt_offense": melted("c_offense", STAT_IDS, OFFENSE_POINTS),
    "melt_kicking": melted("c_kicking", STAT_IDS, KICKING_POINTS),
    "sort_roster": "SELECT * FROM v_roster ORDER BY position NULLS LAST, gsis_id NULLS LAST",
    "score_yardage": scored("c_offense", "player_id, week", YARDAGE_POINTS),
    "score_linear": scored("c_offense", "player_id, week", LINEAR_POINTS),
    "score_kicking": scored("c_kicking", "player_id, week", KICKING_POINTS),
    "score_bands": f"""
SELECT week, home_team, home_score, cast({BAND_CASE.format(v="home_score")} AS bigint) AS fantasy_points
FROM v_games""",
    "bonus_offense": "SELECT * FROM c_player_bonus",
    "bonus_defense": "SELECT * FROM c_team_bonus",
    "dim_teams": "SELECT * FROM c_teams",
    "dim_players": "SELECT * FROM c_players",
    "offense_stats": "SELECT * FROM c_offense_stats",
    "kicker_stats": "SELECT * FROM c_kicker_stats",
    "plays": "SELECT * FROM c_plays",
    "offense_bonus": "SELECT * FROM c_offense_bonus",
    "defense_bonus": "SELECT * FROM c_defense_bonus",
    "defense_points_allowed": "SELECT * FROM c_points_allowed",
    "consolidated_rosters": "SELECT * FROM c_consolidated",
    "all_scored_stats": "SELECT * FROM c_all_scored",
    "scored_report": "SELECT * FROM c_report",
    "publish_contract": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM c_report"
        for c in REPORT
    ),
}

ORACLES = {name: with_inputs(body) for name, body in BODIES.items()}
