"""Team and player dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.functions import player_label, recode, team_label
from leaguescore.operators.joins import Dimension, measured
from leaguescore.schemas import DEFENSE_POSITION, ROSTER_COLUMNS, ROSTER_POSITIONS, TEAM_COLUMNS


def teams(raw: DataFrame, description: DataFrame, season: int) -> DataFrame:
    """Teams of one season with conference, division and the label of their defense."""
    described = description.select(
        "team_abbr", "team_conf", "team_division", "team_logo_espn"
    ).distinct()
    listed = raw.where(F.col("season") == season).select(
        "season",
        F.col("team").alias("team_abbr"),
        F.col("full").alias("team_name"),
        F.concat("full", F.lit(" ("), "team", F.lit(")")).alias("team_name_w_abbr"),
    )
    return (
        listed.join(described, "team_abbr", "left")
        .withColumn("position", F.lit(DEFENSE_POSITION))
        .withColumn(
            "lookup_string",
            team_label(F.col("position"), F.col("team_abbr"), F.col("team_division")),
        )
        .select(*TEAM_COLUMNS)
    )


def players(raw: DataFrame, team_dim: DataFrame | Dimension) -> DataFrame:
    """Rostered players of the scoring positions with their team and label."""
    dim = measured(team_dim)
    named = dim.frame.select(
        "team_name", "team_abbr", "team_name_w_abbr", "team_conf", "team_division"
    ).distinct()
    rostered = (
        raw.withColumnsRenamed(
            {"team": "team_abbr", "full_name": "player_name", "gsis_id": "player_id"}
        )
        .select(*ROSTER_COLUMNS)
        .where(F.col("position").isin(*ROSTER_POSITIONS))
        .withColumn("position", recode(F.col("position"), {"P": "K"}))
    )
    return rostered.join(dim.side(named), "team_abbr", "left").withColumn(
        "lookup_string",
        player_label(
            F.col("position"), F.col("team_abbr"), F.col("player_name"), F.col("team_division")
        ),
    )
