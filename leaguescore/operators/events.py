"""Event rules over plays: one scan and one aggregation for any number of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguescore.rules import EventRule
from leaguescore.schemas import EVENT_KEYS


def own_names(*columns: str) -> list[Column]:
    """The columns as the unpivot's own: under the scan's identities, two uses of one plan are not seen to be equal."""
    return [F.col(c).alias(c) for c in columns]


def events_of(plays: DataFrame, rules: Sequence[EventRule]) -> DataFrame:
    """One row per play and rule that the play meets.

    Conditions are tested once, in the unpivot itself, whose generated code has a method of its own for every rule; what
    meets none is dropped there, in the scan stage. As a filter and as columns ahead of it, all of them are in the
    method of the scan, which fourteen rules make longer than the 8,000 bytes that Java compiles.
    """
    credits = [F.expr(rule.credit()).alias(rule.label) for rule in rules]
    return (
        plays.unpivot(own_names("week", "season_type"), credits, "stat_label", "credit")
        .where("credit IS NOT NULL")
        .select("week", "season_type", "stat_label", "credit.*")
    )


def count_events(events: DataFrame, **more: Column) -> DataFrame:
    """Count events per credit. A group with any missing key does not count.

    Counts are combined within each task before the shuffle, so a team or player
    with a large share of the events sends few rows. ``more`` are further aggregates of each group.
    """
    return (
        events.dropna(subset=list(EVENT_KEYS))
        .groupBy(*EVENT_KEYS, "points_each")
        .agg(F.count(F.lit(1)).alias("events"), *[c.alias(name) for name, c in more.items()])
        .select(
            *EVENT_KEYS,
            F.col("events").cast("double").alias("football_value"),
            (F.col("events") * F.col("points_each")).alias("fantasy_points"),
            *more,
        )
    )
