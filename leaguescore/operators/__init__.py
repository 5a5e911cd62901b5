"""Joins, reshaping, event counting and checks."""

from leaguescore.operators.events import count_events, events_of
from leaguescore.operators.joins import (
    Dimension,
    attach,
    describe_players,
    join_teams,
    measured,
    people_dimension,
    people_of,
    row_bytes,
)
from leaguescore.operators.reshape import melt, melt_scored, points_against, union_all

__all__ = [
    "Dimension",
    "attach",
    "count_events",
    "describe_players",
    "events_of",
    "join_teams",
    "measured",
    "melt",
    "melt_scored",
    "people_dimension",
    "people_of",
    "points_against",
    "row_bytes",
    "union_all",
]
