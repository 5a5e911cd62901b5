"""Joins of large frames with dimension frames.

A dimension is broadcast only when its measured size is below a limit. The
measurement is one aggregate over the dimension, taken once per ``Dimension``
and shared by every join that uses it. Above the limit the join is a shuffled
sort-merge join with the large frame on the left, where adaptive execution
splits the partitions of a hot key (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguescore.functions import differs, player_label

BROADCAST_BYTES = 64 * 1024 * 1024

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


@dataclass(frozen=True)
class Dimension:
    """A frame to join to, and whether its measured size allows a broadcast.

    ``rows`` is its measured number of rows or more, 0 where it was not measured.
    """

    frame: DataFrame
    fits: bool
    rows: int = 0

    def side(self, frame: DataFrame) -> DataFrame:
        """Mark a projection of the dimension for the join strategy it is fit for."""
        return F.broadcast(frame) if self.fits else frame.hint("merge")


def row_bytes(df: DataFrame) -> Column:
    """Width of a row as a column: the bytes of its texts, 16 more for every column."""
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return width


def measured(df: DataFrame | Dimension, limit: int = BROADCAST_BYTES) -> Dimension:
    """Measure a frame once, in a single aggregate; a ``Dimension`` is passed through.

    Frames with nested columns, whose width is not measured, never fit.
    """
    if isinstance(df, Dimension):
        return df
    if any(isinstance(f.dataType, NESTED) for f in df.schema):
        return Dimension(df, False)
    size = F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("size")
    found = df.agg(size, F.count(F.lit(1)).alias("rows")).first()
    return Dimension(df, found["size"] <= limit, found["rows"])


def counted(df: DataFrame | Dimension) -> Dimension:
    """A frame with its number of rows only, for a join that is no broadcast; a ``Dimension`` is passed through."""
    return df if isinstance(df, Dimension) else Dimension(df, False, df.count())


def attach(
    facts: DataFrame, dim: Dimension, key: str, other: str, how: str = "left"
) -> DataFrame:
    """Join where a missing key matches a missing key; ``other`` is dropped.

    The null-safe equality is planned as a hash or sort-merge equi-join.
    """
    side = dim.side(dim.frame)
    return facts.join(side, F.col(key).eqNullSafe(F.col(other)), how).drop(other)


def attach_in_shares(
    facts: DataFrame, matches: DataFrame, key: str, other: str, shares: int
) -> DataFrame:
    """Left join for facts with many matches each, where a missing key matches a missing key.

    Adaptive execution sizes tasks by the bytes read, so a few megabytes of facts are one task, however many rows
    it makes of them. Here facts are dealt in turn to ``shares``, whatever their keys, and each share has its copy of
    the matches. The number of partitions is given, so adaptive execution does not put them together again.
    """

    def keyed(rows: DataFrame, name: str, share: Column) -> DataFrame:
        text = F.coalesce(F.col(name), F.lit(""))
        return rows.withColumns({"_key": text, "_missing": F.col(name).isNull(), "_share": share})

    keys = ["_key", "_missing", "_share"]
    dealt = keyed(facts.repartition(shares), key, F.spark_partition_id()).repartition(shares, *keys)
    copies = keyed(matches, other, F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    return dealt.join(copies, keys, "left").drop(*keys)


def join_teams(facts: DataFrame, teams: DataFrame | Dimension, *columns: str) -> DataFrame:
    """Left join of the named team columns on ``team_abbr``."""
    dim = measured(teams)
    wanted = columns or ("team_division", "team_conf")
    return facts.join(dim.side(dim.frame.select("team_abbr", *wanted)), "team_abbr", "left")


def people_of(players: DataFrame) -> DataFrame:
    """The player columns a stat row takes on, under names that do not clash with its own."""
    return players.select(
        F.col("player_id").alias("roster_player_id"),
        F.col("team_abbr").alias("roster_team_abbr"),
        "position",
        "player_name",
    )


def people_dimension(players: DataFrame | Dimension) -> Dimension:
    """``people_of`` the players, measured; such a dimension is passed through."""
    return players if isinstance(players, Dimension) else measured(people_of(players))


def with_people(rows: DataFrame, people: Dimension) -> DataFrame:
    """Add rostered position, name and trade flag to rows of players.

    Several people per id multiply the rows; rows without a match stay, with the
    flag set.
    """
    own = [c for c in rows.columns if c not in ("position", "player_name")]
    matched = attach(rows.select(*own), people, "player_id", "roster_player_id")
    return matched.select(
        *own,
        "position",
        "player_name",
        differs(F.col("team_abbr"), F.col("roster_team_abbr")).alias("subsequently_traded"),
    )


def with_teams(
    rows: DataFrame, teams: DataFrame | Dimension, position: str = "position"
) -> DataFrame:
    """Add the team columns and the label to rows ``with_people``."""
    label = player_label(
        F.col(position), F.col("team_abbr"), F.col("player_name"), F.col("team_division")
    )
    joined = join_teams(rows, teams)
    return joined.select(*rows.columns, "team_conf", "team_division", label.alias("lookup_string"))


def describe_players(
    rows: DataFrame,
    teams: DataFrame | Dimension,
    people: Dimension,
) -> DataFrame:
    """Add the player and team columns, label and trade flag to rows of players."""
    return with_teams(with_people(rows, people), teams)
