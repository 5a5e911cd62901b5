"""SimHash near-duplicates, joined on a grid over segment bit counts.

A 64-bit fingerprint is embedded as the bit counts of its 32 segments of two bits. Flipping a
bit changes one count by one, so the Manhattan distance of two embeddings is at most the Hamming
distance of their fingerprints. The segments form 8 grid dimensions of four; if the whole
distance is at most ``d``, at least ``8 - d`` dimensions are equal, so every pair to be found
shares a grid cell over some ``8 - d`` dimensions. Pairs that share a cell are held against the
lower bound, then against the exact distance. Nothing is capped. Chance pairs in cells grow with the
square of the table, so large tables have a finer grid of 16 dimensions, with 26 times the cells at four bits and a
hundredth of the pairs; the links are the same.

A dense group has as many pairs as the square of its fingerprints. So those that differ within
one four-bit nibble only, which are linked for certain, are connected first, through one common
key each; the grid join then reports only links between different groups of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.components import components
from leaguescore.llm.runtime import bytes_of, map_arrow, pieces_of, stored

#: Dimensions of the grid, and of the finer one, which is for so many distinct fingerprints and more.
DIMENSIONS, FINER, FINER_FROM = 8, 16, 5_000_000
SEED = 42
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 15


def fingerprint_of(text: bytes, width: int) -> int:
    """Bit k is one if it is one in over half of the shingle hashes; no words: zero."""
    words = text.lower().split()  # both are ASCII only for bytes
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    last = np.minimum(np.arange(max(1, len(words) - width + 1)) + width, len(words)) - 1
    ends = (starts + lengths - 1)[last].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, dtype=np.int64), len(ends)
    spans = list(zip(starts[:n].tolist(), ends))
    for low in range(0, n, AT_ONCE):
        part = spans[low : low + AT_ONCE]
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in part), ">u8", len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, width: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, fingerprint)``, the fingerprint as the 64-bit integer of its bits.

    Words are lower-cased (A-Z) runs without ASCII white space; a shingle is ``width`` of them
    joined by spaces, or all if there are fewer; its hash is XXH64 with seed 42. A null text
    is empty.
    """
    kind = docs.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text):
            values = [fingerprint_of(t, width) for t in bytes_of(batch, text)]
            signed = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], names=[key, "fingerprint"])

    return map_arrow(docs.select(key, text), hashed, f"`{key}` {kind}, fingerprint long")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def literal(value: int) -> Column:
    return F.lit(signed(value)).cast("long")


PAIRS = 0x5555555555555555


def segment_counts(fingerprint: Column) -> Column:
    """The 32 counts (0 to 2) of the two-bit segments, two bits each, as one long."""
    low = fingerprint.bitwiseAND(literal(PAIRS))
    high = F.shiftrightunsigned(fingerprint, 1).bitwiseAND(literal(PAIRS))
    both = F.shiftleft(low.bitwiseAND(high), 1)
    return low.bitwiseXOR(high).bitwiseOR(both)  # a sum without carries or overflow


def manhattan(a: Column, b: Column) -> Column:
    """Distance of two embeddings: 1 where the low bits differ, 2 for 0 against 2."""
    x = a.bitwiseXOR(b)
    low = x.bitwiseAND(literal(PAIRS))
    high = F.shiftrightunsigned(x, 1).bitwiseAND(literal(PAIRS)).bitwiseAND(F.bitwise_not(low))
    return F.bit_count(low) + 2 * F.bit_count(high)


def dimension_mask(d: int, dimensions: int) -> int:
    width = 64 // dimensions
    return ((1 << width) - 1) << (width * d)


def grid_cells(nodes: DataFrame, distance: int, dimensions: int = DIMENSIONS) -> DataFrame:
    """Every fingerprint once for each choice of dimensions, with its cell there."""
    chosen = combinations(range(dimensions), dimensions - distance)
    choices = F.array(
        *[
            F.struct(
                F.lit(sum(1 << d for d in some)).alias("choice"),
                literal(sum(dimension_mask(d, dimensions) for d in some)).alias("mask"),
            )
            for some in chosen
        ]
    )  # a constant, whatever its length
    counted = nodes.withColumn("counts", segment_counts(F.col("fingerprint")))
    spread = counted.select("*", F.explode(choices).alias("at"))
    cell = F.col("counts").bitwiseAND(F.col("at.mask")).alias("cell")
    return spread.select(*nodes.columns, "counts", "at.choice", cell)


def first_choice(a: Column, b: Column, choice: Column, dimensions: int = DIMENSIONS) -> Column:
    """Is this the first of the choices in which the pair shares a cell? Each pair counts once."""
    x = a.bitwiseXOR(b)
    same = F.lit(0)
    for d in range(dimensions):
        equal = x.bitwiseAND(literal(dimension_mask(d, dimensions))) == 0
        same = same + F.when(equal, 1 << d).otherwise(0)
    below = F.lit((1 << dimensions) - 1)
    for d in reversed(range(dimensions)):  # up to the highest dimension chosen
        fits = choice < F.lit(1 << (d + 1))
        below = F.when(fits, F.lit((1 << (d + 1)) - 1)).otherwise(below)
    return same.bitwiseAND(below) == choice


def links(nodes: DataFrame, distance: int, dimensions: int = DIMENSIONS) -> DataFrame:
    """Pairs ``(a, b)`` of groups with fingerprints at most ``distance`` bits apart.

    ``nodes`` has ``fingerprint`` (distinct) and ``grp``; pairs within a group are not made. The join is never a broadcast:
    Spark sizes cells by the table, without the 70 and more that the explode makes of each row.
    """
    if not 0 <= distance < dimensions:
        raise ValueError(f"the grid finds distances of 0 to {dimensions - 1} bits")
    cells = grid_cells(nodes, distance, dimensions)
    left, right = cells.alias("l"), cells.alias("r")
    close = (
        (F.col("l.choice") == F.col("r.choice"))
        & (F.col("l.cell") == F.col("r.cell"))
        & (F.col("l.fingerprint") < F.col("r.fingerprint"))
        & (F.col("l.grp") != F.col("r.grp"))
        & (manhattan(F.col("l.counts"), F.col("r.counts")) <= distance)
        & (
            F.bit_count(F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint")))
            <= distance
        )
        & first_choice(F.col("l.counts"), F.col("r.counts"), F.col("l.choice"), dimensions)
    )
    return left.join(right.hint("merge"), close).select(
        F.least("l.grp", "r.grp").alias("a"), F.greatest("l.grp", "r.grp").alias("b")
    )


def certain_links(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: each fingerprint with the smallest that differs within one nibble only."""
    keys = [
        F.struct(
            F.lit(k).cast("short").alias("nibble"),
            F.col("fingerprint").bitwiseAND(literal(~(0xF << (4 * k)) & (2**64 - 1))).alias("rest"),
        )
        for k in range(16)
    ]
    spread = nodes.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    groups = spread.groupBy("key").agg(
        F.min("fingerprint").alias("a"), F.collect_set("fingerprint").alias("all")
    )  # at most 16 fingerprints have a key
    shared = groups.where(F.size("all") > 1)
    return shared.select("a", F.explode("all").alias("b")).where("a <> b")


def classes(prints: DataFrame, distance: int = 4, key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint, component_id)`` of every row: its class by linked fingerprints.

    ``component_id`` is the smallest key of the class. Rows with null keys belong to
    classes too; a class of such rows only has a null id. Tables of a row for each document are joined by merging: Spark
    sizes them by their compressed files, a fraction of what they are in the driver as a broadcast.
    """
    prints = stored(prints, "fingerprints")
    nodes = prints.select("fingerprint").distinct()
    tight = components(certain_links(nodes)) if distance >= 4 else None
    if tight is None:
        grouped = nodes.withColumn("grp", F.col("fingerprint"))
    else:
        joined = nodes.join(tight, F.col("fingerprint") == F.col("node"), "left")
        grouped = joined.select("fingerprint", F.coalesce("label", "fingerprint").alias("grp"))
    grouped = stored(grouped, "groups")
    finer = distance < DIMENSIONS and grouped.count() >= FINER_FROM
    wide = components(links(grouped, distance, FINER if finer else DIMENSIONS))
    labels = grouped.join(wide, F.col("grp") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("label", "grp").alias("label")
    )
    least = prints.groupBy("fingerprint").agg(F.min(key).alias("least"))
    placed = stored(least.join(labels.hint("merge"), "fingerprint"), "placed")
    smallest = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = placed.join(smallest.hint("merge"), "label").select("fingerprint", "component_id")
    return prints.join(ids.hint("merge"), "fingerprint").select(key, "fingerprint", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
