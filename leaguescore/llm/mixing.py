"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

Each source's documents lie in seeded order in shards; a shard is a ring of words, cut into
blocks of ``block`` words. The blocks of the mix are given to sources one by one to the highest
quotient ``weight / (2 * blocks + 1)``, and a source's blocks to its shards in the same way.
A shard's quota is then taken as consecutive blocks from a seeded block on, once around the ring
or twice if it must be.

The driver holds one number per source and per shard (at most ``MAX_SHARDS`` and one for each
source). Blocks are counted, never listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguescore.llm.runtime import BLANK_CHARS, BLANKS, stored

MAX_SHARDS = 20_000
WORD_STARTS = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"


@dataclass(frozen=True)
class Mix:
    """What is wanted: weights by the sources' order, repeating, and the size of the whole."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    total_share: float = 1.5
    max_repeats: int = 2
    block: int = 16
    shard_words: int = 100_000
    seed: int = 42


def apportion(weights: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients ``w / (2 s + 1)``, none beyond ``most``; first one wins ties.

    All seats with a quotient above a cut are given at once: the cut is halved in on, then
    the few seats near it are given one by one.
    """
    weights = np.asarray(weights, dtype=float)
    limit = np.full(len(weights), seats, np.int64) if most is None else np.asarray(most, np.int64)
    limit = np.where(weights > 0, limit, 0)
    seats = int(min(seats, limit.sum()))
    if not seats:
        return np.zeros(len(weights), np.int64)

    def given(cut: float) -> np.ndarray:  # seats with quotients above the cut
        raw = np.ceil(np.minimum((weights / cut - 1) / 2, 4e15))
        return np.clip(raw, 0, limit).astype(np.int64)

    low, high = 0.0, float(weights.max()) * 2
    for _ in range(200):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    left = seats - int(out.sum())
    while left:
        quotients = np.where(out < limit, weights / (2 * out + 1), -1.0)
        best = np.lexsort((np.arange(len(weights)), -quotients))[:left]
        top = quotients[best] >= quotients[best[0]] * (1 - 1e-12)
        out[best[top]] += 1
        left -= int(top.sum())
    return out


def targets(sizes: np.ndarray, mix: Mix) -> np.ndarray:
    """Words wanted of each source; what exceeds a source's limit is shared by weight again."""
    weights = np.array([mix.weights[k % len(mix.weights)] for k in range(len(sizes))])
    most = mix.max_repeats * sizes.astype(float)
    out = np.zeros(len(sizes))
    open_ = most > 0
    rest = min(mix.total_share * sizes.sum(), most.sum())
    while open_.any():
        share = rest * weights / weights[open_].sum()
        full = open_ & (share >= most)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = most[full]
        rest -= most[full].sum()
        open_ &= ~full
    return out


def sized(
    docs: DataFrame, key: str, source: str, text: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, carry..., source, size, text_hash)``: words of every text; null is empty."""
    body = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANK_CHARS))
    size = F.when(body == "", 0).otherwise(F.size(F.split(body, BLANKS)))
    own = list(dict.fromkeys([key, *carry]))
    hashed = F.xxhash64(F.col(text)).alias("text_hash")
    return docs.select(*own, F.col(source).alias("source"), size.cast("long").alias("size"), hashed)


def mix_sources(
    docs: DataFrame,
    mix: Mix = Mix(),
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, carry..., source, size, source_size, target, taken, rounds, cuts)`` of all rows.

    ``taken`` counts the words that the mix takes, repeats included: at most ``max_repeats``
    times the size. Sources are in code point order, null last. The order in a shard is a hash
    of the seed, the key, the size and the text, so a run that is repeated takes the same words; rows
    alike in all of them are interchangeable, and only they are bound to one shard. Empty documents are never taken.
    Columns to carry must not have the names of the result's, nor ``text_hash``, ``number``, ``shard``, ``order``,
    ``n_shards``, ``words``, ``quota``, ``begin``, ``from``, ``to`` and ``taken_words``. Without texts to
    carry, the texts are read and split once, and all that follows is about narrow rows.

    ``taken`` is ``rounds`` times the whole document and the words of ``cuts``, spans
    ``(low, high)`` of word numbers: only documents at the ends of a shard's run are cut.
    """
    spark = docs.sparkSession
    own = list(dict.fromkeys([key, *carry]))
    rows = sized(docs, key, source, text, carry)
    if text not in own:
        rows = stored(rows, "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).toPandas()  # one per source
    found = found.iloc[
        sorted(
            range(len(found)),
            key=lambda k: (found["source"][k] is None, (found["source"][k] or "").encode()),
        )
    ].reset_index(drop=True)
    sizes = found["size"].to_numpy(dtype=np.int64)
    wanted = targets(sizes, mix)
    blocks = apportion(
        wanted, round(wanted.sum() / mix.block), -(-mix.max_repeats * sizes // mix.block)
    )
    total = max(1, int(sizes.sum()))
    plenty = -(-sizes // mix.shard_words)
    n_shards = np.maximum(1, np.minimum(plenty, MAX_SHARDS * sizes // total))
    catalogue = spark.createDataFrame(
        [
            (k, None if name is None else str(name), int(size), float(target), int(shards))
            for k, (name, size, target, shards) in enumerate(
                zip(found["source"], sizes, wanted, n_shards)
            )
        ],
        "number int, source string, source_size long, target double, n_shards int",
    )
    known = F.broadcast(catalogue.withColumnRenamed("source", "name"))
    order = F.xxhash64(F.lit(mix.seed), F.col(key), F.col("size"), F.col("text_hash"))
    placed = (
        rows.join(known, F.col("source").eqNullSafe(F.col("name")))
        .drop("name")
        .withColumn("order", order)
        .withColumn("shard", F.pmod(F.xxhash64("order"), F.col("n_shards")).cast("int"))
    )
    words = placed.groupBy("number", "shard").agg(F.sum("size").alias("words")).toPandas()
    words = words.sort_values(["number", "shard"], ignore_index=True)  # at most 20,000 and one each
    words["quota"] = 0
    for number, part in words.groupby("number"):
        held = part["words"].to_numpy(dtype=np.int64)
        most = -(-mix.max_repeats * held // mix.block)
        words.loc[part.index, "quota"] = apportion(held, int(blocks[number]), most)
    quotas = spark.createDataFrame(
        [tuple(map(int, r)) for r in words[["number", "shard", "words", "quota"]].to_numpy()],
        "number int, shard int, words long, quota long",
    )
    before = Window.partitionBy("number", "shard").orderBy("order", key, "size", "text_hash")
    running = F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, 0))
    at = placed.withColumn("begin", running - F.col("size")).join(
        F.broadcast(quotas), ["number", "shard"]
    )
    taken = F.least(F.col("quota") * mix.block, F.col("words") * mix.max_repeats)
    rounds = F.when(F.col("words") > 0, F.floor(F.col("taken_words") / F.col("words"))).otherwise(0)
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / mix.block))
    first = F.pmod(F.xxhash64(F.lit(mix.seed), "number", "shard"), n_blocks) * mix.block

    def overlap(low: Column, high: Column) -> Column:
        return F.struct(
            (F.greatest("begin", low) - F.col("begin")).alias("low"),
            (F.least(F.col("begin") + F.col("size"), high) - F.col("begin")).alias("high"),
        )

    spans = F.array(
        overlap(F.col("from"), F.least("to", "words")),
        overlap(F.lit(0), F.col("to") - F.col("words")),
    )
    cut = F.filter(spans, lambda s: s["low"] < s["high"])
    words_cut = F.aggregate(
        F.col("cuts"), F.lit(0).cast("long"), lambda total, s: total + s["high"] - s["low"]
    )
    return (
        at.withColumn("taken_words", taken)
        .withColumn("rounds", rounds.cast("long"))
        .withColumn("from", first)
        .withColumn("to", F.col("from") + F.col("taken_words") - F.col("rounds") * F.col("words"))
        .withColumn("cuts", cut)
        .withColumn("taken", F.col("rounds") * F.col("size") + words_cut)
        .select(
            *own,
            *("source", "size", "source_size", "target", "taken"),
            F.when(F.col("size") > 0, F.col("rounds")).otherwise(0).alias("rounds"),
            "cuts",
        )
    )


def take_text(text: Column, cut: Column) -> Column:
    """The words of a cut with the blanks after each, as they are in the text."""
    parts = F.split(F.btrim(text, F.lit(BLANK_CHARS)), WORD_STARTS)
    return F.array_join(F.slice(parts, cut["low"] + 1, cut["high"] - cut["low"]), "")
