"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

A shard is a run of documents of bounded size. Its posting lists are cut into blocks of 64 postings,
each compressed on its own. A block's entry in the shard's directory, which is expanded when the shard is opened, has
the shortest document for each term frequency, from which its greatest score follows for any
corpus statistics; so shards are built before these are known, and never rebuilt for them.

A shard is a row of megabytes, of which Spark would hold a hundred in a task that writes or reads them. So the
directory is kept compressed in it, and a stored index has one row in each of its row groups.

A search takes a shard's documents in windows of ascending keys. Lists are ordered by their greatest score;
those whose sum cannot pass the shard's tenth score are not essential: only the others yield
candidates. A candidate stays only while its score so far and the greatest scores of the blocks
that would hold it in the other lists can still pass; blocks that no candidate is left for
are never decompressed. The heaps of shards are merged by score and key.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from leaguescore.llm.runtime import bytes_of, map_arrow, pieces_of, small_batches, stored
from leaguescore.operators.joins import measured

#: Everything in ASCII but digits and letters separates terms.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
TO_BLANKS = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
#: Postings of a block; term frequencies that a block's entry tells apart, the last for all above.
BLOCK, LEVELS = 64, 4
#: Bytes of text of a shard; of a long text that are split at once; of query terms of one pass.
SHARD_BYTES, SLICE_BYTES, QUERY_BYTES = 8 << 20, 4 << 20, 16 << 20
#: Blocks that are compressed at once.
BLOCKS_AT_ONCE = 4096
NO_DOCUMENT = np.iinfo(np.int32).max
UNIT = 1_000_000_000


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    low = 0
    while low < len(text):
        high = low + SLICE_BYTES
        piece = text[low:high].lower().translate(TO_BLANKS)  # lower() is ASCII only for bytes
        if high < len(text) and (cut := piece.rfind(b" ")) > 0:
            piece = piece[:cut]
        elif high < len(text):  # one term longer than a slice
            rest = text[low:].lower().translate(TO_BLANKS)
            end = rest.find(b" ", SLICE_BYTES)
            piece = rest if end < 0 else rest[:end]
        yield piece.split()
        low += len(piece)


@dataclass
class Shard:
    """Postings of one shard, sorted by term and document; documents by key."""

    terms: list[bytes]
    df: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    last: np.ndarray
    shortest: np.ndarray
    most: np.ndarray
    widths: np.ndarray
    blob: bytes


SHARD_ARRAYS = {
    "df": np.int32,
    "lengths": np.int64,
    "first": np.int32,
    "last": np.int32,
    "shortest": np.int64,
    "most": np.int64,
    "widths": np.uint8,
}


def packed_postings(docs: np.ndarray, tf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Width marks and bytes of blocks: the gaps between documents, then the frequencies less one.

    Gaps and frequencies have one, two, four or eight bytes each, as the block's greatest needs.
    """
    sizes = np.diff(np.append(starts, len(docs)))
    gaps = np.diff(docs, prepend=0).astype(np.int64)
    gaps[starts] = 0
    parts = (gaps, tf - 1)
    widths = []
    for values in parts:
        most = np.maximum.reduceat(values, starts)
        widths.append(np.select([most < 1 << 8, most < 1 << 16, most < 1 << 32], [1, 2, 4], 8))
    total = sizes * (widths[0] + widths[1])
    offsets = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    within = np.arange(len(docs)) - np.repeat(starts, sizes)
    base = offsets
    for values, width in zip(parts, widths):
        each = np.repeat(width, sizes)
        place = np.repeat(base, sizes) + within * each
        for byte in range(int(width.max())):
            some = each > byte
            out[place[some] + byte] = (values[some] >> (8 * byte)) & 0xFF
        base = base + sizes * width
    return (widths[0] << 4 | widths[1]).astype(np.uint8), out.tobytes()


def build_shard(texts: list[bytes]) -> Shard:
    """The index of documents in the order given."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found, lengths = [], np.zeros(len(texts), np.int64)
    for doc, text in enumerate(texts):
        slices = []
        for words in terms_of(text):
            ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            slices.append(np.unique(ids, return_counts=True))
            lengths[doc] += len(ids)
        if len(slices) > 1:  # a long text: its slices are added up
            ids, back = np.unique(np.concatenate([x for x, _ in slices]), return_inverse=True)
            slices = [(ids, np.bincount(back, np.concatenate([n for _, n in slices])))]
        for ids, tf in slices:
            found.append((ids, np.full(len(ids), doc, np.int32), tf.astype(np.int32)))
    empty = [(np.zeros(0, np.int32),) * 3]
    ids, docs, tf = (np.concatenate(x) for x in zip(*(found or empty)))
    del found
    terms = sorted(numbers)
    rank = np.empty(len(terms), np.int32)
    rank[np.fromiter((numbers[t] for t in terms), np.int64, len(terms))] = np.arange(len(terms))
    ids = rank[ids] if len(ids) else ids
    order = np.argsort(ids, kind="stable")  # by term, and by document within it
    ids, docs, tf = ids[order], docs[order], tf[order]
    del order
    df = np.bincount(ids, minlength=len(terms))
    list_starts = np.cumsum(df) - df
    blocks = -(-df // BLOCK)
    number = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(list_starts, blocks) + number * BLOCK
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Shard([], none, lengths, none, none, none.reshape(0, LEVELS), none, none, b"")
    ends = np.append(starts[1:], len(docs)) - 1
    n = lengths[docs]
    shortest = np.full((len(starts), LEVELS), np.iinfo(np.int64).max)
    for level in range(LEVELS):
        here = tf == level + 1 if level < LEVELS - 1 else tf >= LEVELS
        shortest[:, level] = np.minimum.reduceat(np.where(here, n, np.iinfo(np.int64).max), starts)
    widths, blobs = [], []
    for low in range(0, len(starts), BLOCKS_AT_ONCE):
        some = starts[low : low + BLOCKS_AT_ONCE]
        span = slice(int(some[0]), int(ends[min(low + BLOCKS_AT_ONCE, len(starts)) - 1]) + 1)
        width, blob = packed_postings(docs[span].astype(np.int64), tf[span].astype(np.int64), some - some[0])
        widths.append(width)
        blobs.append(blob)
    widths, blob = np.concatenate(widths), b"".join(blobs)
    return Shard(
        terms, df, lengths, docs[starts], docs[ends], shortest, np.maximum.reduceat(tf, starts), widths, blob
    )


def build_index(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """One row for each shard of at most ``shard_bytes`` of text (a longer text is one of its own).

    Terms are runs of ASCII digits and letters and of all characters beyond ASCII, with A-Z
    lower-cased. Documents without terms, null texts too, are in no list. Rows may repeat, and keys
    may be null; null keys come last. Shards are made where the documents are read, without a
    shuffle, so no word and no source can make one of them larger than another.
    """
    kind = docs.schema[key].dataType.simpleString()
    arrays = ", ".join(f"{name} binary" for name in SHARD_ARRAYS)
    schema = f"keys array<{kind}>, n_docs long, n_terms long, terms array<binary>, counts array<int>, {arrays}, blob binary"

    def row(keys: list[pa.Array], texts: list[bytes]) -> pa.RecordBatch:
        held = pa.concat_arrays(keys)
        order = pc.sort_indices(held, null_placement="at_end")
        shard = build_shard([texts[i] for i in order.to_pylist()])
        sorted_keys = held.take(order)
        columns = {
            "keys": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), sorted_keys),
            "n_docs": pa.array([int((shard.lengths > 0).sum())], pa.int64()),
            "n_terms": pa.array([int(shard.lengths.sum())], pa.int64()),
            "terms": pa.array([shard.terms], pa.list_(pa.binary())),
            "counts": pa.array([shard.df.astype(np.int32)], pa.list_(pa.int32())),
        }
        for name, dtype in SHARD_ARRAYS.items():
            flat = np.ascontiguousarray(getattr(shard, name), dtype).tobytes()
            columns[name] = pa.array([zstandard.compress(flat)])
        columns["blob"] = pa.array([shard.blob], pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[pa.Array] = []
        texts: list[bytes] = []
        held = 0
        for batch in pieces_of(batches, text, min(4 << 20, shard_bytes)):
            some = bytes_of(batch, text)
            size = sum(map(len, some))
            if texts and held + size > shard_bytes:
                yield row(keys, texts)
                keys, texts, held = [], [], 0
            keys.append(batch.column(0).take(pa.array(np.arange(batch.num_rows))))  # a slice would hold the texts
            texts += some
            held += size
        if texts:
            yield row(keys, texts)

    return map_arrow(docs.select(key, text), sharded, schema)


def opened(batch: pa.RecordBatch, i: int, wanted: pa.Array) -> dict:
    """A row of an index for ``Reader``, with the numbers of the terms that are wanted."""
    row = {n: zstandard.decompress(batch.column(n)[i].as_buffer()) for n in SHARD_ARRAYS}
    places = pc.index_in(wanted, value_set=batch.column("terms")[i].values).to_pylist()
    number = {t: at for t, at in zip(wanted.to_pylist(), places) if at is not None}
    return {**row, "blob": batch.column("blob")[i].as_buffer(), "number": number}


class Reader:
    """Lists of a shard for given corpus statistics; each block is decompressed once at most.

    ``row`` has the shard's ``terms``, or the ``number`` of those that will be asked for.
    """

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        for name, dtype in SHARD_ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name], dtype))
        self.shortest = self.shortest.reshape(-1, LEVELS)
        self.blob = row["blob"]
        self.number = row["number"] if "number" in row else {t: i for i, t in enumerate(row["terms"])}
        # Python integers: the product may pass 64 bits for very long documents
        self.m = np.array([10 + 90 * n * n_docs // n_terms for n in self.lengths.tolist()], np.int64)
        blocks = -(-self.df // BLOCK)
        self.list_starts = np.append(0, np.cumsum(blocks))
        sizes = np.full(len(self.first), BLOCK, np.int64)
        if len(sizes):
            sizes[self.list_starts[1:] - 1] = self.df - (blocks - 1) * BLOCK
        self.sizes = sizes
        each = (self.widths >> 4).astype(np.int64) + (self.widths & 15)
        self.offsets = np.cumsum(sizes * each) - sizes * each
        self.bounds = self._bounds(n_docs, n_terms)
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _bounds(self, n_docs: int, n_terms: int) -> np.ndarray:
        """The greatest part of a score, before its weight, in each block."""
        tf = np.tile(np.arange(1, LEVELS + 1), (len(self.first), 1))
        tf[:, -1] = np.maximum(LEVELS, self.most)
        some = self.shortest < np.iinfo(np.int64).max
        short, back = np.unique(np.where(some, self.shortest, 0), return_inverse=True)
        m = np.array([10 + 90 * n * n_docs // n_terms for n in short.tolist()], np.int64)
        best = UNIT * tf // (1000 * tf + 8 * m[back].reshape(tf.shape))
        return np.where(some, best, 0).max(axis=1) if len(best) else np.zeros(0, np.int64)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and their parts of a score, before the weight."""
        got = self.read.get(b)
        if got is None:
            n, at = int(self.sizes[b]), int(self.offsets[b])
            wide, narrow = int(self.widths[b]) >> 4, int(self.widths[b]) & 15
            gaps = np.frombuffer(self.blob, f"<u{wide}", n, at)
            tf = np.frombuffer(self.blob, f"<u{narrow}", n, at + n * wide).astype(np.int64) + 1
            docs = np.cumsum(gaps, dtype=np.int64) + int(self.first[b])
            got = self.read[b] = (docs, UNIT * tf // (1000 * tf + 8 * self.m[docs]))
        return got


def search_shard(
    reader: Reader, query: list[tuple[bytes, int]], k: int, passed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The shard's ``k`` best documents with a score above 0, ties to the first, and their scores.

    Documents with a score below ``passed`` may be left out.
    """
    lists = []
    for term, weight in query:
        number = reader.number.get(term)
        if number is None or weight <= 0:
            continue
        low, high = int(reader.list_starts[number]), int(reader.list_starts[number + 1])
        lists.append((weight * int(reader.bounds[low:high].max()), weight, low, high))
    lists.sort(key=lambda x: (x[0], x[2]))
    total = np.cumsum([x[0] for x in lists])
    best_docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, width, n = 0, 512, len(reader.lengths)
    while low < n and lists:
        high = min(n, low + width)
        least = max(0, passed - 1, int(best[-1]) if len(best) == k else 0)
        split = int(np.searchsorted(total, least, side="right"))  # lists before it cannot pass alone
        scores = np.zeros(high - low, np.int64)
        hit = np.zeros(high - low, bool)
        for _, weight, start, end in lists[split:]:
            start += int(np.searchsorted(reader.last[start:end], low))
            while start < end and reader.first[start] < high:
                docs, parts = reader.block(start)
                a, b = np.searchsorted(docs, (low, high))
                scores[docs[a:b] - low] += weight * parts[a:b]
                hit[docs[a:b] - low] = True
                start += 1
        found = np.flatnonzero(hit)
        found, got = found + low, scores[found]
        if split and len(found):
            found, got = other_lists(reader, lists[:split], found, got, least)
        some = got > least
        if some.any():
            docs = np.concatenate([best_docs, found[some]])
            merged = np.concatenate([best, got[some]])
            order = np.lexsort((docs, -merged))[:k]
            best_docs, best = docs[order], merged[order]
        low, width = high, min(4096, 2 * width)
    return best_docs, best


def other_lists(
    reader: Reader, lists: list[tuple], found: np.ndarray, got: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores of the candidates that the lists which are not essential can bring over ``least``."""
    at = []
    for _, weight, start, end in lists:
        block = start + np.searchsorted(reader.last[start:end], found)
        inside = block < end
        block = np.where(inside, block, start)
        inside &= reader.first[block] <= found
        at.append((block, np.where(inside, weight * reader.bounds[block], 0)))
    left = sum(bound for _, bound in at)
    keep = got + left > least  # by block maxima alone: nothing is decompressed yet
    found, got, left = found[keep], got[keep], left[keep]
    at = [(block[keep], bound[keep]) for block, bound in at]
    for i in reversed(range(len(lists))):
        if not len(found):
            break
        block, bound = at[i]
        left = left - bound
        got = got.copy()
        some = np.flatnonzero(bound)
        for b in np.unique(block[some]).tolist():
            docs, parts = reader.block(b)
            here = some[block[some] == b]
            place = np.minimum(np.searchsorted(docs, found[here]), len(docs) - 1)
            same = docs[place] == found[here]
            got[here[same]] += lists[i][1] * parts[place[same]]
        keep = got + left > least
        found, got, left = found[keep], got[keep], left[keep]
        at = [(block[keep], bound[keep]) for block, bound in at[:i]]
    return found, got


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def query_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term)``: the distinct terms of each item, those of all its rows; items without any are left out."""
    kind = items.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text):
            for i, value in enumerate(bytes_of(batch, text)):
                terms = sorted({t for some in terms_of(value) for t in some})
                keys = batch.column(0).take(pa.array([i] * len(terms), pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(terms, pa.binary())], names=[key, "term"])

    return map_arrow(items.select(key, text), split, f"`{key}` {kind}, term binary").distinct()


def best_rows(found: DataFrame, item: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows of each item with the greatest score, ties to the smaller key, nulls last."""
    order = (F.col("score").desc(), F.col(key).asc_nulls_last())
    parts = found.withColumn("part", F.spark_partition_id() % 64)
    near = Window.partitionBy(item, "part").orderBy(*order)
    some = parts.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).drop("part")
    whole = Window.partitionBy(item).orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def search(
    index: DataFrame,
    items: DataFrame,
    k: int = 10,
    item: str = "item_id",
    key: str = "doc_id",
    text: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``(item, rank, key, score)``: the ``k`` best documents of the index for each item.

    Rows of one item are one query of all their terms, and so are the rows without an item id. Items are searched in
    passes over the index, each with at most about ``query_bytes`` of terms (an item's terms stay together),
    however many there are. Two columns of names that clash are for the caller to rename.
    """
    spark = index.sparkSession
    terms = stored(query_terms(items, item, text), "query-terms")
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()[0]
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = int(totals[0] or 0), int(totals[1] or 0)
    kind = index.schema["keys"].dataType.elementType.simpleString()
    item_kind = items.schema[item].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item].dataType)
    schema = f"`{item}` {item_kind}, `{key}` {kind}, score long"
    if not size or not n_terms:
        return spark.createDataFrame([], f"`{item}` {item_kind}, rank int, `{key}` {kind}, score long")
    wanted = measured(terms.select("term").distinct())
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    held = held.select(F.col("x.terms").alias("term"), F.col("x.counts").alias("df"))
    df = held.join(wanted.side(wanted.frame), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weighed = stored(terms.join(df, "term").withColumn("hash", F.xxhash64(item)), "weighed-terms")
    passes = -(-size // query_bytes)
    results = []
    for number in range(passes):
        block = weighed.where(F.pmod("hash", F.lit(passes)) == number)
        queries: defaultdict[object, list] = defaultdict(list)
        for r in block.collect():  # bounded by query_bytes
            queries[r[item]].append((bytes(r["term"]), weight(n_docs, r["df"])))

        def searched(
            batches: Iterator[pa.RecordBatch], queries: dict = dict(queries)
        ) -> Iterator[pa.RecordBatch]:
            wanted = pa.array(sorted({term for query in queries.values() for term, _ in query}), pa.binary())
            kth: dict[object, list[int]] = defaultdict(list)  # the best scores of the shards so far
            for batch in batches:
                for i in range(batch.num_rows):
                    keys = batch.column("keys")[i].values
                    reader = Reader(opened(batch, i, wanted), n_docs, n_terms)
                    names, docs, scores = [], [], []
                    for name, query in queries.items():
                        seen = kth[name]
                        at, got = search_shard(reader, query, k, seen[-1] if len(seen) == k else 0)
                        kth[name] = sorted(seen + got.tolist(), reverse=True)[:k]
                        names += [name] * len(at)
                        docs.append(at)
                        scores.append(got)
                    rows = np.concatenate(docs) if docs else np.zeros(0, np.int64)
                    values = np.concatenate(scores) if scores else rows
                    columns = [pa.array(names, item_type), keys.take(pa.array(rows)), pa.array(values)]
                    yield pa.RecordBatch.from_arrays(columns, names=[item, key, "score"])

        with small_batches(spark):
            results.append(stored(map_arrow(index.drop("n_docs", "n_terms", "counts"), searched, schema), "found"))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return best_rows(found, item, key, k).select(item, F.col("rank").cast("int"), key, "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``search`` over an index of ``docs`` that is written for it; an empty table gives no rows."""
    with small_batches(docs.sparkSession):
        index = stored(build_index(docs), "index", group_rows=1)
    return search(index, items, k)
