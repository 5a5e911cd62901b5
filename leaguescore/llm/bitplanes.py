"""Token ids as files of compressed bit or byte planes, with a chunk index.

A file holds the documents of one key range in ascending key order::

    MAGIC | plane | plane | ... | index (JSON, zstandard) | its length (8 bytes) | MAGIC

Three streams of unsigned integers make up a file: ``ids`` (all token ids), ``keys`` (document
ids in two's complement) and ``sizes`` (twice a document's ids, plus one if its key is null). A
stream is cut into chunks of ``CHUNK`` values; a chunk is transposed into bit or byte planes and
each plane is compressed on its own. The index has the place and size of every plane, so a
reader gets any chunk without the others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguescore.llm.runtime import (
    map_arrow,
    new_folder,
    partition_count,
    pieces_of,
    row_cuts,
    texts_of,
)
from leaguescore.llm.tokens import encoder

MAGIC = b"BITPLAN1"
CHUNK = 1 << 16
LEVEL = 3
#: Ids handed on in one batch of documents, about.
BATCH_IDS = 1 << 20


def to_planes(values: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """Transpose unsigned integers of ``width`` bytes into planes, the lowest first."""
    data = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width)
    if not bits:
        return [data[:, k].tobytes() for k in range(width)]
    single = np.unpackbits(data, axis=1, bitorder="little")
    return [np.packbits(single[:, k]).tobytes() for k in range(8 * width)]


def from_planes(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    arrays = [np.frombuffer(p, dtype=np.uint8) for p in planes]
    if bits:
        single = np.stack([np.unpackbits(a, count=n) for a in arrays], axis=1)
        data = np.packbits(single, axis=1, bitorder="little")
    else:
        data = np.stack(arrays, axis=1)
    return np.ascontiguousarray(data).reshape(-1).view(f"<u{width}")


class Writer:
    """One file. Memory is bounded by a chunk of each stream, and the index."""

    def __init__(self, sink, id_width: int, bits: bool) -> None:
        self.sink, self.bits, self.at = sink, bits, 0
        self.width = {"ids": id_width, "keys": 8, "sizes": 8}
        self.waiting: dict[str, list[np.ndarray]] = {name: [] for name in self.width}
        self.held = dict.fromkeys(self.width, 0)
        self.index: dict[str, list] = {name: [] for name in self.width}
        self.count = dict.fromkeys(self.width, 0)
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        self.at += len(data)
        return len(data)

    def add(self, stream: str, values: np.ndarray) -> None:
        self.waiting[stream].append(values)
        self.held[stream] += len(values)
        self.count[stream] += len(values)
        if self.held[stream] >= CHUNK:
            self._chunks(stream, last=False)

    def _chunks(self, stream: str, last: bool) -> None:
        parts = self.waiting[stream]
        values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        whole = len(values) if last else len(values) - len(values) % CHUNK
        for low in range(0, whole, CHUNK):
            chunk = values[low : min(low + CHUNK, whole)]
            at = self.at
            planes = to_planes(chunk, self.width[stream], self.bits)
            self.index[stream].append([len(chunk), at, [self._put(self.compress(p)) for p in planes]])
        self.waiting[stream] = [values[whole:]]
        self.held[stream] = len(values) - whole

    def close(self) -> None:
        for stream in self.width:
            self._chunks(stream, last=True)
        head = {"bits": self.bits, "width": self.width, "count": self.count, "chunks": self.index}
        size = self._put(self.compress(json.dumps(head).encode()))
        self._put(size.to_bytes(8, "little") + MAGIC)
        self.sink.close()


class Reader:
    """Any chunk of any stream of a file, without the others."""

    def __init__(self, source) -> None:
        self.source = source
        tail = source.size() - 16
        source.seek(tail)
        trailer = source.read(16)
        if trailer[8:] != MAGIC:
            raise ValueError("not a finished bit-plane file")
        size = int.from_bytes(trailer[:8], "little")
        source.seek(tail - size)
        self.expand = zstandard.ZstdDecompressor().decompress
        self.head = json.loads(self.expand(source.read(size)))

    def chunk(self, stream: str, number: int) -> np.ndarray:
        n, at, sizes = self.head["chunks"][stream][number]
        self.source.seek(at)
        planes = [self.expand(self.source.read(size)) for size in sizes]
        return from_planes(planes, n, self.head["width"][stream], self.head["bits"])

    def chunks(self, stream: str) -> Iterator[np.ndarray]:
        for number in range(len(self.head["chunks"][stream])):
            yield self.chunk(stream, number)

    def values(self, stream: str, start: int, length: int) -> np.ndarray:
        """A slice of a stream; only the chunks it touches are read."""
        first, last = start // CHUNK, (start + length - 1) // CHUNK
        parts = [self.chunk(stream, k) for k in range(first, last + 1)] if length else []
        whole = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return whole[start - first * CHUNK :][:length] if length else whole


def opened(uri: str, write: bool = False):
    """A file by its URI; a local path is one of a folder that all machines share."""
    store, path = fs.FileSystem.from_uri(uri)
    if not write:
        return store.open_input_file(path)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path)


def write_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 2,
    bits: bool = False,
    key: str = "doc_id",
    text: str = "text",
    special_ids: bool = False,
) -> list[dict]:
    """Encode documents and write them in ascending key order, a file for each range of rows.

    Returns the manifest, one entry per file: path, documents and ids, ranges ascending.
    Rows of one key are ordered by a hash of their texts, and may be in several files; null keys come last; a null text is
    empty. Keys are whole numbers, or are cast to them. A task
    that is run again writes a file of its own; the manifest names the file of the attempt
    that ended well. With ``special_ids``, text that spells a special token is that token,
    else ordinary text.
    """
    n = partition_count(docs.sparkSession)
    cuts = row_cuts(docs, key, text, n)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(vocabulary, special_ids)
        attempt = TaskContext.get().taskAttemptId()
        end, file, now = int(end_id).to_bytes(4, "little"), None, None

        def finished() -> pa.RecordBatch:
            file.close()
            row = [[now], [path(now)], [file.count["sizes"]], [file.count["ids"]]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in row], names=["range", "path", "n_docs", "n_ids"]
            )

        def path(number: int) -> str:
            return f"{folder}/range-{number:06d}-{attempt}.bitplanes"

        for batch in pieces_of(batches, text):
            numbers = np.asarray(batch.column(0).to_pylist())
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                if numbers[low] != now:
                    if file:
                        yield finished()
                    now = int(numbers[low])
                    file = Writer(opened(path(now), write=True), own.width, bits)
                data = [d + end for d in own.encode(texts_of(part, text))]
                file.add("ids", np.frombuffer(b"".join(data), dtype="<u4"))
                keys = part.column(1)
                missing = np.asarray(keys.is_null())
                known = keys.fill_null(0).to_numpy(zero_copy_only=False)
                file.add("keys", known.astype(np.int64).view(np.uint64))
                sizes = np.array([len(d) // 4 for d in data], dtype=np.uint64)
                file.add("sizes", 2 * sizes + missing.astype(np.uint64))
        if file:
            yield finished()

    order = F.col("k").asc_nulls_last()
    placed = docs.select(cuts.place().alias("at"), F.col(key).cast("long").alias("k"), text)
    ranged = placed.select(cuts.number(F.col("at")).alias("range"), "k", F.col("at.hash").alias("h"), text)
    dealt = ranged.repartition(n, "range").sortWithinPartitions("range", order, "h", text)
    sorted_docs = dealt.select("range", "k", text)
    manifest = map_arrow(sorted_docs, written, "range long, path string, n_docs long, n_ids long")
    rows = (row.asDict() for row in manifest.collect())  # at most one per key range
    return sorted(rows, key=lambda row: row["range"])


def read_files(spark: SparkSession, manifest: list[dict], key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids)`` of every document of the files, read back from them.

    ``start`` counts the ids of all documents before it, over all files. ``ids`` are
    little-endian unsigned 32-bit integers. A task holds a chunk of each stream and one
    batch of documents at a time.
    """
    starts, total = [], 0
    for row in manifest:
        starts.append((row["path"], total))
        total += row["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["path"]) as source:
                    yield from documents(Reader(source), row["start"])

    def documents(file: Reader, at: int) -> Iterator[pa.RecordBatch]:
        ids, held = file.chunks("ids"), b""
        for keys, marked in zip(file.chunks("keys"), file.chunks("sizes")):
            sizes = (marked >> np.uint64(1)).astype(np.int64)
            nulls = (marked & np.uint64(1)).astype(bool)
            keys = keys.view(np.int64)
            low = 0
            while low < len(sizes):
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), BATCH_IDS)))
                part = sizes[low:high]
                wanted = [held]
                while sum(map(len, wanted)) < 4 * int(part.sum()):
                    wanted.append(next(ids).astype("<u4").tobytes())
                data = b"".join(wanted)
                ends = np.cumsum(part)
                begins = ends - part
                own = [data[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist())]
                held = data[4 * int(ends[-1]) :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[low:high], mask=nulls[low:high]),
                        pa.array(at + begins),
                        pa.array(part),
                        pa.array(own, pa.binary()),
                    ],
                    names=[key, "start", "n_tokens", "ids"],
                )
                at += int(ends[-1])
                low = high

    schema = f"`{key}` long, start long, n_tokens long, ids binary"
    if not starts:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(starts, "path string, start long")
    return map_arrow(files.repartition(len(starts), "path"), read, schema)


def round_trip(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the documents to a new folder of the shared one, and read them back."""
    spark = docs.sparkSession
    return read_files(spark, write_files(docs, new_folder(spark, "planes"), vocabulary, **options))
