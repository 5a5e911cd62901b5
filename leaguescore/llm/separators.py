"""Documents of flat token files, found by scanning for the end-of-document id.

The files are bare little-endian ids without any index. They are read in blocks of a fixed
size; each block is searched for the separator with one vectorised comparison. A document that
crosses blocks is stitched by a prefix scan over the blocks of its file: the number of
separators before a block, and the place of the last one before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguescore.llm.bitplanes import opened
from leaguescore.llm.runtime import map_arrow, pieces_of, texts_of
from leaguescore.llm.tokens import encoder

BLOCK_BYTES = 4 << 20
#: A file is closed at about this size and the next one begun.
FILE_BYTES = 256 << 20


def write_flat(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write token files where the documents are, without a shuffle.

    Returns ``(file, ordinal, key)``: which document is at which place of a file. The
    files themselves have ids only, two bytes each if the vocabulary allows, else four. A
    null text is empty. Store the result: computing it again writes the files again.
    """
    kind = docs.schema[key].dataType.simpleString()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        own = encoder(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        sink, number, ordinal, size = None, 0, 0, 0
        for batch in pieces_of(batches, text):
            if sink is None or size > FILE_BYTES:
                if sink:
                    sink.close()
                name = f"{task.partitionId():06d}-{number:03d}-{task.taskAttemptId()}.ids"
                sink, number, ordinal, size = opened(f"{folder}/{name}", True), number + 1, 0, 0
            data = b"".join(d + end for d in own.encode(texts_of(batch, text)))
            flat = np.frombuffer(data, dtype="<u4").astype(f"<u{own.width}").tobytes()
            sink.write(flat)
            size += len(flat)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n, pa.string()),
                    pa.array(np.arange(ordinal, ordinal + n)),
                    batch.column(0),
                ],
                names=["file", "ordinal", key],
            )
            ordinal += n
        if sink:
            sink.close()

    return map_arrow(
        docs.select(key, text), written, f"file string, ordinal long, `{key}` {kind}"
    )


def scan_blocks(spark: SparkSession, files: list[tuple[str, str]], width: int, end_id: int,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(file, block, start, n_ids, ends)``: where the separators are in each block.

    ``files``: name and URI of each. ``ends`` are places within the file.
    """
    sized = [(name, uri, _size(uri) // width) for name, uri in files]
    step = max(1, block_bytes // width)
    plan = spark.createDataFrame(sized, "file string, uri string, n long").where("n > 0")
    blocks = plan.select(
        "file",
        "uri",
        F.explode(F.expr(f"sequence(0L, n - 1, {step}L)")).alias("start"),
        F.lit(step).alias("step"),
        "n",
    ).select("file", "uri", "start", F.least("step", F.col("n") - F.col("start")).alias("n_ids"))
    tasks = max(1, sum(-(-n // step) for _, _, n in sized))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["uri"]) as source:
                    source.seek(row["start"] * width)
                    ids = np.frombuffer(source.read(row["n_ids"] * width), dtype=f"<u{width}")
                ends = np.flatnonzero(ids == end_id) + row["start"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([row["start"]]),
                        pa.array([row["n_ids"]]),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["file", "start", "n_ids", "ends"],
                )

    dealt = blocks.repartition(min(tasks, 10_000), "file", "start")
    return map_arrow(dealt, scanned, "file string, start long, n_ids long, ends array<long>")


def stitch(blocks: DataFrame) -> DataFrame:
    """``(file, ordinal, start, n_tokens)`` of every document, the separator not counted.

    The prefix scan orders the blocks of one file, whose number the file size bounds. Ids
    after the last separator of a file are a document that has no end, with the next ordinal.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    placed = blocks.select(
        "file",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ordinal"),
        F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1)).alias("last"),
        "ends",
        F.max(F.col("start") + F.col("n_ids")).over(whole).alias("file_end"),
        (F.max("start").over(whole) == F.col("start")).alias("is_last"),
    )
    closing = F.when(
        F.col("is_last")
        & (F.coalesce(F.try_element_at("ends", F.lit(-1)), "last") < F.col("file_end") - 1),
        F.array("file_end"),
    ).otherwise(F.array().cast("array<bigint>"))
    opened_at = F.concat(F.array("last"), "ends")
    return (
        placed.withColumn("ends", F.concat("ends", closing))
        .withColumn("begins", opened_at)
        .select("file", "ordinal", "begins", F.posexplode("ends").alias("k", "end"))
        .select(
            "file",
            (F.col("ordinal") + F.col("k")).alias("ordinal"),
            (F.get("begins", F.col("k")) + 1).alias("start"),
        "end",
        )
        .select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"))
    )


def _size(uri: str) -> int:
    with opened(uri) as source:
        return source.size()


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    folder: str,
    placed: DataFrame,
    key: str = "doc_id",
) -> DataFrame:
    """``(key, file, ordinal, start, n_tokens)`` of documents written by ``write_flat``.

    ``placed`` is its stored result; files that a lost attempt left behind are not read.
    """
    names = [r["file"] for r in placed.select("file").distinct().collect()]  # one per 256 MB
    files = [(name, f"{folder}/{name}") for name in sorted(names)]
    width = encoder(vocabulary).width
    found = stitch(scan_blocks(docs.sparkSession, files, width, end_id))
    # The plan sees a short list of files only, and would take what they hold for small.
    return placed.join(found.hint("merge"), ["file", "ordinal"], "left").select(
        key, "file", "ordinal", "start", "n_tokens"
    )
