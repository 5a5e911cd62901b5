"""Best-fit packing of token pieces under several capacities at once.

A piece is a vector: its tokens, one document, and its attention cost (the square of its
tokens). A sequence is a bin with a capacity for each. Pieces are placed largest first, each
into the open sequence that fits it under every constraint and scores best:

* ``norm``: the smallest weighted norm of what is left of the sequence afterwards;
* ``dot``: the largest weighted dot product of the piece and what is left before.

Pieces are dealt by a hash into groups of about ``GROUP_ROWS`` rows that are packed side by
side. The number of groups grows with the table; each costs at most a few sequences. The hash
includes the partition, so rows alike, were they a third of all, do not meet in one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguescore.llm.runtime import map_arrow, pieces_of, texts_of
from leaguescore.llm.tokens import encoder

GROUP_ROWS = 8_192


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how much each resource counts in the choice."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=float)


def cut_pieces(
    docs: DataFrame,
    vocabulary: str,
    tokens: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    special_ids: bool = False,
) -> DataFrame:
    """``(key, piece, start, length, ids)``: documents as token ids, cut where too long.

    ``ids`` are little-endian unsigned 32-bit integers, the document's end id last. All
    pieces of a long document but the first have ``tokens`` ids. A null text is empty. With
    ``special_ids``, text that spells a special token is that token, else ordinary text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, special_ids).encode
        end = int(end_id).to_bytes(4, "little")
        for batch in pieces_of(batches, text):
            rows, numbers, starts, ids = [], [], [], []
            for row, data in enumerate(encode(texts_of(batch, text))):
                data += end
                n = len(data) // 4
                first = (n - 1) % tokens + 1
                edges = [0, *range(first, n + 1, tokens)]
                for number, (low, high) in enumerate(zip(edges, edges[1:])):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(low)
                    ids.append(data[4 * low : 4 * high])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(d) // 4 for d in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=[key, "piece", "start", "length", "ids"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(
        docs.select(key, text),
        cut,
        f"`{key}` {kind}, piece int, start long, length long, ids binary",
    )


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and place in it of every piece, in the order given."""
    limits, weights = capacity.limits(), np.array(capacity.weights)
    sizes = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1).astype(float)
    if (sizes > limits).any():
        raise ValueError("a piece is larger than an empty sequence")
    sizes /= limits
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    left = np.empty((len(lengths), 3))  # of the open sequences
    names = np.empty(len(lengths), dtype=np.int64)
    filled = np.zeros(len(lengths), dtype=np.int64)
    n_open = made = 0
    least = sizes.min(axis=0) - 1e-12 if len(sizes) else None
    for step, item in enumerate(order):
        size = sizes[item]
        room = left[:n_open]
        fit = np.flatnonzero((room >= size - 1e-12).all(axis=1))
        if len(fit):
            if capacity.rule == "dot":
                best = fit[np.argmax(room[fit] @ (weights * size))]
            else:
                best = fit[np.argmin(((room[fit] - size) ** 2) @ weights)]
        else:
            best, left[n_open], names[n_open] = n_open, 1.0, made
            n_open += 1
            made += 1
        left[best] -= size
        sequence[item], offset[item] = names[best], filled[names[best]]
        filled[names[best]] += lengths[item]
        if (left[best] < least).any():  # nothing fits any more
            n_open -= 1
            left[best], names[best] = left[n_open], names[n_open]
    return sequence, offset


def pack(
    pieces: DataFrame,
    capacity: Capacity,
    n_rows: int,
    length: str = "length",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The same rows with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    ``n_rows``: about how many rows there are, to set the number of groups; smaller groups
    suit rows that carry their ids. Columns of the result's names are replaced. Rows whose
    length is null or less than one are not packed: both new columns are null. A row's group
    depends on its values and on its partition, and its place on the values in its group, not on the order in which
    rows arrive, so a task that runs again deals and packs its rows alike.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_group")]
    n_groups = max(1, -(-n_rows // group_rows))
    narrow = [c for c in own if not isinstance(pieces.schema[c].dataType, _WIDE)]
    group = F.pmod(F.xxhash64(*narrow, F.spark_partition_id()), F.lit(n_groups))
    kept = pieces.select(*[F.col(f"`{c}`") for c in own]).withColumn("_group", group)
    schema = T.StructType(
        [
            *kept.drop("_group").schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        sizes = rows.column(length).to_pandas().to_numpy(dtype=float, na_value=0)
        order = pc.sort_indices(rows, [(c, "ascending") for c in narrow]).to_numpy()  # not that of arrival
        good = order[sizes[order] >= 1]
        sequence, offset = best_fit(sizes[good].astype(np.int64), capacity)
        new = pd.DataFrame({"s": None, "o": None}, index=range(len(sizes)), dtype="Int64")
        new.iloc[good, 0] = sequence + (key[0].as_py() << 32)
        new.iloc[good, 1] = offset
        out = rows.drop_columns(["_group"])
        out = out.append_column("sequence_id", pa.array(new["s"], pa.int64()))
        return out.append_column("offset", pa.array(new["o"], pa.int64()))

    return kept.groupBy("_group").applyInArrow(packed, schema)


#: Columns that are costly to hash or cannot be.
_WIDE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
