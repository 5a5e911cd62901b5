"""Document probability from a subword lattice that sums over all segmentations.

The pieces of an existing vocabulary are given unigram probabilities by expectation-maximisation
over all distinct training words; the vocabulary's own scores are where it starts. A word is a
blank and its bytes, and every way to cut it into pieces counts: a forward recursion in log space
adds them up. A piece holds a blank at its start only, so no piece crosses a word, and the
probability of a document is the product over its words and its end. All single bytes are pieces,
so every word has a probability above zero.

A word of the training documents has one more edge in its lattice, from its first byte to its
last, with the discounted share of its uses; what the discount saves goes to the pieces. So
the probabilities of all words and the end add up to one::

    P(word) = max(c - d, 0) / N + (d * V / N) * sum over segmentations of the product of pieces
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import bytes_of, map_arrow, merged, pieces_of, stored

#: What ends a document; no word is empty.
END = b""
BLANK = b" "
#: Words of up to so many bytes are scored side by side; longer ones one by one.
SIDE_BY_SIDE = 48
FLUSH_WORDS = 400_000
FLUSH_BYTES = 12 << 20


class Vocabulary:
    """Pieces as bytes, found in many words at once by walking a trie with arrays."""

    def __init__(self, pieces: list[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = {}
        for number, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = number
        # Nodes with children come first; only they have a row of the table.
        inner = [k for k, c in enumerate(children) if c]
        leaves = [k for k, c in enumerate(children) if not c]
        place = {node: k for k, node in enumerate([*inner, *leaves])}
        self.inner = len(inner)
        self.after = np.full((len(inner), 256), -1, dtype=np.int32)
        for row, node in enumerate(inner):
            for byte, child in children[node].items():
                self.after[row, byte] = place[child]
        self.piece = np.full(len(children), -1, dtype=np.int32)
        for node, number in ends.items():
            self.piece[place[node]] = number

    def spans(
        self, words: np.ndarray
    ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(start, end, rows, pieces)`` over words of one length, by ascending start.

        ``rows``: the words whose bytes from start to end are a piece.
        """
        n, length = words.shape
        columns = np.ascontiguousarray(words.T)
        for start in range(length):
            rows, nodes = np.arange(n), np.zeros(n, dtype=np.int32)
            for end in range(start + 1, length + 1):
                nodes = self.after[nodes, columns[end - 1][rows]]
                found = np.flatnonzero(nodes >= 0)
                rows, nodes = rows[found], nodes[found]
                numbers = self.piece[nodes]
                ended = np.flatnonzero(numbers >= 0)
                if len(ended):
                    yield start, end, rows[ended], numbers[ended]
                more = np.flatnonzero(nodes < self.inner)
                rows, nodes = rows[more], nodes[more]
                if not len(rows):
                    break


def vocabulary_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model and the log of their starting probabilities.

    The blank mark becomes a blank; pieces with a blank beyond their start, and control
    pieces, are left out. Pieces are lower-case there, as words are. The scores of a vocabulary
    of merges are ranks, which become weights as in Zipf's law. Every byte is a piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank: dict[bytes, float] = {}
    for number in range(model.get_piece_size()):
        if model.is_control(number) or model.is_unknown(number) or model.is_byte(number):
            continue
        piece = model.id_to_piece(number).replace("▁", " ").encode().lower()
        if b" " not in piece[1:]:
            rank.setdefault(piece, -model.get_score(number) + 1.0)
    last = 10.0 * max(rank.values(), default=1.0)
    for byte in range(256):
        rank.setdefault(bytes([byte]), last)
    pieces = sorted(rank)
    weights = 1.0 / (100.0 + np.array([rank[p] for p in pieces]))
    return pieces, np.log(weights / weights.sum())


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary_at(path: str) -> Vocabulary:
    """The worker's copy of a vocabulary."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(vocabulary_pieces(path)[0])
    return _VOCABULARIES[path]


def forward(vocabulary: Vocabulary, logs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all segmentations, of words of one length."""
    alpha = np.full((words.shape[1] + 1, len(words)), -np.inf)
    alpha[0] = 0.0
    for start, end, rows, pieces in vocabulary.spans(words):
        alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + logs[pieces])
    return alpha[-1]


def expected(vocabulary: Vocabulary, logs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in words of one length, by forward and backward sums."""
    spans = list(vocabulary.spans(words))
    alpha = np.full((words.shape[1] + 1, len(words)), -np.inf)
    beta = alpha.copy()
    alpha[0] = beta[-1] = 0.0
    for start, end, rows, pieces in spans:
        alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + logs[pieces])
    uses = np.zeros(len(logs))
    for start, end, rows, pieces in reversed(spans):
        after = logs[pieces] + beta[end, rows]
        beta[start, rows] = np.logaddexp(beta[start, rows], after)
        share = np.exp(alpha[start, rows] + after - alpha[-1, rows])
        uses += np.bincount(pieces, weights=share, minlength=len(uses))
    return uses


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, letters)``: words of one length as a matrix of bytes, a blank before each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = 8192 if length < SIDE_BY_SIDE else max(1, 100_000 // int(length))
        for low in range(0, len(rows), step):
            part = rows[low : low + step]
            data = b"".join(BLANK + words[k] for k in part.tolist())
            yield part, np.frombuffer(data, dtype=np.uint8).reshape(len(part), length + 1)


def word_logs(vocabulary: Vocabulary, logs: np.ndarray, words: list[bytes]) -> np.ndarray:
    out = np.empty(len(words))
    for rows, letters in by_length(words):
        out[rows] = forward(vocabulary, logs, letters)
    return out


def is_held_out(key: Column) -> Column:
    """One document in seven: crc32 of the key as text leaves 2; a null key is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(word, n)``: every word of all documents, with its uses in training documents.

    Words are lower-cased (A-Z) runs without ASCII white space; each document adds one
    ``END``. Counts are combined within tasks before the shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        others: set[bytes] = set()

        def rows() -> pa.RecordBatch:
            for word in others:
                seen.setdefault(word, 0)
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"],
            )
            seen.clear()
            others.clear()
            return out

        for batch in pieces_of(batches, "t"):
            for data, held in zip(bytes_of(batch, "t"), batch.column(0).to_pylist()):
                words = data.lower().split()
                words.append(END)
                (others if held else seen).update(words)
            if len(seen) + len(others) > FLUSH_WORDS:
                yield rows()
        yield rows()

    rows = docs.select(is_held_out(F.col(key)).alias("held"), F.col(text).alias("t"))
    return map_arrow(rows, counted, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def fit(words: DataFrame, vocabulary_path: str, rounds: int = 2) -> np.ndarray:
    """Piece log probabilities after rounds of expectation-maximisation.

    ``words`` has all training words, each of which counts once. A round is one pass over them
    in tasks; what reaches the driver is one number per piece of the vocabulary. Half a use
    is added to all.
    """
    pieces, logs = vocabulary_pieces(vocabulary_path)
    for _ in range(rounds):
        now = logs

        def expectations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, uses = vocabulary_at(vocabulary_path), np.zeros(len(now))
            for batch in merged(batches):
                for _, letters in by_length(batch.column(0).to_pylist()):
                    uses += expected(vocabulary, now, letters)
            some = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(uses[some])], names=["piece", "uses"]
            )

        found = map_arrow(words.select("word"), expectations, "piece long, uses double")
        uses = np.full(len(pieces), 0.5)
        for row in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row["piece"]] += row["uses"]  # at most one row per piece
        logs = np.log(uses / uses.sum())
    return logs


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(word, docs, uses)``: the documents of a part of the table that have a word.

    A part is about ``FLUSH_BYTES`` of text of one task, so a very common word has a row for
    each part, not for each document. ``docs`` are the row keys of ``row_key``.
    """

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[bytes, list[int]] = defaultdict(list)
        uses: dict[bytes, list[int]] = defaultdict(list)
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(names)
            for low in range(0, len(words), 20_000):
                part = words[low : low + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.binary()),
                        pa.array([names[w] for w in part], pa.list_(pa.int64())),
                        pa.array([uses[w] for w in part], pa.list_(pa.int32())),
                    ],
                    names=["word", "docs", "uses"],
                )
            names.clear()
            uses.clear()

        for batch in pieces_of(batches, "t"):
            for data, row in zip(bytes_of(batch, "t"), batch.column(0).to_pylist()):
                words = data.lower().split()
                words.append(END)
                for word, n in Counter(words).items():
                    names[word].append(row)
                    uses[word].append(n)
                size += len(data)
            if size > FLUSH_BYTES:
                yield from rows()
                size = 0
        yield from rows()

    rows = docs.select(row_key(key, text).alias("row"), F.col(text).alias("t"))
    return map_arrow(rows, gathered, "word binary, docs array<long>, uses array<int>")


def row_key(key: str, text: str) -> Column:
    """Names a row by its key and text; rows alike in both have one score anyway."""
    return F.xxhash64(F.col(key), F.col(text))


def score(
    docs: DataFrame,
    vocabulary_path: str,
    rounds: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    ``base_score`` is the add-one unigram score over whole words, ``score`` the lattice's, both
    as log10. Words of documents never meet a copy of the whole table of words: each part's
    distinct words are joined to it by word, and what they add is summed per document. A null
    text is empty, and has its end only. Rows alike in key and text each get their row.
    """
    counts = stored(word_counts(docs, key, text), "words")
    seen = counts.where("n > 0")
    n, v, once, twice = seen.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count(F.lit(1)),
        F.count_if(F.col("n") == 1),
        F.count_if(F.col("n") == 2),
    ).first()
    discount = (once + 0.5) / (once + 2 * twice + 1.0)
    logs = fit(seen.where(F.col("word") != F.lit(END)), vocabulary_path, rounds)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_at(vocabulary_path)
        saved = np.log(discount * v / n) if n else np.log(0.5)
        for batch in merged(batches):
            own = batch.column(0).to_pylist()
            pieced = saved + word_logs(vocabulary, logs, own)
            pieced[[k for k, w in enumerate(own) if w == END]] = -np.inf
            uses = batch.column(1).to_numpy()
            whole = np.full(len(own), -np.inf)
            known = uses > 0
            whole[known] = np.log((uses[known] - discount) / n)
            if not n:  # nothing to learn from: the end is as likely as a word
                whole[[k for k, w in enumerate(own) if w == END]] = np.log(0.5)
            whole = np.logaddexp(whole, pieced) / np.log(10)
            yield from batch.append_column("lattice", pa.array(whole)).to_batches()

    table = map_arrow(counts, scored, "word binary, n long, lattice double")
    spread = postings(docs, key, text).join(table, "word").select(
        F.explode(F.arrays_zip("docs", "uses")).alias("p"), "word", "n", "lattice"
    )
    base = F.log10((F.col("n") + 1) / F.lit(float(n + v + 1)))
    uses = F.col("p.uses")
    sums = spread.groupBy(F.col("p.docs").alias("row")).agg(
        F.sum(uses).alias("n_tokens"),
        F.sum(F.when(F.col("n") > 0, uses).otherwise(0)).alias("n_known"),
        F.sum(F.when(F.col("word") == F.lit(END), uses).otherwise(0)).alias("copies"),
        F.sum(uses * base).alias("base_score"),
        F.sum(uses * F.col("lattice")).alias("score"),
    )
    rows = docs.select(F.col(key), row_key(key, text).alias("row"))
    each = F.col("copies")
    return rows.join(sums, "row").select(
        key,
        is_held_out(F.col(key)).alias("held_out"),
        (F.col("n_tokens") / each).cast("long").alias("n_tokens"),
        (F.col("n_known") / each).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") / each).alias("base_score"),
        (F.col("score") / each).alias("score"),
    )
