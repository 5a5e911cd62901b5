"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

The letters form 16 groups. A word's frequency vector has its number of letters in each group; the
trie arranges words by these counts, one group after another. One inserted letter adds one to one count, one
deleted letter takes one away, one replaced letter does both, or neither within a group. So the words
near a given one are in the leaves that a depth-first search reaches with a budget of one surplus
and one deficit. Leaf words are verified letter by letter.

The trie is spread by its upper levels: the counts of the first groups name a subtree, and a word is sent to
the subtrees that its budgets reach. Large subtrees are cut by a hash of their words, and the words that look there are
sent to every part, so no task holds more than ``TRIE_WORDS`` of one at a time. A pair is found once, from the word
whose first differing count is the smaller one; from the smaller word if none differs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import bytes_of, map_arrow, partition_count, pieces_of, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A letter's group is its code point modulo 16; the order of groups in the vector, common letters first.
GROUPS, ORDER = 16, (5, 4, 1, 3, 14, 9, 15, 2, 12, 8, 13, 7, 0, 6, 11, 10)
#: Upper levels, whose counts name a subtree; words of a subtree's part; words of a node that are verified at once.
TOP, TRIE_WORDS, LEAF = 5, 20_000, 4
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 400_000
#: A subtree's number: its counts weighed by powers of this, modulo a power of two, so that sums of two numbers stay in 64 bits.
BASE, RING = 1_000_003, 1 << 61


def runs_of(text: bytes) -> Counter[str]:
    """Lower-cased (A-Z only) runs of letters of a text, with their counts."""
    return Counter(RUN.findall(text.lower().decode()))  # lower() is ASCII only for bytes


def varied(prefix: int, run: str) -> str:
    """The run, less one letter where 97 divides the crc32 of ``<key>:<run>``; ``prefix`` is that of ``<key>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = 5,
    least_count: int = 3,
) -> DataFrame:
    """``(word, n)``: the words of whole texts that are long and frequent enough, with their counts.

    A null text has no words; a null key counts as the empty text in the hash. Rows may repeat.
    Counts are combined in the tasks, so a word that is everywhere sends few rows.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in pieces_of(batches, text):
            for k, value in zip(batch.column(0).to_pylist(), bytes_of(batch, text)):
                prefix = zlib.crc32(f"{'' if k is None else k}:".encode())
                for run, n in runs_of(value).items():
                    word = varied(prefix, run)
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield counts(held)
                    held.clear()
        if held:
            yield counts(held)

    def counts(held: Counter[str]) -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    found = map_arrow(docs.select(key, text), counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def vectors(some: list[str]) -> np.ndarray:
    """The frequency vectors of words, one a row."""
    lengths = np.fromiter(map(len, some), np.int64, len(some))
    codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(some)), lengths)
    place = np.argsort(ORDER)
    cells = np.bincount(rows * GROUPS + place[codes % GROUPS], minlength=len(some) * GROUPS)
    return cells.reshape(-1, GROUPS)


def powers() -> np.ndarray:
    return np.array([pow(BASE, i, RING) for i in range(1, TOP + 1)], np.int64)


def moves() -> np.ndarray:
    """What the budgets can add to a subtree's number, modulo ``RING``, from the side whose first differing count is smaller."""
    p = powers()
    up_and_down = [p[i] - p[j] for i in range(TOP) for j in range(i + 1, TOP)]
    return np.array([0, *p, *up_and_down], np.int64) % RING


def subtrees(rows: DataFrame) -> DataFrame:
    """``(word, n, subtree)``: the subtree that each word is in."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                top = vectors(batch.column(0).to_pylist())[:, :TOP]
                own = (top * powers()).sum(axis=1) & (RING - 1)  # 64 bits that wrap are right in the low ones
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=["word", "n", "subtree"])

    return map_arrow(rows.select("word", "n"), numbered, "word string, n long, subtree long")


def near(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced letter?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = 0
    for x, y in zip(a, b):
        if x != y:
            break
        at += 1
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def verified(looking: list[str], leaf: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places of words that are near.

    One edit leaves the first or the second half of the shorter word as it is, so in a leaf of
    many words only those that share a half are compared.
    """
    if len(looking) * len(leaf) <= 64:
        for i, a in enumerate(looking):
            for j, b in enumerate(leaf):
                if near(a, b):
                    yield i, j
        return
    by_half: dict[int, dict] = {}
    for i, a in enumerate(looking):
        for shorter in {min(len(a), len(b)) for b in leaf if abs(len(a) - len(b)) <= 1}:
            if shorter not in by_half:
                table = by_half[shorter] = defaultdict(list)
                for j, b in enumerate(leaf):
                    if shorter <= len(b) <= shorter + 1:
                        table["first", b[: shorter // 2]].append(j)
                        table["last", b[len(b) - (shorter - shorter // 2) :]].append(j)
            table = by_half[shorter]
            halves = (("first", a[: shorter // 2]), ("last", a[len(a) - (shorter - shorter // 2) :]))
            places = {j for half in halves for j in table.get(half, ())}
            for j in places:
                if min(len(a), len(leaf[j])) == shorter and near(a, leaf[j]):
                    yield i, j


class Trie:
    """Words sorted by their vectors; a node is a run of rows that agree in the counts so far."""

    def __init__(self, some: list[str]):
        found = vectors(some)
        order = np.lexsort(found.T[::-1])
        self.named = some
        self.vectors = found[order]
        self.words = [some[i] for i in order.tolist()]
        self.places = order

    def search(self, looking: list[str]) -> Iterator[tuple[int, int]]:
        """Pairs (place in ``looking``, place in the trie's own list) of near words, each pair from one side.

        A depth-first search of the whole batch: a node is entered with the words whose budgets reach it.
        """
        wanted = vectors(looking)
        everyone = np.arange(len(looking))
        unspent = np.zeros(len(looking), bool)
        stack = [(0, 0, len(self.words), everyone, unspent, unspent)]
        while stack:
            depth, low, high, who, surplus, deficit = stack.pop()
            while depth < GROUPS and high - low > LEAF:
                column = self.vectors[low:high, depth]
                if column[0] != column[-1]:
                    break
                who, surplus, deficit = spend(column[0] - wanted[who, depth], who, surplus, deficit)
                depth += 1
            if not len(who):
                continue
            if depth == GROUPS or high - low <= LEAF:
                yield from self.leaf(low, high, depth, who, surplus, deficit, looking, wanted)
                continue
            column = self.vectors[low:high, depth]
            starts = np.append(0, np.flatnonzero(np.diff(column)) + 1)
            ends = np.append(starts[1:], high - low)
            for start, end in zip(starts.tolist(), ends.tolist()):
                left = spend(column[start] - wanted[who, depth], who, surplus, deficit)
                if len(left[0]):
                    stack.append((depth + 1, low + start, low + end, *left))

    def leaf(self, low, high, depth, who, surplus, deficit, looking, wanted) -> Iterator[tuple[int, int]]:
        rest = self.vectors[low:high, depth:]
        step = max(1, (1 << 18) // max(1, (high - low) * max(1, GROUPS - depth)))
        for at in range(0, len(who), step):
            some = who[at : at + step]
            if depth < GROUPS:
                fits = [
                    spend_all(row, some, surplus[at : at + step], deficit[at : at + step], wanted, depth)
                    for row in rest
                ]
                groups = [(some[f], [low + i]) for i, f in enumerate(fits) if f.any()]
            else:
                groups = [(some, range(low, high))]
            for looked, leaf in groups:
                texts, found = [looking[i] for i in looked.tolist()], [self.words[j] for j in leaf]
                same = {i: not (surplus_of(wanted[q], self.vectors[leaf[0]])) for i, q in enumerate(looked.tolist())}
                for i, j in verified(texts, found):
                    if not same[i] or texts[i] < found[j]:
                        yield int(looked[i]), int(self.places[leaf[j]])


def surplus_of(a: np.ndarray, b: np.ndarray) -> bool:
    return bool((b > a).any())


def spend(delta, who, surplus, deficit):
    """Who can go on after a count that differs by ``delta``, and what of the budgets is spent."""
    fits = (delta == 0) | ((delta == 1) & ~surplus) | ((delta == -1) & ~deficit & surplus)
    return who[fits], (surplus | (delta == 1))[fits], (deficit | (delta == -1))[fits]


def spend_all(row, who, surplus, deficit, wanted, depth) -> np.ndarray:
    """Who can reach the leaf of ``row`` through all the counts that are left."""
    delta = row - wanted[who, depth:]
    up, down = np.maximum(delta, 0).sum(axis=1), np.maximum(-delta, 0).sum(axis=1)
    fits = (up + surplus <= 1) & (down + deficit <= 1)
    first = np.where((delta != 0).any(axis=1), delta[np.arange(len(delta)), (delta != 0).argmax(axis=1)], 0)
    return fits & (surplus | (first >= 0))  # a surplus comes before a deficit


def near_counts(rows: DataFrame, trie_words: int = TRIE_WORDS) -> DataFrame:
    """``(word, n_near, best)``: how many words are near, and of those the one of largest ``n``.

    ``best`` is ``(n, word)``, ties to the smallest word by code points; words without near ones are
    left out. Words are distinct. What a task finds is added up there, so a word with many near ones sends few rows.
    """
    spark = rows.sparkSession
    placed = stored(subtrees(rows), "subtrees")
    parts = F.ceil(F.count(F.lit(1)) / F.lit(trie_words)).cast("int").alias("parts")
    sizes = stored(placed.groupBy("subtree").agg(parts), "subtree-sizes")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    kept = placed.join(sizes, "subtree").select("subtree", part.alias("part"), F.lit(0).alias("looks"), "word", "n")
    reached = [(F.col("subtree") + F.lit(int(m))).bitwiseAND(F.lit(RING - 1)) for m in moves()]
    reach = F.explode(F.array(*reached)).alias("subtree")
    looking = placed.select(reach, "word", "n").join(sizes, "subtree")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    looking = looking.select("subtree", every, F.lit(1).alias("looks"), "word", "n")
    n = max(partition_count(spark), -(-placed.count() // (4 * trie_words)))
    dealt = kept.union(looking).repartition(n, "subtree", "part").sortWithinPartitions("subtree", "part", "looks")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}

        def note(word: str, n: int, other: str) -> None:
            got = found.get(word)
            if got is None:
                found[word] = [1, n, other]
                return
            got[0] += 1
            if n > got[1] or n == got[1] and other < got[2]:
                got[1:] = n, other

        for trie, own, looking, theirs in searches(batches):
            for i, j in trie.search(looking):
                note(looking[i], own[j], trie.named[j])
                note(trie.named[j], theirs[i], looking[i])
            if len(found) >= HELD_WORDS:
                yield noted(found)
                found.clear()
        if found:
            yield noted(found)

    def noted(found: dict[str, list]) -> pa.RecordBatch:
        n_near, best_n, best = zip(*found.values())
        columns = [pa.array(list(found), pa.string()), pa.array(n_near, pa.int64())]
        columns += [pa.array(best_n, pa.int64()), pa.array(best, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    pairs = map_arrow(dealt, matched, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    found = pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    return found.select("word", "n_near", F.struct((-F.col("best.n")).alias("n"), "best.word").alias("best"))


def searches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Trie, list[int], list[str], list[int]]]:
    """Each subtree's part with the words that look there, batch by batch; rows come in that order."""
    at, trie = None, None
    held: list[tuple[str, int]] = []
    for batch in batches:
        subtree, part, looks = (batch.column(i).to_numpy() for i in range(3))
        change = (np.diff(subtree) != 0) | (np.diff(part) != 0) | (np.diff(looks) != 0)
        starts = np.append(0, np.flatnonzero(change) + 1).tolist() if batch.num_rows else []
        names, counts = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            here = (int(subtree[low]), int(part[low]))
            if here != at:
                at, trie, held = here, None, []
            if looks[low] == 0:
                held += zip(names[low:high], counts[low:high])
            elif held:
                if trie is None:
                    trie = Trie([w for w, _ in held])
                    own = [n for _, n in held]
                yield trie, own, names[low:high], counts[low:high]


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of each word that has a form: the end of its chain of forms.

    Every round doubles the steps that are taken; each form has twice the count of its word
    at least, so chains have at most as many steps as the greatest count has bits.
    """
    rooted = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        later = rooted.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = rooted.join(later, "root", "left")
        step = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more"))
        step = stored(step, "roots")
        if step.where("more").isEmpty():
            return rooted
        rooted = step.drop("more")


def variants(rows: DataFrame, ratio: int = 2, trie_words: int = TRIE_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``(word, n)``, which are distinct.

    A word's form is its near word of largest ``n``, ties to the smallest in code-point order, if
    that is at least ``ratio`` times (over 1) the word's own; the root is the end of the chain of forms.
    """
    rows = stored(rows.select("word", "n"), "words")
    found = rows.join(near_counts(rows, trie_words), "word", "left")
    is_form = F.col("best.n") >= ratio * F.col("n")
    formed = stored(
        found.select(
            "word",
            F.when(is_form, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    rooted = roots(formed.where("form IS NOT NULL"))
    whole = formed.join(rooted, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select("word", "form", "root", "n", "n_near", "form_n")
