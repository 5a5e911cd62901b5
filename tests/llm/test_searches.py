"""Ranked search, spelling variants and nearest neighbours, against plain code."""

import functools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from leaguescore.llm import nearest, ranking, spelling
from leaguescore.llm.registry import QUERIES
from leaguescore.llm.runtime import map_arrow, own_tables, small_batches, stored

SF_DIR = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet, " * 6000
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog"),
    (1, None),
    (2, ""),
    (3, " \t\n--"),
    (4, "fox"),
    (5, LONG + "fox"),
    (6, "the quick, brown fox; jumps over the lazy dog"),
    (7, "\x00fox\x7f漢字 Éa éa FOX's x_y"),
    (8, "fox den"),
    (8, "fox den"),
    (-9, "fox den"),
    (None, "fox den"),
]
#: Columns beside the usual ones have names that the operators add.
EXTRA = "rank int, score string, term string, word string, n string, keys int, part string, node int, ids int"


def with_extra(spark, rows, schema):
    """The rows with columns of clashing names."""
    df = spark.createDataFrame(rows, schema)
    for name, kind in (x.split() for x in EXTRA.split(", ")):
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


# Ranked search


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(text))


def plain_ranking(docs, items, k):
    counted = [(key, Counter(plain_terms(text))) for key, text in docs]
    counted = [(key, c, sum(c.values())) for key, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(plain_terms(text))
    out = {}
    for item, terms in wanted.items():
        scored = []
        for key, c, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            score = 0
            for t in terms & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out[item] = [(None if none else key, -s) for s, none, key in sorted(scored)[:k]]
    return {item: rows for item, rows in out.items() if rows}


def ranking_of(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out[r["item_id"]]) + 1
        out[r["item_id"]].append((r["doc_id"], r["score"]))
    return dict(out)


ITEMS = [(1, "fox"), (2, "the THE lazy den"), (3, None), (4, ""), (5, "nowhere"), (6, "éa 漢字"), (1, "dog"), (None, "fox")]


@pytest.mark.parametrize("shard_bytes, query_bytes", [(ranking.SHARD_BYTES, ranking.QUERY_BYTES), (60, 80)])
def test_ranking_of_odd_rows(spark, shard_bytes, query_bytes):
    docs = with_extra(spark, TEXTS, "doc_id long, text string").repartition(2)
    items = with_extra(spark, ITEMS, "item_id long, text string")
    index = stored(ranking.build_index(docs, shard_bytes=shard_bytes), "index")
    assert sum(len(r["keys"]) for r in index.select("keys").collect()) == len(TEXTS)
    got = ranking_of(ranking.search(index, items, k=4, query_bytes=query_bytes))
    assert got == plain_ranking(TEXTS, ITEMS, 4)


def test_ranking_of_many_blocks(spark):
    """Long lists, so that windows, blocks and lists that are not essential all matter."""
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [
        (i, " ".join(random.choices(vocabulary, weights, k=random.choice([3, 20, 400, 900])))) for i in range(3000)
    ]
    docs += [(10_000 + i, docs[7][1]) for i in range(200)]  # copies: ties are kept by key
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([1, 4, 30])))) for i in range(40)]
    items += [(99, "w0 w1 w2 w250"), (100, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = stored(ranking.build_index(df, shard_bytes=400_000), "index")
    assert index.count() > 6
    got = ranking_of(ranking.search(index, spark.createDataFrame(items, "item_id long, text string")))
    assert got == plain_ranking(docs, items, 10)


def test_blocks_are_rejected_before_decompression():
    """A rare word has the best documents; blocks of a common one without them stay as they are."""
    texts = [b"common filler words here"] * 6000
    for i in (10, 4000):
        texts[i] = b"rare common"
    shard = ranking.build_shard(texts)
    row = {n: np.ascontiguousarray(getattr(shard, n), t).tobytes() for n, t in ranking.SHARD_ARRAYS.items()}
    reader = ranking.Reader({**row, "terms": shard.terms, "blob": shard.blob}, 6000, 24_000)
    docs, scores = ranking.search_shard(reader, [(b"rare", 9000), (b"common", 5)], 1)
    assert docs.tolist() == [10] and scores[0] > 0
    assert len(reader.first) > 300 and len(reader.read) <= 12
    docs, more = ranking.search_shard(reader, [(b"rare", 9000), (b"common", 5)], 2)
    assert docs.tolist() == [10, 4000] and more.tolist() == [scores[0]] * 2


def test_block_codec_keeps_large_values():
    random.seed(2)
    docs = np.sort(np.array(random.sample(range(1 << 30), 200)))
    tf = np.array([random.choice([1, 300, 70_000, 1 << 33]) for _ in docs])
    starts = np.array([0, 64, 128, 192])
    widths, blob = ranking.packed_postings(docs, tf, starts)
    reader = object.__new__(ranking.Reader)
    reader.sizes, reader.widths, reader.blob, reader.read = np.array([64, 64, 64, 8]), widths, blob, {}
    each = (widths >> 4).astype(int) + (widths & 15)
    reader.offsets, reader.first = np.cumsum(reader.sizes * each) - reader.sizes * each, docs[starts]
    reader.m = defaultdict(lambda: 10)
    for b, start in enumerate(starts):
        n, at = reader.sizes[b], reader.offsets[b]
        wide, narrow = int(widths[b]) >> 4, int(widths[b]) & 15
        gaps = np.frombuffer(blob, f"<u{wide}", n, at).astype(np.int64)
        assert (np.cumsum(gaps) + docs[start] == docs[start : start + n]).all()
        assert (np.frombuffer(blob, f"<u{narrow}", n, at + n * wide).astype(np.int64) + 1 == tf[start : start + n]).all()


def test_long_texts_are_split_in_slices(monkeypatch):
    monkeypatch.setattr(ranking, "SLICE_BYTES", 7)
    text = "Ab cd, éé " + "x" * 40 + " yz-" + "q" * 7 + " " + "r" * 6 + "."
    got = [t for some in ranking.terms_of(text.encode()) for t in some]
    assert got == [t.encode() for t in plain_terms(text)]
    shard = ranking.build_shard([("ab " * 30).encode()])
    assert shard.df.tolist() == [1] and shard.lengths.tolist() == [30] and shard.most.tolist() == [30]


def test_ranking_of_empty_tables(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking.ranked(docs.where("doc_id = 77"), items).isEmpty()
    assert ranking.ranked(docs.where("doc_id in (1, 2, 3)"), items).isEmpty()
    empty = ranking.ranked(docs, items.where("item_id = 77"))
    assert empty.isEmpty() and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_a_stored_index_has_a_shard_in_each_row_group(spark, monkeypatch):
    """Writers and readers hold a row group: with all shards of a task in one, memory grows with the tasks."""
    docs = spark.createDataFrame([(i, f"fox w{i} den") for i in range(60)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(ranking, "build_index", functools.partial(ranking.build_index, shard_bytes=100))
    with own_tables(spark) as made:
        found = ranking_of(ranking.ranked(docs, items))
        index = next(folder for folder in made if "/index-" in folder)
        groups = [
            m.row_group(i).num_rows
            for f in pq.ParquetDataset(index.removeprefix("file:")).fragments
            for m in [f.metadata]
            for i in range(m.num_row_groups)
        ]
    assert len(groups) > 6 and set(groups) == {1}
    assert [key for key, _ in found[1]] == list(range(10)) and None in found


def test_small_batches_are_small_and_leave_the_setting(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows] * batch.num_rows})

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1000).alias("t"))
    with small_batches(spark, 3000):
        got = [r["n"] for r in map_arrow(rows, sizes, "n long").collect()]
    assert len(got) == 40 and max(got) <= 4 and spark.conf.get(name) == before
    spark.conf.set(name, "1000000")
    with pytest.raises(ZeroDivisionError), small_batches(spark):
        1 / 0
    assert spark.conf.get(name) == "1000000"
    spark.conf.unset(name)


# Spelling variants


def plain_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def variants_of(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_words_of_odd_rows(spark):
    text = "Élan élan ÉLAN naïve×naïve÷x straße straße straße apple Apples APPLES apples " * 4
    docs = TEXTS + [(20 + i, text) for i in range(40)] + [(None, "apples " * 9), (60, "z" * 300_000), (61, "z" * 300_000)]
    got = spelling.words(with_extra(spark, docs, "doc_id long, text string"))
    assert {r["word"]: r["n"] for r in got.collect()} == plain_words(docs)


def test_words_of_one_letter_many_times(spark):
    """The number of their subtree, and of those near it, passes 64 bits."""
    words = [x * n for x in "aqncsetd" for n in (5, 6, 8, 9, 10, 11, 20, 21, 60, 61)]
    words += [w + end for w in words for end in ("ns", "b")]
    counts = {w: 3 + i * i % 57 for i, w in enumerate(words)}
    got = variants_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_variants(counts)


def alphabet_words(n):
    random.seed(n)
    letters = "abcdeéÿqu"
    return {"".join(random.choices(letters, k=random.randint(5, 7))): random.randint(3, 60) for _ in range(n)}


@pytest.mark.parametrize("trie_words", [spelling.TRIE_WORDS, 7])
def test_variants_are_those_of_all_pairs(spark, trie_words):
    counts = alphabet_words(900)
    counts |= {"banana": 4, "bananas": 8, "banan": 2, "ananab": 8, "banena": 8, "x" * 90: 3, "x" * 91: 6, "x" * 92: 12}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = variants_of(spelling.variants(df, trie_words=trie_words))
    assert got == plain_variants(counts)
    assert got["x" * 90][:2] == ("x" * 91, "x" * 92) and got["banana"][0] == "bananas"  # ties: the smallest


def test_a_large_leaf_is_compared_by_halves(spark):
    """Thousands of words of one frequency vector, in one subtree."""
    random.seed(8)
    counts = {"".join(random.sample("aaqqbbrrccss", 12)): random.randint(3, 90) for _ in range(1500)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert variants_of(spelling.variants(df, trie_words=400)) == plain_variants(counts)


def test_chains_of_forms_end_at_the_root(spark):
    chain = ["a" * 5 + "b" * i for i in range(14)]
    counts = {w: 3 << i for i, w in enumerate(chain)}
    got = variants_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert {r[1] for r in got.values()} == {chain[-1]} and got == plain_variants(counts)


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    empty = spelling.variants(spelling.words(docs))
    assert empty.isEmpty() and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = variants_of(QUERIES["op12_frequency_trie"](spark, SF_DIR))
    counts = plain_words([(r["doc_id"], r["text"]) for r in docs])
    assert {w: r[2] for w, r in got.items()} == counts
    by_length = defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    random.seed(1)
    for w in random.sample(sorted(counts), min(300, len(counts))):
        some = [v for n in (-1, 0, 1) for v in by_length[len(w) + n] if one_edit(w, v)]
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        assert got[w][3] == len(some)
        assert got[w][0] == (best if best and counts[best] >= 2 * counts[w] else None)


# Nearest neighbours


def plain_nearest(rows, queries, k):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = {(i, tuple(v)) for i, v in rows if i is not None and good(v)}
    out = {}
    for q, v in {(q, tuple(v)) for q, v in queries if q is not None and good(v)}:
        others = [(-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows if i != q and len(w) == len(v)]
        out[q, v] = [(i, -s) for s, i in sorted(others)[:k]]
    return out


def nearest_of(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


VECTOR_SCHEMA = "vec_id long, embedding array<float>"


def test_nearest_of_odd_rows(spark):
    rows = [(i, [math.cos(i), math.sin(i), (i % 5) / 4 + 0.5]) for i in range(200)]
    rows += [(1000 + i, [5.0, 5.0, 5.0]) for i in range(60)]  # copies, more than are asked for
    rows += [(1000, [5.0, 5.0, 5.0]), (300, [9.0, 0.0, 0.0]), (301, [-9.0, 0.5, 0.0])]
    bad = [(400, None), (401, []), (402, [0.0, 0.0, 0.0]), (403, [1.0, None, 0.0]), (404, [float("nan"), 1.0, 1.0])]
    bad += [(405, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (520, [4.0])]
    df = with_extra(spark, rows + bad, VECTOR_SCHEMA)
    asked = df.where("vec_id % 20 = 0 OR vec_id > 399 OR vec_id IS NULL")
    got = nearest_of(nearest.search(stored(nearest.build_index(df, shard_rows=64), "graphs"), asked))
    wanted = [(i, v) for i, v in rows + bad if i is None or i % 20 == 0 or i > 399]
    expected = {q: r for (q, _), r in plain_nearest(rows + bad, wanted, 20).items() if r}
    assert got.keys() == expected.keys() and 520 not in got and 402 not in got
    for q, r in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in r] and np.allclose([s for _, s in got[q]], [s for _, s in r])
    assert [i for i, _ in got[1000]] == [*range(1001, 1021)]


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 32)) * rng.uniform(0.2, 3, size=(3000, 1))  # norms differ
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, VECTOR_SCHEMA).repartition(5)
    index = stored(nearest.build_index(df, shard_rows=1000), "graphs")
    assert index.count() == 3 and {len(r["ids"]) for r in index.collect()} != {3000}
    got = nearest_of(nearest.search(index, df.where("vec_id % 20 = 0")))
    expected = plain_nearest(rows, rows[::20], 20)
    hits = sum(len({i for i, _ in r} & {i for i, _ in got[q]}) for (q, _), r in expected.items())
    assert len(got) == 150 and hits > 0.97 * 20 * 150


def test_recall_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = nearest_of(QUERIES["op13_small_world_search"](spark, SF_DIR))
    expected = plain_nearest(rows, [(i, v) for i, v in rows if i is not None and i % 20 == 0], 20)
    hits = sum(len({i for i, _ in r} & {i for i, _ in got[q]}) for (q, _), r in expected.items())
    assert hits >= 0.95 * sum(map(len, expected.values()))


def test_the_graph_is_the_same_again(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)).astype(np.float32))]
    one, two = (
        nearest.build_index(spark.createDataFrame(some, VECTOR_SCHEMA).repartition(n)).collect()
        for n, some in ((2, rows), (5, rows[::-1]))
    )
    assert [r["links"] for r in one] == [r["links"] for r in two]


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (20, [0.0, 1.0])], VECTOR_SCHEMA)
    assert nearest.nearest(df.where("vec_id = 7"), df).isEmpty()
    empty = nearest.nearest(df, df.where("vec_id = 7"))
    assert empty.isEmpty() and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest_of(nearest.nearest(df, df)) == {1: [(20, 0.0)], 20: [(1, 0.0)]}
