"""Every operator on odd rows, against plain code."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leaguescore.llm import (
    bitplanes,
    chat,
    lattice,
    mixing,
    ordinal,
    packing,
    registry,
    separators,
    simhash,
    sketch,
    supervision,
)
from leaguescore.llm.runtime import new_folder, range_of, range_starts, stored
from leaguescore.llm.tokens import Encoder, public_vocabulary

#: Columns beside the usual ones have the names that operators add.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, "
    "size int, kept int, `range` int, sequence_id string, score double, row int"
)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 6000
TEXTS = [
    (0, "the quick brown fox jumps over the lazy dog"),
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "x"),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog"),
    (7, "a\x1cb\xa0c é <|endoftext|> ### </turn> ünï 漢字 🙂"),
    (7, "same key, another text"),
    (8, "twice alike"),
    (8, "twice alike"),
    (None, "no key"),
    (None, None),
    (9, "line one\nline one\n\nline one\nlast"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (k, t, None, [None, "s", "t"][n % 3], 1, "f", 1, 1, 1, "q", 1.0, 1)
        for n, (k, t) in enumerate(TEXTS)
    ]
    return stored(spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id"), "odd")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < -5")


def bag(rows):
    return Counter(map(tuple, rows))


def signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return (value - (1 << 64) if value >> 63 else value) >> 12


def ids_of(name):
    tokenizer = Tokenizer.from_file(public_vocabulary(name))
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_rows_alike_are_packed_in_several_groups(spark):
    alike = spark.range(0, 4000, 1, 8).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit(100).cast("long").alias("length")
    )
    rows = packing.pack(alike, packing.Capacity(), n_rows=4000, group_rows=100).collect()
    assert len(rows) == 4000
    groups = Counter(r["sequence_id"] >> 32 for r in rows)
    assert len(groups) > 1 and max(groups.values()) < 4000
    places = Counter((r["sequence_id"], r["offset"]) for r in rows)
    assert set(places.values()) == {1} and {o for _, o in places} == set(range(0, 1000, 100))


@pytest.mark.parametrize("name", [registry.BYTE_BPE, registry.WORD_BPE])
def test_encoder_gives_the_tokenizers_ids(name):
    random.seed(3)
    bits = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "’", "é", "ß", "1", "²", "\xa0", "\x85"]
    bits += ["\x1c", "!", "###", "<|endoftext|>", "I'LL", "İ", "Σ", "中", "🙂", "ª", " the", "½"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 14))) for _ in range(4000)]
    own, plain = Encoder(public_vocabulary(name)), ids_of(name)
    for text, data in zip(texts, own.encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == plain(text), text


def test_ranges_hold_every_key_once(spark):
    df = spark.createDataFrame([(k,) for k in [5, 5, 5, 1, 9, None, 7, 3]], "k long")
    starts = range_starts(df, "k", 4)
    assert starts[0] == 1 and starts == sorted(set(starts))
    for row in df.select("k", range_of(F.col("k"), starts).alias("r")).collect():
        want = len(starts) - 1 if row["k"] is None else sum(s <= row["k"] for s in starts[1:])
        assert row["r"] == want


def test_pack(odd, none):
    plain = ids_of(registry.BYTE_BPE)
    pieces = stored(packing.cut_pieces(odd, public_vocabulary(registry.BYTE_BPE)), "pieces")
    texts = {}
    for row in pieces.collect():
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["length"] <= 1024 and (row["piece"] == 0 or len(ids) == 1024)
        texts.setdefault((row["doc_id"], row["piece"]), []).append(ids)
    whole = [x for p in range(200) for x in (texts.get((5, p)) or [[]])[0]]
    assert whole == [*plain(LONG), 2] and texts[(1, 0)] == [[2]] and len(texts[(8, 0)]) == 2
    packed = packing.pack(pieces, packing.Capacity(), n_rows=3).toPandas()
    assert len(packed) == pieces.count()
    for _, seq in packed.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist()
        assert seq.length.sum() <= 1024
    assert packing.pack(
        packing.cut_pieces(none, public_vocabulary(registry.BYTE_BPE)), packing.Capacity(), 0
    ).isEmpty()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 600)
    capacity = packing.Capacity(100, 3, 6000 + 4000, (1.0, 0.5, 0.5), rule)
    sequence, offset = packing.best_fit(lengths, capacity)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 3 and (own**2).sum() <= 10_000
        assert sorted(offset[sequence == s])[0] == 0
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), capacity)
    tight = packing.best_fit(lengths, packing.Capacity(100, 100, 10_000))[0]
    assert len(np.unique(tight)) <= 1.04 * lengths.sum() / 100


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("width", [2, 4, 8])
def test_planes_round_trip(bits, width):
    values = np.random.default_rng(0).integers(0, 2 ** (8 * width - 1), 1000).astype(np.uint64)
    for n in (0, 1, 7, 8, 1000):
        planes = bitplanes.to_planes(values[:n], width, bits)
        assert len(planes) == width * (8 if bits else 1)
        assert (bitplanes.from_planes(planes, n, width, bits) == values[:n]).all()


def test_plane_files_and_slices(spark, odd, none):
    plain, vocabulary = ids_of(registry.WORD_BPE), public_vocabulary(registry.WORD_BPE)
    back = bitplanes.round_trip(odd, vocabulary, bits=True).toPandas().sort_values("start")
    assert (back.start == back.n_tokens.cumsum() - back.n_tokens).all()
    got = bag((None if k != k else int(k), bytes(d)) for k, d in zip(back.doc_id, back.ids))
    assert got == bag((k, np.array([*plain(t), 2], "<u4").tobytes()) for k, t in TEXTS)
    assert bitplanes.round_trip(none, vocabulary).isEmpty()
    manifest = bitplanes.write_files(odd, new_folder(spark, "planes"), vocabulary)
    with bitplanes.opened(manifest[-1]["path"]) as source:
        reader = bitplanes.Reader(source)
        whole = np.concatenate(list(reader.chunks("ids")))
        assert (reader.values("ids", 3, 9) == whole[3:12]).all()


@pytest.mark.parametrize("block", [2, 10, 1 << 20])
def test_separator_scan_stitches_blocks(spark, tmp_path, block):
    ids = {"a": [5, 9, 9, 1, 2, 3, 9, 4], "b": [9], "c": [1, 1, 1, 1, 1, 9], "d": []}
    files = []
    for name, values in ids.items():
        (tmp_path / name).write_bytes(np.array(values, "<u2").tobytes())
        files.append((name, f"file://{tmp_path}/{name}"))
    rows = separators.stitch(separators.scan_blocks(spark, files, 2, 9, block)).collect()
    got = sorted((r["file"], r["ordinal"], r["start"], r["n_tokens"]) for r in rows)
    assert got == [
        ("a", 0, 0, 1), ("a", 1, 2, 0), ("a", 2, 3, 3), ("a", 3, 7, 1), ("b", 0, 0, 0), ("c", 0, 0, 5),
    ]


def test_separator_counts(spark, odd, none):
    plain, vocabulary = ids_of(registry.BYTE_BPE), public_vocabulary(registry.BYTE_BPE)
    for docs, texts in ((odd, TEXTS), (none, [])):
        folder = new_folder(spark, "flat")
        placed = stored(separators.write_flat(docs, folder, vocabulary, 50256), "placed")
        rows = separators.count_tokens(docs, vocabulary, 50256, folder, placed).collect()
        assert bag((r["doc_id"], r["n_tokens"]) for r in rows) == bag(
            (k, len(plain(t))) for k, t in texts
        )


def test_lattice_sums_all_segmentations():
    pieces, logs = lattice.vocabulary_pieces(public_vocabulary(registry.PIECES))
    vocabulary, number = lattice.Vocabulary(pieces), {p: k for k, p in enumerate(pieces)}

    def brute(word):
        word = b" " + word
        sums = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if (k := number.get(word[start:end])) is not None:
                    sums[end] += sums[start] * np.exp(logs[k])
        return np.log(sums[-1])

    words = [b"the", b"quickly", "é漢".encode(), b"\xff\x00", b"a" * 60]
    found = lattice.word_logs(vocabulary, logs, words)
    assert np.allclose(found, [brute(w) for w in words])
    letters = np.frombuffer(b" quickly", np.uint8).reshape(1, -1)
    uses = lattice.expected(vocabulary, logs, letters)
    assert np.isclose(sum(u * len(p) for u, p in zip(uses, pieces)), 8)


def test_lattice_scores(odd, none):
    rows = lattice.score(odd, public_vocabulary(registry.PIECES), rounds=1).collect()
    assert len(rows) == len(TEXTS)
    tokens = lambda t: [w.lower() for w in WORDS.findall(t or "")] + [""]
    held = lambda k: zlib.crc32(str(k if k is not None else "").encode()) % 7 == 2
    counts = Counter(w for k, t in TEXTS if not held(k) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = bag(
        (k, held(k), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
         round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for k, t in TEXTS
    )
    got = bag((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows)
    assert got == want and all(r["score"] < 0 for r in rows)
    assert lattice.score(none, public_vocabulary(registry.PIECES)).isEmpty()


def test_turns_are_reversible():
    random.seed(0)
    render = chat.compile_template(chat.TURNS)
    bits = ["\\", "#", "###", "<", "</turn>", "\n", ": ", ":", "a", "### assistant: "]
    for _ in range(3000):
        turns = [
            {
                "role": random.choice(["user", "assistant", "".join(random.choices(bits, k=2))]),
                "text": "".join(random.choices(bits, k=random.randint(0, 8))),
            }
            for _ in range(random.randint(0, 4))
        ]
        text, spans = render({"messages": turns})
        assert chat.read_turns(text) == [(m["role"], m["text"]) for m in turns]
        learnt = [chat.unescape(text[s:e]) for s, e in spans]
        assert learnt == [m["text"] for m in turns if m["role"] == "assistant"]


def test_template_language():
    source = (
        "{% set n = 1 + 2 %}{% for m in ms %}{% if loop.first and not m.x %}[{{ m.t | upper }}]"
        "{% elif m.t == 'b' %}b{% else %}{{ n }}{% endif %}{% if loop.last %}.{% endif %}{% endfor %}"
    )
    text, _ = chat.compile_template(source)({"ms": [{"t": "a"}, {"t": "b"}, {"t": "c"}]})
    assert text == "[A]b3."
    assert chat.parse("a{% if 1 == 1 %}b{{ 'c' | upper }}{% endif %}d") == (
        chat.Out(chat.Const("abCd")),
    )
    for bad in ("{% if x %}", "{{ x | eval }}", "{{ x.__class__ }}", "{{ (x }}", "{% import x %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    assert chat.compile_template("{{ x.real }}")({"x": 1})[0] == ""


def test_conversations(spark, monkeypatch):
    rows = [(c, t, r, f"said {c} {t}") for c in (1, 2) for t, r in enumerate(["user", "assistant"])]
    rows += [(3, 0, None, None), (None, 1, "assistant", "x"), (4, None, "user", "a"), (4, 0, "user", "b")]
    rows += [(5, t, "assistant", "long") for t in range(600)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_conversations(table)
    assert parts.where("conv_id = 5").count() == 3
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    assert len(got) == 6
    for conv, row in got.items():
        own = sorted(
            ((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        )
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (row["n_turns"], row["loss_chars"]) == (len(own), len(loss))
    assert chat.read_back(chat.format_conversations(table.where("turn > 9000"))).isEmpty()


def brute_classes(prints, distance):
    values = sorted({f for _, f in prints})
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
                parent[top(a)] = top(b)
    least = {}
    for k, f in prints:
        if k is not None:
            least[top(f)] = min(least.get(top(f), k), k)
    return bag((k, f, least.get(top(f))) for k, f in prints)


@pytest.mark.parametrize("distance", [0, 3, 4])
def test_classes_lose_no_link(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = [(k, b) for k, b in enumerate(base)]
    for k in range(400):  # chains and dense balls around the first few
        value = rng.choice(base[:8])
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            value ^= 1 << bit
        prints.append((100 + k, value))
    prints = [(k, f - 2**64 if f >> 63 else f) for k, f in prints] + [(None, 0), (None, 5), (7, 0)]
    table = spark.createDataFrame(prints, "doc_id long, fingerprint long")
    got = bag(simhash.classes(table, distance).collect())
    assert got == brute_classes(prints, distance)
    assert simhash.classes(table.where("doc_id < -1"), distance).isEmpty()


def test_fingerprints_are_those_of_spark_hashes(spark, odd):
    found = simhash.fingerprints(odd, 4).collect()
    wanted = []
    for k, t in TEXTS:
        words = [w.lower() for w in WORDS.findall(t or "")]
        runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        rows = spark.createDataFrame([(r,) for r in runs], "s string").select(F.xxhash64("s"))
        hashes = [r[0] & (2**64 - 1) for r in rows.collect()]
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        wanted.append((k, value - 2**64 if value >> 63 else value))
    assert bag(found) == bag(wanted)


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63) for _ in range(200)]
    pairs += [(a, a ^ (1 << rng.randrange(63))) for a, _ in pairs]
    df = spark.createDataFrame(pairs, "a long, b long").select(
        simhash.manhattan(
            simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b"))
        ).alias("low"),
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("exact"),
        "a",
        "b",
    )
    for row in df.collect():
        counts = [
            sum(abs(bin((x >> 2 * k) & 3).count("1") - bin((y >> 2 * k) & 3).count("1")) for k in range(32))
            for x, y in [(row["a"] & (2**64 - 1), row["b"] & (2**64 - 1))]
        ]
        assert row["low"] == counts[0] <= row["exact"]


def test_apportionment():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = rng.integers(1, 8)
        weights, most = rng.integers(0, 6, n).astype(float), rng.integers(0, 20, n)
        seats, want = int(rng.integers(0, 60)), np.zeros(n, int)
        for _ in range(int(min(seats, most[weights > 0].sum()))):
            open_ = (want < most) & (weights > 0)
            want[np.argmax(np.where(open_, weights / (2 * want + 1), -1))] += 1
        assert (mixing.apportion(weights, seats, most) == want).all()
    assert mixing.apportion(np.array([3.0, 1.0]), 10**12).tolist() == [750 * 10**9, 250 * 10**9]


def test_mix(spark, odd, none):
    small = mixing.Mix(shard_words=40, block=4)
    rows = mixing.mix_sources(odd, small).collect()
    assert bag((r["doc_id"], r["size"]) for r in rows) == bag(
        (k, len(WORDS.findall(t or ""))) for k, t in TEXTS
    )
    again = mixing.mix_sources(odd.repartition(5), small).collect()
    assert bag((r["doc_id"], r["taken"]) for r in rows) == bag((r["doc_id"], r["taken"]) for r in again)
    by = {}
    for r in rows:
        cut = sum(s["high"] - s["low"] for s in r["cuts"])
        assert r["taken"] == r["rounds"] * r["size"] + cut <= 2 * r["size"]
        got = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        got[0] += r["taken"]
        got[1] += r["size"]
    for taken, size, target, source_size in by.values():
        assert size == source_size and target <= 2 * size and abs(taken - target) <= 8
    assert mixing.mix_sources(none).isEmpty()
    assert mixing.targets(np.array([10, 1000, 1000]), mixing.Mix())[0] == 20
    text = spark.range(1).select(
        mixing.take_text(
            F.lit(" a\nb  c d "), F.struct(F.lit(1).cast("long").alias("low"), F.lit(3).cast("long").alias("high"))
        )
    )
    assert text.first()[0] == "b  c "


def features_of(text):
    words = WORDS.findall(text or "")
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, doubled = Counter(runs), set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            doubled.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(doubled),
    )


def test_rules(odd, none):
    rows = supervision.judge(odd).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert bag((r["doc_id"], *[r[c] for c in names]) for r in rows) == bag(
        (k, *features_of(t)) for k, t in TEXTS
    )
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert supervision.judge(none).isEmpty()
    plan = supervision.features(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_votes_are_weighed():
    patterns = {(1, 1, 1): 900, (1, 1, 0): 60, (-1, 1, 1): 30, (-1, -1, -1): 10}
    model = supervision.estimate(patterns, 3)
    assert model.posterior((1, 1, 1)) > 0.9 > 0.5 > model.posterior((-1, -1, -1))
    assert supervision.estimate({}, 3).posterior((0, 0, 0)) > 0


def test_ordinal_on_held_out_rows(spark, none):
    sf_dir = "/root/testdata/sf0.1"
    docs = registry.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = labels.where("doc_id % 3 > 0").union(spark.createDataFrame([(None, 1, 0), (1, None, None)], labels.schema))
    graded = ordinal.classify(docs, seen)
    rows = graded.join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    for toxic, quality, low, high in ((0, 1, 0.97, 1.0), (1, 1, 0.0, 0.15)):
        kept = [r["kept"] for r in rows if (r["toxic"], r["quality"]) == (toxic, quality)]
        assert low <= sum(kept) / len(kept) <= high
    assert all(0 <= r["expected_grade"] <= 2 for r in rows)
    assert ordinal.classify(none, labels).isEmpty()


def test_ordinal_without_labels(odd, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = ordinal.classify(odd, labels).collect()
    assert len(rows) == len(TEXTS) and all(r["kept"] for r in rows)


def test_edited_texts(odd, none):
    rows = sketch.compare_edited(odd).collect()
    order = sorted(
        ((k, t or "") for k, t in TEXTS),
        key=lambda row: (row[0] is None, row[0] or 0, signed_hash(row[1]), row[1]),
    )
    how, want = sketch.Scale(), []
    for (k, t), (_, following) in zip(order, [*order[1:], order[0]]):
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        want.append(
            (k, len(t), hashlib.sha256(changed.encode()).hexdigest(), sketch.sketch_of(t, how).digits())
        )
    assert bag(r[:4] for r in rows) == bag(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert sketch.compare_edited(none).isEmpty()


def test_sketches_merge_and_estimate():
    how = sketch.Scale(width=1, scale=4)
    a, b = (" ".join(f"w{i}" for i in r) for r in (range(3000), range(2000, 2600)))
    x, y = sketch.sketch_of(a, how), sketch.sketch_of(b, how)
    assert abs(sketch.containment(y, x) - 1) < 0.01 and abs(sketch.containment(x, y) - 0.2) < 0.05
    both = sketch.merge(x, y)
    assert (both.hashes == sketch.sketch_of(f"{a} {b}", how).hashes).all()
    again = sketch.read_sketch(x.digits(), how)
    assert (again.hashes == x.hashes).all() and again.threshold == x.threshold
    assert sketch.likeness(sketch.sketch_of("", how), x) == 0.0


def test_registered_queries_match_their_contract_columns():
    assert sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(registry.QUERIES)
    assert len(registry.QUERIES) == 13 and list(registry.ORACLES) == ["op11_block_max_search"]
