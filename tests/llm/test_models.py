"""What the fitted operators learn, against plain code and planted truth."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from leaguescore.llm import lattice, ordinal, registry, sketch, supervision
from leaguescore.llm.tokens import public_vocabulary

SF_DIR = "/root/testdata/sf0.01"


# Weak supervision


def planted(n=20_000, seed=3):
    """Votes of five rules of known accuracies, and which documents are good."""
    rng = np.random.default_rng(seed)
    false_alarms, hits = np.array([0.01, 0.03, 0.05, 0.08, 0.02]), np.array([0.9, 0.8, 0.7, 0.6, 0.5])
    good = rng.random(n) < 0.85
    votes = np.where(rng.random((n, 5)) < np.where(good[:, None], false_alarms, hits), -1, 1)
    votes[rng.random((n, 5)) < [0.1, 0.3, 0.2, 0.0, 0.4]] = 0
    return votes, good, false_alarms, hits


def patterns_of(votes):
    return dict(Counter(map(tuple, votes.tolist())))


def test_planted_accuracies_are_recovered():
    votes, good, false_alarms, hits = planted()
    model = supervision.estimate(patterns_of(votes), 5)
    assert abs(model.prior - 0.85) < 0.01
    assert np.allclose(model.false_alarms, false_alarms, atol=0.01) and np.allclose(model.hits, hits, atol=0.03)
    kept = np.array([model.posterior(tuple(v)) >= 0.5 for v in votes.tolist()])
    passes_all = ~(votes == -1).any(axis=1)
    assert kept[good].mean() > 0.98 > 0.87 > passes_all[good].mean()  # one false alarm does not lose a document
    assert kept[~good].mean() < 0.1


def test_the_likelihood_never_falls():
    votes, *_ = planted(2_000)
    patterns = patterns_of(votes)
    reached = []
    for rounds in range(1, 40):
        model = supervision.estimate(patterns, 5, rounds=rounds, tolerance=-math.inf)
        untempered = supervision.replace(model, parts=supervision.shared_parts(patterns, 5))
        reached.append(supervision.log_likelihood(patterns, untempered))
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(reached, reached[1:])) and reached[-1] > reached[0]


def test_a_round_is_that_of_plain_code():
    votes, *_ = planted(400)
    patterns = patterns_of(votes)
    good = {p: 0.3 + 0.1 * (sum(p) % 5) for p in patterns}
    model = supervision.maximise(patterns, good, [1.0] * 5)
    rows = [(p, good[p]) for p, n in patterns.items() for _ in range(n)]
    prior = (sum(g for _, g in rows) + 1) / (len(rows) + 2)
    assert math.isclose(model.prior, prior)
    for rule in range(5):
        for shares, weigh, (bad, none) in (
            (model.false_alarms, lambda g: g, supervision.FALSE_ALARMS),
            (model.hits, lambda g: 1 - g, supervision.HITS),
        ):
            wrong = sum(weigh(g) for p, g in rows if p[rule] < 0) + bad
            right = sum(weigh(g) for p, g in rows if p[rule] > 0) + none
            assert math.isclose(shares[rule], wrong / (wrong + right))
    for p in patterns:
        odds = prior / (1 - prior)
        for vote, low, high in zip(p, model.false_alarms, model.hits):
            odds *= (low / high if vote < 0 else (1 - low) / (1 - high)) if vote else 1
        assert math.isclose(model.posterior(p), odds / (1 + odds), rel_tol=1e-9)


def test_copies_of_a_rule_count_once():
    votes, *_ = planted()
    one = supervision.estimate(patterns_of(votes), 5)
    three = supervision.estimate(patterns_of(np.column_stack([votes, votes[:, 0], votes[:, 0]])), 7)
    assert np.allclose(three.false_alarms[:5], one.false_alarms, atol=1e-3)
    for pattern in set(map(tuple, votes[:500].tolist())):
        again = (*pattern, pattern[0], pattern[0])
        assert abs(one.posterior(pattern) - three.posterior(again)) < 0.02


def test_a_rule_alone_is_believed_and_one_contradicted_is_not():
    alone = {(1, 1, 1): 900, (-1, 1, 1): 70, (0, 1, 1): 30}
    model = supervision.estimate(alone, 3)
    assert model.posterior((-1, 1, 1)) < 0.1 and model.posterior((1, 1, 1)) > 0.9
    doubtful = {(1, 1, 1): 8000, (-1, 1, 1): 650, (1, 1, -1): 24, (-1, 1, -1): 1}
    model = supervision.estimate(doubtful, 3)
    assert model.posterior((1, 1, -1)) > 0.9 > 0.1 > model.posterior((-1, 1, 1))


# Classifier


def negative_log_likelihood(grades, found, weights, thresholds, ridge):
    edges = [-math.inf, *thresholds, math.inf]

    def above(score, edge):
        return 1.0 if edge == -math.inf else 0.0 if edge == math.inf else 1 / (1 + math.exp(edge - score))

    total = 0.5 * ridge * sum(w * w for w in weights.values())
    for grade, features in zip(grades, found):
        score = sum(weights.get(f, 0.0) for f in features.tolist())
        total -= math.log(above(score, edges[grade]) - above(score, edges[grade + 1]))
    return total


def graded_documents(n=1500, seed=5):
    """Grades drawn from a cumulative-link model over ten features; their own buckets and thresholds."""
    rng = np.random.default_rng(seed)
    buckets = np.array([7, 19, 300, 4_000, 50_000, 60_000, 70_000, 80_000, 90_000, 100_000])
    true = dict(zip(buckets.tolist(), [2.0, -2.0, 1.5, -1.5, 1.0, -1.0, 0.0, 0.0, 2.5, -2.5]))
    found = [buckets[rng.random(10) < 0.3] for _ in range(n)]
    scores = np.array([sum(true[f] for f in x.tolist()) for x in found])
    noise = scores + rng.logistic(size=n)
    return (noise > -1.5).astype(int) + (noise > 1.0), found, true


def test_the_fit_is_a_minimum_of_the_plain_likelihood():
    grades, found, true = graded_documents()
    model = ordinal.fit(grades, found, 3, min_nats=-1.0, rounds=1500)
    weights = {int(b): float(model.weights[b]) for b in true}
    thresholds = model.thresholds.tolist()
    best = negative_log_likelihood(grades, found, weights, thresholds, 0.2)
    assert best < negative_log_likelihood(grades, found, true, [-1.5, 1.0], 0.2)
    for step in (-0.05, 0.05):
        for name in weights:
            assert best <= negative_log_likelihood(grades, found, {**weights, name: weights[name] + step}, thresholds, 0.2)
        for k in (0, 1):
            moved = [t + step * (i == k) for i, t in enumerate(thresholds)]
            assert best <= negative_log_likelihood(grades, found, weights, moved, 0.2)
    assert all(abs(weights[b] - w) < 0.5 for b, w in true.items()) and thresholds[0] < thresholds[1]


def test_probabilities_are_those_of_the_plain_model():
    model = ordinal.Model(np.zeros(ordinal.BUCKETS), np.array([-1.0, 0.5]))
    got = model.at_least(np.array([-2.0, 0.0, 3.0]))
    assert np.allclose(got, [[1 / (1 + math.exp(t - s)) for t in (-1.0, 0.5)] for s in (-2.0, 0.0, 3.0)])


def test_rare_and_common_features_are_judged_alike():
    """What a share of its own gains: a word of three documents, all of the rare grade, tells; of the common one not."""
    gained = ordinal.gained(np.array([0.0, 3.0, 97.0, 900.0]), np.array([3, 3, 100, 1000]), 0.9)
    plain = [3 * math.log(10), 3 * math.log(1 / 0.9)]
    plain += [97 * math.log(0.97 / 0.9) + 3 * math.log(0.03 / 0.1), 0.0]
    assert np.allclose(gained, plain) and gained[0] > 4 > gained[1]


# Sketches


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    return [t or "" for (t,) in rows]


def test_a_sketch_is_read_back_as_it_was(texts):
    how = sketch.Scale()
    counts = [*range(41), 400]
    for text in [" ".join(f"w{n}x{i}" for i in range(n + 4 * (n > 0))) for n in counts] + texts[:200]:
        own = sketch.sketch_of(text, how)
        again = sketch.read_sketch(own.digits(), how)
        assert again.threshold == own.threshold and (again.hashes == own.hashes).all()
        other = sketch.sketch_of(texts[3], how)
        assert sketch.containment(own, other) == sketch.containment(again, other)
        assert sketch.merge(own, other).threshold == sketch.merge(again, other).threshold


def test_documents_are_under_the_one_threshold(texts):
    how = sketch.Scale()
    own = [sketch.sketch_of(t, how) for t in texts if len(t.split()) >= 5]
    assert np.mean([s.threshold == how.threshold() for s in own]) > 0.95
    kept = sum(len(s.hashes) for s in own) / sum(len(sketch.shingle_hashes(t, 5)) for t in texts if len(t.split()) >= 5)
    assert abs(kept - 1 / how.scale) < 0.02


def plain_likeness(a, b, how):
    """By sets: what both have at or below the smaller threshold."""
    def kept(hashes):
        low = {h for h in hashes if h <= how.threshold()}
        return (low, how.threshold()) if low else ({min(hashes)}, min(hashes)) if hashes else (set(), 1 << 64)

    (x, s), (y, t) = kept(a), kept(b)
    x, y = ({h for h in z if h <= min(s, t)} for z in (x, y))
    return len(x & y) / min(len(x), len(y)) if x and y else float(not x and not y)


def test_likeness_is_that_of_plain_sets_and_near_the_exact_one(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in sketch.compare_edited(docs).collect()}
    how, errors = sketch.Scale(), []
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        hashes = [set(sketch.shingle_hashes(t, 5).tolist()) for t in (text, sketch.edited(text, following), following)]
        assert got[k]["near_edited"] == plain_likeness(hashes[0], hashes[1], how)
        assert got[k]["near_next"] == plain_likeness(hashes[0], hashes[2], how)
        if min(map(len, hashes)) >= 100:
            for near, other in ((got[k]["near_edited"], hashes[1]), (got[k]["near_next"], hashes[2])):
                errors.append(abs(near - len(hashes[0] & other) / min(len(hashes[0]), len(other))))
    assert len(errors) > 500 and np.mean(errors) < 0.04 and np.max(errors) < 0.35


# Lattice


def segmentations(word, number):
    """All ways to cut a blank and the word's bytes into pieces."""
    whole = b" " + word
    found = [[] for _ in range(len(whole) + 1)]
    found[0] = [()]
    for end in range(1, len(whole) + 1):
        for start in range(end):
            if (piece := number.get(whole[start:end])) is not None:
                found[end] += [(*before, piece) for before in found[start]]
    return found[-1]


def test_scores_are_those_of_all_segmentations(spark):
    texts = ["the cat sat", "the dog sat on it", None, "a cat\x0band THE dog", "on on on", "ünï the", "new cat", "it is"]
    texts += ["so odd a dog", "the end", "", "is it on"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_vocabulary(registry.PIECES)
    got = {r["doc_id"]: r for r in lattice.score(docs, path, rounds=2).collect()}

    pieces, logs = lattice.vocabulary_pieces(path)
    number, weights = {p: k for k, p in enumerate(pieces)}, np.exp(logs)
    held_out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))}
    words = {k: (t or "").encode().lower().split() + [b""] for k, t in enumerate(texts)}
    counts = Counter(w for k, ws in words.items() if not held_out[k] for w in ws)
    ways = {w: segmentations(w, number) for ws in words.values() for w in ws if w}
    for _ in range(2):
        uses = np.full(len(pieces), 0.5)
        for word in counts:
            if word:
                shares = [math.prod(weights[list(way)]) for way in ways[word]]
                for way, share in zip(ways[word], shares):
                    for piece in way:
                        uses[piece] += share / sum(shares)
        weights = uses / uses.sum()
    n, v = sum(counts.values()), len(counts)
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = (once + 0.5) / (once + 2 * twice + 1)

    def probability(word):
        spelt = sum(math.prod(weights[list(way)]) for way in ways[word]) if word else 0.0
        return max(counts[word] - discount, 0) / n + discount * v / n * spelt

    assert any(held_out.values()) and not all(held_out.values())
    for k, ws in words.items():
        row = got[k]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held_out[k], len(ws), n)
        assert row["n_known"] == sum(counts[w] > 0 for w in ws)
        assert math.isclose(row["score"], sum(math.log10(probability(w)) for w in ws), rel_tol=1e-9)
        assert math.isclose(row["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
