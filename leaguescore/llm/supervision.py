"""Quality by weak supervision: rules vote or abstain, and their votes are weighed.

Every rule says good, bad or nothing of a document. Whether a document is good is hidden; how
often each rule says good or bad of good and of bad documents is estimated by expectation-
maximisation over the counts of vote patterns (with k rules at most 3**k, whatever the
table's size). A document is kept if the posterior probability that it is good is high enough,
so one doubtful vote does not lose it as in a filter that all rules must pass.

Everything is DataFrame expressions: one scan makes the features, none of the text is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguescore.llm.runtime import BLANK_CHARS, BLANKS, stored

SYMBOLS = r"[^#*$%&|<>]+"
FEATURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_shouts",
    "n_distinct",
)


@dataclass(frozen=True)
class Rule:
    """SQL conditions on the features; where neither holds, the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words >= 100"),
    Rule(
        "word_length",
        "word_chars < 2.5 * n_words OR word_chars > 14 * n_words",
        "word_chars BETWEEN 3.5 * n_words AND 11 * n_words",
    ),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols < 0.02 * n_words"),
    Rule("lines", "n_dup_lines > 0.3 * n_lines", "n_lines > 2 AND n_dup_lines < 0.1 * n_lines"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.1 * n_words"),
    Rule("capitals", "n_upper > 0.3 * word_chars", "n_upper < 0.1 * word_chars"),
    Rule("shouts", "n_shouts > 0.1 * n_words", "n_shouts < 0.02 * n_words"),
    Rule("variety", "n_distinct < 0.1 * n_words", "n_distinct > 0.3 * n_words"),
)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for all its uses in a row."""
    return F.transform(F.array(value), use)[0]


def windows(words: Column) -> Column:
    """Hashes of all runs of three words, in order."""
    hashed = F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def repeated_words(hashes: Column) -> Column:
    """Words in three-word windows that are found twice or more, the first included.

    Only texts with a repeated window are sorted: windows by hash, the repeated ones'
    places in order, and then each adds what the next one does not cover.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(sorted_windows: Column) -> Column:
        twice = F.filter(
            sorted_windows,
            lambda x, k: (x["h"] == F.get(sorted_windows, k - 1)["h"])
            | (x["h"] == F.get(sorted_windows, k + 1)["h"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        each = F.transform(
            at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(each, F.lit(0), lambda total, n: total + n)

    none = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(none, 0).otherwise(bind(bind(placed, places), covered))


def features(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, carry..., FEATURES...)`` of every document; a null text has no words.

    Words are runs without ASCII white space. ``word_chars`` are their code points,
    ``n_symbols`` characters of ``#*$%&|<>``, ``n_dup_lines`` the lines with a word that equal
    an earlier one, ``n_repeat_words`` the words in three-word windows found twice or more.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    body = F.btrim(whole, F.lit(BLANK_CHARS))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANKS))
    lines = F.filter(
        F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(BLANK_CHARS)) != F.lit("")
    )

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
            bind(windows(w), repeated_words).alias("n_repeat_words"),
        )

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).alias("n_dup_lines"),
        )

    own = list(dict.fromkeys([key, *carry]))
    measured = docs.select(
        *own,
        bind(words, of_words).alias("w"),
        bind(lines, of_lines).alias("l"),
        F.length(F.regexp_replace(whole, BLANKS, "")).alias("word_chars"),
        F.length(F.regexp_replace(whole, SYMBOLS, "")).alias("n_symbols"),
        F.length(F.regexp_replace(whole, "[^A-Z]+", "")).alias("n_upper"),
        F.length(F.regexp_replace(whole, "[^!]+", "")).alias("n_shouts"),
    )
    flat = measured.select(*own, "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_shouts")
    return flat.select(*own, *[F.col(c).cast("long").alias(c) for c in FEATURES])


def votes(features_table: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The features with a column of votes: per rule 1 (good), -1 (bad) or 0."""
    each = [F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END") for r in rules]
    return features_table.withColumn("votes", F.array(*each))


#: Votes that each share is believed to have seen before any document: (bad, good) of a rule on good documents,
#: and on bad ones; (good, bad) documents. Where one rule alone finds a fault, votes cannot tell whether it is always
#: right or always wrong; the first prior decides that: 50 good documents without a false alarm.
FALSE_ALARMS, HITS, QUALITY = (0.02, 50.0), (0.02, 0.02), (1.0, 1.0)


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents, and of bad votes of each rule on good and on bad documents.

    A rule that abstains says nothing. ``parts`` are what counts of each rule's weight, under one where
    rules vote alike within the good or the bad documents.
    """

    prior: float
    false_alarms: list[float]
    hits: list[float]
    parts: list[float]

    def weight(self, rule: int, vote: int) -> float:
        """Log odds that a vote adds; abstaining adds nothing."""
        if not vote:
            return 0.0
        low, high = self.false_alarms[rule], self.hits[rule]
        odds = math.log(low / high) if vote < 0 else math.log((1 - low) / (1 - high))
        return self.parts[rule] * odds

    def odds(self, pattern: tuple[int, ...]) -> float:
        start = math.log(self.prior / (1 - self.prior))
        return start + sum(self.weight(rule, vote) for rule, vote in enumerate(pattern))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.odds(pattern)))))


def share(yes: float, no: float, held: tuple[float, float]) -> float:
    """The most likely share under a beta prior that has seen ``held`` already; never 0 or 1."""
    return (yes + held[0]) / (yes + no + sum(held))


def log_likelihood(patterns: dict[tuple[int, ...], int], model: Accuracies) -> float:
    """Of the votes, each rule's to the power of its part, with the priors' terms: each round of ``estimate`` raises it."""
    total = 0.0
    for pattern, n in patterns.items():
        good, bad = math.log(model.prior), math.log(1 - model.prior)
        for vote, low, high, part in zip(pattern, model.false_alarms, model.hits, model.parts):
            if vote:
                good += part * math.log(low if vote < 0 else 1 - low)
                bad += part * math.log(high if vote < 0 else 1 - high)
        top = max(good, bad)
        total += n * (top + math.log(math.exp(good - top) + math.exp(bad - top)))
    shares = [(1.0, model.prior, QUALITY)]
    shares += [(part, x, FALSE_ALARMS) for part, x in zip(model.parts, model.false_alarms)]
    shares += [(part, x, HITS) for part, x in zip(model.parts, model.hits)]
    return total + sum(p * (yes * math.log(x) + no * math.log(1 - x)) for p, x, (yes, no) in shares)


def tallies(
    patterns: dict[tuple[int, ...], int], weights: dict[tuple[int, ...], float], rule: int
) -> tuple[float, float]:
    """Bad and good votes of a rule, each pattern's documents counted by their weight."""
    bad = sum(n * weights[p] for p, n in patterns.items() if p[rule] < 0)
    return bad, sum(n * weights[p] for p, n in patterns.items() if p[rule] > 0)


def estimate(
    patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 200, tolerance: float = 1e-9
) -> Accuracies:
    """Expectation-maximisation from vote patterns and their counts, at most ``3 ** n_rules``.

    It starts from: a document with a bad vote is bad. How often each rule is wrong on good documents, and right on
    bad ones, is learnt from there, so a rule whose bad votes the others do not bear out loses its weight. The priors
    only say which of the two hidden classes is the bad one. Rules that all but copy one another count as one
    throughout; rules that still vote alike within a class then lose weight for it.
    """
    parts = shared_parts(patterns, n_rules)
    good = {p: 0.02 if -1 in p else 0.98 for p in patterns}
    model = maximise(patterns, good, parts)
    before = -math.inf
    for _ in range(rounds):
        good = {p: model.posterior(p) for p in patterns}
        model = maximise(patterns, good, parts)
        reached = log_likelihood(patterns, model)
        if reached - before <= tolerance * abs(reached):
            break
        before = reached
    alike = dependence(patterns, good, parts)
    return replace(model, parts=[a / b for a, b in zip(parts, alike)])


def maximise(
    patterns: dict[tuple[int, ...], int], good: dict[tuple[int, ...], float], parts: list[float]
) -> Accuracies:
    """The shares that are most likely if each pattern's documents are good with the given probability."""
    bad = {p: 1 - g for p, g in good.items()}
    n_good = sum(n * good[p] for p, n in patterns.items())
    n_bad = sum(n * bad[p] for p, n in patterns.items())
    rules = range(len(parts))
    return Accuracies(
        share(n_good, n_bad, QUALITY),
        [share(*tallies(patterns, good, rule), FALSE_ALARMS) for rule in rules],
        [share(*tallies(patterns, bad, rule), HITS) for rule in rules],
        parts,
    )


#: Rules whose bad votes correlate as much as this over all documents are one rule.
COPIES = 0.9


def shared_parts(patterns: dict[tuple[int, ...], int], n_rules: int) -> list[float]:
    """One over the number of rules that all but copy each rule, itself included."""
    every = dict.fromkeys(patterns, 1.0)
    return [
        1 / sum(a == b or correlation(patterns, every, a, b) >= COPIES for b in range(n_rules))
        for a in range(n_rules)
    ]


def dependence(
    patterns: dict[tuple[int, ...], int], good: dict[tuple[int, ...], float], parts: list[float]
) -> list[float]:
    """One and the sum of each rule's correlations with the others, within the good or the bad documents.

    Rules that see the same fault vote alike there; taken as independent, each of them would count anew. The larger
    of the two correlations counts, as far as it is above zero; copies are dealt with already, and count as one here.
    """
    every, bad = dict.fromkeys(patterns, 1.0), {p: 1 - g for p, g in good.items()}
    sums = []
    for a in range(len(parts)):
        others = [b for b in range(len(parts)) if b != a and correlation(patterns, every, a, b) < COPIES]
        within = [parts[b] * max(0.0, *(correlation(patterns, w, a, b) for w in (good, bad))) for b in others]
        sums.append(1 + sum(within))
    return sums


def correlation(
    patterns: dict[tuple[int, ...], int], weights: dict[tuple[int, ...], float], a: int, b: int
) -> float:
    """Of two rules' bad votes where both vote, shrunken where such documents are few."""
    seen = [(p[a] < 0, p[b] < 0, n * weights[p]) for p, n in patterns.items() if p[a] and p[b]]
    n = sum(w for _, _, w in seen)
    if n <= 0:
        return 0.0
    x, y = sum(w for i, _, w in seen if i) / n, sum(w for _, j, w in seen if j) / n
    both = sum(w for i, j, w in seen if i and j) / n
    spread = x * (1 - x) * y * (1 - y)
    if spread <= 0:
        return 0.0
    few = min(x, 1 - x, y, 1 - y) * n  # documents that the rarer vote is about
    return (both - x * y) / math.sqrt(spread) * few / (few + 5)


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    keep_at: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, carry..., FEATURES..., votes, posterior, base_failed, kept)`` of every document.

    ``base_failed``: under 50 words, or over half of them in repeated windows. Such documents
    are not kept, whatever the votes; as they are decided without them, the accuracies are
    estimated from the others. An empty table gives an empty result. Rows alike are judged
    alike; a null key stays null. Columns to carry must not have the names of the result's.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = votes(features(docs, key, text, carry), rules).withColumn("base_failed", failed)
    table = stored(judged, "votes")
    counted = table.where(~F.col("base_failed")).groupBy("votes").count()
    patterns = {tuple(r["votes"]): r["count"] for r in counted.collect()}  # 3 ** rules at most
    model = estimate(patterns, len(rules))
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for rule in range(len(rules)):
        vote = F.col("votes")[rule]
        odds = odds + F.when(vote < 0, model.weight(rule, -1)).when(
            vote > 0, model.weight(rule, 1)
        ).otherwise(0.0)
    posterior = 1 / (1 + F.exp(-odds))
    return table.withColumn("posterior", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at)
    )
