"""Documents kept or rejected by a decision list learned from labelled documents.

Text statistics are Spark expressions, one row at a time. The learner is sequential covering:
a rule for bad documents grows by the threshold condition of the largest information gain on
two thirds of the labelled rows, is cut back to the prefix that does best on the other third,
and joins the list if it is precise there; rows that it covers are set aside for the next
rule. Every step is one Spark aggregation of label counts by feature and bin. The list is an
ordered conditional expression, applied in the same pass that computes the statistics.

Learning reads at most ``max_labelled`` labelled documents, chosen by hash of their id;
statistics and verdicts cover all documents.

Defined cases: a null text has no words, so it fails the base rule; an id labelled twice is
bad if any label says so; a null label is none; without labels there are no rules and the base
rule decides alone. Columns of the input stay, but for ones named like an added column.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import SPACES, WORD_SPLIT, stored

#: Labelled documents that learning reads at most.
MAX_LABELLED = 20_000

WINDOW = 5  # words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DETAILS = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_marks")

_WORD = "[^\\x20\\x09-\\x0D]"


def _per(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


#: What rules may test, from the counts above.
FEATURES: dict[str, Callable[[], Column]] = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: _per("word_chars", "n_words"),
    "symbols": lambda: _per("n_symbols", "word_chars"),
    "duplicate_lines": lambda: _per("n_dup_lines", "n_lines"),
    "repeated_words": lambda: _per("n_repeat_words", "n_words"),
    "distinct_words": lambda: _per("n_distinct", "n_words"),
    "capitals": lambda: _per("n_upper", "word_chars"),
    "digits": lambda: _per("n_digits", "word_chars"),
    "marks": lambda: _per("n_marks", "word_chars"),
    "line_words": lambda: _per("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts named in ``COUNTS`` and ``DETAILS``; other columns stay.

    Each step is a projection of its own, as later ones use its arrays several times.
    """
    added = {*COUNTS, *DETAILS}
    keep = [c for c in docs.columns if c.lower() not in added]
    body, words, hashes, seen, lines = "body", "words", "hashes", "windows", "lines"
    whole = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row")
    step = docs.select(whole, F.coalesce(F.col(text), F.lit("")).alias(body))
    step = step.select(
        "row",
        body,
        F.array_remove(F.split(body, WORD_SPLIT), "").alias(words),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(_WORD)).alias(lines),
    )
    step = step.select(
        "row",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.regexp_count(body, F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        (F.length(body) - F.length(F.translate(body, "0123456789", ""))).cast("long").alias("n_digits"),
        (F.length(body) - F.length(F.translate(body, "!?|~=_", ""))).cast("long").alias("n_marks"),
        F.transform(words, lambda word: F.xxhash64(word)).alias(hashes),
    )
    counts = [c for c in (*COUNTS, *DETAILS) if c != "n_repeat_words"]
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)]),
    )
    nothing = F.array().cast("array<bigint>")
    step = step.select(
        "row", *counts, F.when(F.col("n_words") >= WINDOW, window).otherwise(nothing).alias(seen)
    )
    # Windows with their places, in order of the window; only for texts that repeat one.
    placed = F.sort_array(F.transform(seen, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    unique = F.size(F.array_distinct(seen)) == F.size(seen)
    step = step.select(
        "row", *counts, F.when(~unique, placed).alias("placed")
    )
    twice = F.filter(
        "placed",
        lambda x, k: F.coalesce(F.get(F.col("placed"), k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col("placed"), k + 1)["h"] == x["h"], F.lit(False)),
    )
    # A window adds its words but for those that the one before it has covered.
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    repeated = F.when(F.col("placed").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words")
    # As rows of a generator, so that a filter on the counts does not copy their expressions into
    # itself, where lambdas would evaluate the arrays anew for each of their items.
    return step.select("row", F.inline(F.array(F.struct(*counts, repeated)))).select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *COUNTS, *DETAILS
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def labelled_sample(labels: DataFrame, label: str, max_labelled: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``max_labelled`` rows (id, bad), the same ones every time."""
    rows = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return (
        rows.groupBy(F.col(doc_id).alias("labelled_id"))
        .agg((F.min(label) == 0).alias("bad"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(max_labelled)
    )


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
    max_rules: int = 12,
    max_conditions: int = 4,
    bins: int = 24,
    precision: float = 0.95,
    least: int = 3,
) -> list[Rule]:
    """An ordered list of conjunctions that tell bad documents (label 0).

    A rule joins the list if it covers ``least`` bad documents at least in either part of the
    labelled rows, and ``precision`` of what it covers in each is bad.
    """
    sample = labelled_sample(labels, label, max_labelled, doc_id)
    # The limit bounds what is broadcast: an id and a flag per row.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("labelled_id")
    )
    # What the base rule rejects needs no other rule.
    values = stored(
        with_statistics(rows).filter(~base_failed()).select(
            "bad",
            (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) < 2).alias("grow"),
            *[f().alias(name) for name, f in FEATURES.items()],
        ),
        "labelled",
    )
    marks = [(k + 1) / bins for k in range(bins - 1)]
    edges = values.groupBy("bad").agg(
        *[F.percentile_approx(F.col(n), marks, 1000).alias(n) for n in FEATURES]
    ).collect()  # two rows
    cuts = {n: sorted({v for row in edges for v in row[n] or ()}) for n in FEATURES}
    if len(edges) < 2:
        return []

    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[name]]), lambda cut: cut <= F.col(name)))

    table = stored(values.select("bad", "grow", *[bin_of(n).alias(n) for n in FEATURES]).coalesce(4), "bins")
    one = F.lit(1)
    bad, good = F.sum(F.when(F.col("bad"), one).otherwise(0)), F.sum(F.when(F.col("bad"), 0).otherwise(one))

    def holds(test: tuple[str, bool, int]) -> Column:
        name, at_least, k = test
        return F.col(name) > k if at_least else F.col(name) <= k

    def holds_all(tests: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for test in tests:
            out = out & holds(test)
        return out

    rules: list[list[tuple[str, bool, int]]] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        tests: list[tuple[str, bool, int]] = []
        while len(tests) < max_conditions:
            counts = (
                table.filter(F.col("grow") & left & holds_all(tests))
                .select("bad", F.explode(F.create_map(*[x for n in FEATURES for x in (F.lit(n), F.col(n))])))
                .groupBy("key", "value")
                .agg(bad.alias("bad"), good.alias("good"))
                .collect()  # a row per feature and bin
            )
            best = _best_test(counts, cuts)
            if best is None:
                break
            test, gain, n_good = best
            if gain <= 0 or test in tests:
                break
            tests.append(test)
            if n_good == 0:
                break
        if not tests:
            break
        prefixes = [holds_all(tests[: k + 1]) for k in range(len(tests))]
        sums = table.filter(left).agg(
            *[
                F.sum(F.when(p & (F.col("bad") == b) & (F.col("grow") == g), 1).otherwise(0)).alias(f"{k}{b}{g}")
                for k, p in enumerate(prefixes)
                for b in (True, False)
                for g in (True, False)
            ]
        ).first()

        def worth(k: int, sums=sums) -> float:
            p, n = (sums[f"{k}{b}False"] or 0 for b in (True, False))
            return (p - n) / (p + n) if p + n else -1.0

        k = max(range(len(tests)), key=worth)
        fine = all(
            (sums[f"{k}True{g}"] or 0) >= max(least, precision * ((sums[f"{k}True{g}"] or 0) + (sums[f"{k}False{g}"] or 0)))
            for g in (True, False)
        )
        if not fine:
            break
        rules.append(tests[: k + 1])
        left = left & ~holds_all(tests[: k + 1])
    return [tuple(Condition(n, at_least, cuts[n][k]) for n, at_least, k in tests) for tests in rules]


def _best_test(counts: list, cuts: dict[str, list[float]]) -> tuple[tuple[str, bool, int], float, int] | None:
    """The condition of the largest gain, of counts (key, value, bad, good) by feature and bin."""
    found = None
    for name in FEATURES:
        own = {r["value"]: (r["bad"], r["good"]) for r in counts if r["key"] == name}
        all_bad, all_good = (sum(v[i] for v in own.values()) for i in (0, 1))
        if not all_bad:
            return None
        low_bad = low_good = 0
        base = math.log2(all_bad / (all_bad + all_good))
        for k in range(len(cuts[name])):
            low_bad += own.get(k, (0, 0))[0]
            low_good += own.get(k, (0, 0))[1]
            for at_least, p, n in ((True, all_bad - low_bad, all_good - low_good), (False, low_bad, low_good)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - base)
                    if found is None or gain > found[1] + 1e-12:
                        found = ((name, at_least, k), gain, n)
    return found


def matched_rule(rules: list[Rule]) -> Column:
    """The first rule, counted from 1, whose conditions all hold; null if there is none."""
    out = None
    for k, rule in enumerate(rules, 1):
        every = F.lit(True)
        for condition in rule:
            every = every & condition.column()
        out = F.when(every, k) if out is None else out.when(every, k)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with statistics, base_failed, rule (the one that rejects it) and kept."""
    names = ("base_failed", "rule", "kept")
    stats = with_statistics(docs.select([c for c in docs.columns if c.lower() not in names]), text)
    return (
        stats.withColumn("base_failed", base_failed())
        .withColumn("rule", matched_rule(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the same columns."""
    rules = learn_rules(docs, labels)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    held = docs.select(row.alias("whole"), F.col("text").alias("body_of_it"))
    judged = judge(held, rules, "body_of_it").filter("kept")
    return judged.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])
