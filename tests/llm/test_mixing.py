import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.llm.mixing import _nearest, balanced_duals, mix, mixed_documents
from runledger.llm.registered import LLM_QUERIES

WEIGHTS = (5.0, 2.0, 1.0)


def brute_targets(sizes, limit=3):
    """Share by weight, stop at the limit, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(limit * sizes[s] for s in stopped)
        free = sum(weight[s] for s in names if s not in stopped)
        target = {s: limit * sizes[s] if s in stopped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in stopped and target[s] > limit * sizes[s]}
        if not over:
            return target
        stopped |= over


def check(rows, near=0.02):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    targets = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9)
    for s, t in targets.items():
        shortest = min((r.size for r in rows if r.source == s and r.size), default=0)
        assert abs(taken[s] - t) <= max(near * t, shortest), s


def test_whole_table(spark, sf):
    for folder in (sf,):
        got = LLM_QUERIES["op6_entropy_balancing"].run(spark, folder)
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        words = {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
        rows = got.join(docs.select("doc_id", "source"), "doc_id").collect()
        assert {r.doc_id: r.size for r in rows} == words
        check(rows)
        again = LLM_QUERIES["op6_entropy_balancing"].run(spark, folder)
        assert sorted(got.collect()) == sorted(again.collect())


def test_edges(spark, frame):
    rows = [(i, "w " * (1 + i % 7), ("a", "b", None, "c")[i % 4 if i % 3 else 0], i) for i in range(900)]
    rows += [(1, None, "a", 0), (2, "", None, 0), (None, "x y", None, 0), (5, " ", "empty", 0)] + [(7, "same row", "b", 1)] * 30
    docs = frame(rows, "doc_id long, text string, source string, Size long")
    got = mix(docs)
    assert [c for c in got.columns if c.lower() == "size"] == ["size"]
    assert got.count() == len(rows)
    check(got.collect())
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.filter("size is not null").count() == got.agg(F.sum("copies")).first()[0]
    assert mix(docs.limit(0)).count() == 0
    assert mixed_documents(docs.limit(0)).count() == 0


def solved(sizes, target, limit=3.0):
    """Rates of a source's documents: the dual by halving, in plain numbers."""
    if target >= limit * sizes.sum():
        return np.where(sizes > 0, limit, 1.0)
    low, high = -50.0, math.log(limit)
    for _ in range(200):
        dual = (low + high) / 2
        taken = (sizes * np.minimum(np.exp(dual * sizes), limit)).sum()
        low, high = (dual, high) if taken < target else (low, dual)
    return np.minimum(np.exp(low * sizes), limit)


def test_a_source_over_many_blocks(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.expr("if(id % 3 = 0, 'hot', concat('s', id % 5))").alias("source"),
        (F.lit(1) + F.expr("id * 7919 % 501")).alias("n"),
    )
    rows = mix(docs, size=F.col("n")).collect()
    check(rows, near=0.0005)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        sizes = np.array([r.size for r in own])
        rates = solved(sizes, own[0].target)
        copies = np.array([r.copies for r in own])
        # A block may take one copy more or less of a few documents, to end nearer.
        assert (np.abs(copies - rates) >= 1 + 1e-6).mean() < 0.005 and np.abs(copies - rates).max() < 2
        # Documents are tilted by size: the copies of each range of sizes follow its rates.
        for part in np.array_split(np.argsort(sizes, kind="stable"), 10):
            assert copies[part].sum() == pytest.approx(rates[part].sum(), abs=0.03 * len(part) + 3)


@pytest.mark.parametrize("seed", range(5))
def test_duals(spark, seed):
    """Sources that shrink, grow, stop at the limit or have nothing, against a plain solver."""
    rng = np.random.default_rng(seed)
    sizes = {s: np.maximum(0, rng.lognormal(3, 2, 40).astype(int)) for s in "abcde"} | {"none": np.zeros(3, int)}
    goal = {"a": 0.01, "b": 0.5, "c": 1.0, "d": 2.5, "e": 3.0, "none": 0.0}
    classes = spark.createDataFrame([(s, int(n), 1) for s, own in sizes.items() for n in own], "source string, size long, n long")
    targets = spark.createDataFrame([(s, int(own.sum()), float(goal[s] * own.sum())) for s, own in sizes.items()], "source string, source_size long, target double")
    for row in balanced_duals(classes, targets, 3).collect():
        own = sizes[row.source]
        rates = np.minimum(np.exp(row.dual * own), 3)
        assert rates == pytest.approx(solved(own, row.target), rel=1e-5)
        assert (rates * own).sum() == pytest.approx(row.target, rel=1e-8)


@pytest.mark.parametrize("seed", range(20))
def test_nearest(seed):
    rng = np.random.default_rng(seed)
    steps = rng.integers(1, 60, 12) * rng.choice([-1, 1], 12)
    due = float(rng.normal(0, 40))
    sums = [0, *steps, *[a + b for i, a in enumerate(steps) for b in steps[:i]]]
    assert abs(due - (steps * _nearest(steps, due)).sum()) == pytest.approx(min(abs(due - s) for s in sums))
