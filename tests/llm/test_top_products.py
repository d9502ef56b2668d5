import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.llm import top_products as t
from runledger.llm.registered import LLM_QUERIES, TOP_ORACLE


def brute(vectors, asked, k):
    """Best others of each query: score descending, then id."""
    width = max((len(v) for v in vectors.values()), default=0)
    full = {i: list(v) + [0] * (width - len(v)) for i, v in vectors.items()}
    rows = set()
    for q in filter(asked, full):
        scores = sorted((-sum(a * b for a, b in zip(full[q], v)), i) for i, v in full.items() if i != q)
        rows |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return rows


def found(frame, vectors, asked, k):
    df = frame(list(vectors.items()), "vec_id long, vector array<long>")
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in t.top_products(df, asked, k).collect()}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = LLM_QUERIES["op12_norm_bucketed_top_k"].run(spark, path).collect()
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    assert sorted(map(tuple, rows)) == sorted(duck.execute(TOP_ORACLE).fetchall())
    assert rows


@pytest.mark.parametrize("spread", [1, 1000])
@pytest.mark.parametrize("coordinate_from", [0.0, 0.9, 2.0])
def test_many_buckets_blocks_and_groups(frame, monkeypatch, spread, coordinate_from):
    """Lengths over a wide range, look-alikes, ties; every way of pruning gives the same rows."""
    for name, value in dict(BLOCK_ROWS=16, STRIPE_BLOCKS=2, GROUP_ROWS=8, SEEDS=10, HELD=50, COORDINATE_FROM=coordinate_from).items():
        monkeypatch.setattr(t, name, value)
    rng = random.Random(spread)
    vectors = {}
    for i in range(300):
        size = rng.choice([1, 3, spread])
        vectors[i] = [size * rng.randint(-9, 9) for _ in range(6)]
        if i % 7 == 3:
            vectors[i] = vectors[i - 3]
    assert found(frame, vectors, F.col("vec_id") % 5 == 0, 4) == brute(vectors, lambda i: i % 5 == 0, 4)


def test_pruning_leaves_out():
    rng = np.random.default_rng(1)
    values = np.rint(rng.normal(size=(2000, 16)) * 100).astype(np.int64)
    block = t.Block(np.arange(2000), values)
    query = values[5] / np.linalg.norm(values[5])
    near = block.near(query, 0.95)
    cosines = values @ query / block.length
    assert set(np.flatnonzero(cosines >= 0.95)) <= set(near) and len(near) < 500


def test_large_numbers(frame):
    vectors = {0: [1 << 31, 3], 50: [1 << 30, -5], 1: [(1 << 31) + 1, 7], 2: [-(1 << 30), 2]}
    assert found(frame, vectors, F.col("vec_id") % 50 == 0, 5) == brute(vectors, lambda i: i % 50 == 0, 5)
    with pytest.raises(OverflowError):
        found(frame, {0: [1 << 40], 1: [1]}, F.col("vec_id") == 0, 5)


def test_edges(spark, frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25], 1), (50, [0.5], 1), (1, [nan, 1.0], 1), (2, [None, 1.0], 1), (3, None, 1), (4, [inf], 1),
            (None, [1.0, 1.0], 1), (5, [], 1), (6, [-0.001, 0.0], 1), (6, [-0.001, 0.0], 1), (7, [0.5, 0.25], 1)]
    df = frame(rows, "vec_id long, embedding array<float>, rank int")
    whole = df.select("vec_id", "rank", t.scaled(F.col("embedding"), 256.0).alias("vector"))
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in t.top_products(whole, F.col("vec_id") % 50 == 0).collect()}
    vectors = {0: [128, 64], 50: [128], 5: [], 6: [-1, 0], 7: [128, 64]}
    assert got == brute(vectors, lambda i: i % 50 == 0, 5)
    empty = t.top_products(whole.limit(0), F.col("vec_id") % 50 == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert t.top_products(whole.filter("vec_id = 0"), F.lit(True)).count() == 0
    assert t.top_products(whole.filter("vec_id = 7"), F.col("vec_id") % 50 == 0).count() == 0
