"""Windows cut into slices and blocks against a plain pass over each key's rows."""

import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import hot_windows as hot

SCHEMA = "key string, value bigint, id bigint"


def rows_with_a_hot_key(seed, n=600):
    """A third of the rows in one key, a third of these with one value; a null key; one row alone."""
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", "c", None, "d"]), rng.choice([5, 5, rng.randrange(40)]), i) for i in range(n)]
    rows += [("hot", 7 if i % 3 == 0 else rng.randrange(60), n + i) for i in range(n // 2)] + [("alone", 1, -1)]
    return rng.sample(rows, len(rows))


def by_key(rows):
    keys = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        keys.setdefault(row[0], []).append(row)
    return keys


@pytest.mark.parametrize("slice_rows", [4, 50, 10_000])
@pytest.mark.parametrize("seed", range(2))
def test_ranks(spark, seed, slice_rows):
    rows = rows_with_a_hot_key(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    ranked = hot.ranked(df, ["key"], ["value"], ["value", "id"], slice_rows)
    ranked = ranked.withColumn("tile", hot.tile(F.col("row_no"), F.col("n_rows"), 4))
    got = {(r.key, r.value, r.id): (r.row_no, r["rank"], r.dense_rank, r.n_rows, r.tile) for r in ranked.collect()}
    want = {}
    for own in by_key(rows).values():
        values = sorted({r[1] for r in own})
        first = {}
        tiles = [t for t in range(1, 5) for _ in range(len(own) // 4 + (t <= len(own) % 4))]
        for i, row in enumerate(own):
            first.setdefault(row[1], i + 1)
            want[row] = (i + 1, first[row[1]], values.index(row[1]) + 1, len(own), tiles[i])
    assert got == want


@pytest.mark.parametrize("slice_rows,block_rows", [(4, 3), (50, 17), (10_000, 10_000)])
def test_neighbours_and_frames(spark, slice_rows, block_rows):
    rows = rows_with_a_hot_key(9)
    df = spark.createDataFrame(rows, SCHEMA)
    numbered = hot.numbered(df, ["key"], ["value", "id"], slice_rows)
    window = hot.block_window(["key"])
    columns = {
        "before": F.lag("id", 2).over(window),
        "after": F.lead("id").over(window),
        "three": F.sum("value").over(window.rowsBetween(-2, 0)),
    }
    got = hot.over_blocks(numbered, ["key"], columns, before=2, after=1, block_rows=block_rows)
    got = hot.with_first(got, ["key"], "id", "first_id", block_rows=block_rows)
    got = {(r.key, r.value, r.id): (r.row_no, r.before, r.after, r.three, r.first_id) for r in got.collect()}
    want = {}
    for own in by_key(rows).values():
        for i, row in enumerate(own):
            want[row] = (
                i + 1,
                own[i - 2][2] if i >= 2 else None,
                own[i + 1][2] if i + 1 < len(own) else None,
                sum(r[1] for r in own[max(0, i - 2) : i + 1]),
                own[0][2],
            )
    assert got == want


def test_no_partition_holds_a_hot_key(spark):
    """Where a key is cut, no window is over the key alone."""
    df = spark.createDataFrame(rows_with_a_hot_key(1), SCHEMA)
    ranked = hot.ranked(df, ["key"], ["value"], ["value", "id"], 50)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "BroadcastHashJoin" in plan
    largest = (
        hot.cut_hot(df, ["key"], ["value", "id"], 50, 1000, "slice").rows.groupBy("key", "slice").count().agg(F.max("count"))
    )
    assert largest.first()[0] < 150


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hot.ranked(empty, ["key"], ["value"], ["value", "id"]).count() == 0
    with pytest.raises(ValueError):
        hot.ranked(empty, ["key"], ["id"], ["value", "id"])
    with pytest.raises(ValueError):
        hot.over_blocks(empty.withColumn("row_no", F.lit(1)), ["key"], {}, before=5, block_rows=4)
