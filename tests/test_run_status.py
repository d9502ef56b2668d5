import random

import numpy as np
import pyarrow as pa
import pytest

from runledger.functions.states import FAILED_STATES
from runledger.operators import run_status as ops
from runledger.operators.run_slices import cut_hot_runs
from runledger.operators import throttle
from runledger.operators.throttle import throttled_report

import folds


@pytest.fixture(scope="module")
def feed(spark):
    rows = folds.random_feed(seed=1, rows=2000, hot=0.4)
    return rows, spark.createDataFrame(rows, folds.FEED_SCHEMA).cache()


def test_current_state(feed):
    rows, df = feed
    got = {r.run_id: (r.state, r.seq) for r in ops.current_state(df).collect()}
    want = {k: (v[-1]["state"], v[-1]["seq"]) for k, v in folds.by_run(rows).items()}
    assert got == want


@pytest.mark.parametrize("seed", range(5))
def test_reconcile_state(spark, seed):
    rows = folds.random_feed(seed, 60, runs=15, states=("SUBMITTED", "RUNNING", "FINISHED"))
    rows.append({**rows[0], "run_id": 99, "seq": 999, "src": "app", "state": "RUNNING"})
    df = spark.createDataFrame(rows, folds.FEED_SCHEMA)
    got = {r.run_id: r.state for r in ops.reconcile_state(df).collect()}
    assert got == {k: folds.reconcile(v) for k, v in folds.by_run(rows).items()}
    assert got[99] == "UNKNOWN"


def test_final_outcome(feed):
    rows, df = feed
    got = {
        r.run_id: (r.outcome, r.first_state, r.reason, r.seq)
        for r in ops.final_outcome(df).collect()
    }
    want = {k: folds.outcome(v) for k, v in folds.by_run(rows).items()}
    assert want.pop(1) is None
    assert got == want


def test_failure_reason(feed):
    rows, df = feed
    want = {}
    for run, run_rows in folds.by_run(rows).items():
        failed = [r for r in run_rows if r["state"] in FAILED_STATES]
        want[run] = (failed[-1]["reason"], failed[-1]["seq"]) if failed else (None, None)
    got = {r.run_id: (r.reason, r.seq) for r in ops.failure_reason(df).collect()}
    assert got == want


def test_slices_are_contiguous_and_whole(feed):
    rows, df = feed
    cut = cut_hot_runs(df, slice_rows=100)
    got = {r.seq: r.run_slice for r in cut.rows.collect()}
    assert len(got) == len(rows)
    sizes = {}
    for run, run_rows in folds.by_run(rows).items():
        numbers = [got[r["seq"]] for r in run_rows]
        assert numbers == sorted(numbers)
        for number in numbers:
            sizes[run, number] = sizes.get((run, number), 0) + 1
    assert max(number for run, number in sizes if run == 0) >= 5
    assert max(sizes.values()) < 400
    assert cut.hot.where("run_slice > 0").count() < cut.hot.count()


def test_no_slices_without_a_hot_run(feed):
    cut = cut_hot_runs(feed[1], slice_rows=100_000)
    assert cut.hot is None
    assert [r.run_slice for r in cut.rows.select("run_slice").distinct().collect()] == [0]


def test_number_of_slices_is_bounded(feed):
    cut = cut_hot_runs(feed[1], slice_rows=20, max_slices=10)
    assert cut.rows.select("run_id", "run_slice").distinct().count() <= 20


@pytest.mark.parametrize("slice_rows", [64, 300, 100_000])
def test_running_progress(feed, slice_rows):
    rows, df = feed
    got = {r.seq: r.progress for r in ops.running_progress(df, slice_rows).collect()}
    want = {}
    for run_rows in folds.by_run(rows).values():
        want.update(folds.progress(run_rows))
    assert got == want


SHAPES = {
    "many changes": dict(step=5),
    "few changes": dict(step=5, weights=(1, 1, 400, 1, 1, 1)),
    "dense": dict(step=1, states=("RUNNING",)),
    "sparse": dict(step=300, states=("RUNNING", None), weights=(9, 1)),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize(
    "slice_rows, heartbeat", [(40, 0), (40, 60), (150, 5000), (100_000, 60), (100_000, 5000)]
)
def test_throttled_report(spark, shape, slice_rows, heartbeat):
    rows = folds.random_feed(seed=heartbeat, rows=1500, hot=0.5, **SHAPES[shape])
    df = spark.createDataFrame(rows, folds.FEED_SCHEMA)
    kept = throttled_report(df, "state", heartbeat, slice_rows)
    got = sorted(r.seq for r in kept.collect())
    want = []
    for run_rows in folds.by_run(rows).values():
        want += folds.throttled(run_rows, heartbeat)
    assert got == sorted(want)


@pytest.mark.parametrize("fan_in, states", [(2, ("SUBMITTED", "RUNNING")), (3, ("RUNNING",))])
def test_throttled_report_by_a_deep_tree(spark, monkeypatch, fan_in, states):
    """Many slices of one run, several levels of step tables; stretches longer than a slice."""
    monkeypatch.setattr(throttle, "FAN_IN", fan_in)
    feed = folds.random_feed(fan_in, 120, runs=2, hot=0.9, states=states, weights=(1, 30)[2 - len(states) :])
    df = spark.createDataFrame([tuple(r.values()) for r in feed], folds.FEED_SCHEMA)
    for heartbeat in (30, 200):
        kept = throttled_report(df, "state", heartbeat, 5)
        want = [s for rows in folds.by_run(feed).values() for s in folds.throttled(rows, heartbeat)]
        assert sorted(r.seq for r in kept.collect()) == sorted(want)


@pytest.mark.parametrize("seed", range(30))
def test_step_tables_compose(seed):
    """A table composed of a run of slices says what they say one after the other."""
    rng = random.Random(seed)
    heartbeat, t, tables = rng.choice([5, 20, 60]), 0, []
    for number in range(6):
        rows = []
        for _ in range(rng.randint(1, 6)):
            t += rng.choice([0, 1, 2, 9, 25]) if rng.random() < 0.95 else 90
            rows.append((7, number, t, len(rows), rng.choices(["a", "b"], [30, 1])[0]))
        table = pa.table(dict(zip(("run_id", "run_slice", "ts", "seq", "report"), map(list, zip(*rows)))))
        tables.append(throttle._step_table(table.set_column(1, "run_slice", table["run_slice"].cast(pa.int32())), heartbeat))
    grouped = [table.append_column("group", pa.array([0], pa.int32())) for table in tables]
    whole = throttle._Steps(throttle._composed(pa.concat_tables(grouped), heartbeat).to_pylist()[0])
    parts = [throttle._Steps(table.to_pylist()[0]) for table in tables]
    first = parts[0].row
    for back in range(0, heartbeat + 10):
        kept_at = first["first_us"] - back
        for report in "ab":
            before = {"last_report": report, "last_us": max(kept_at, first["first_us"] - min(back, 3))}
            kept, now = np.array([kept_at]), before
            for part in parts:
                kept, now = part.left(kept, part.follows(now, heartbeat), heartbeat), part.row
            got = whole.left(np.array([kept_at]), whole.follows(before, heartbeat), heartbeat)
            assert got[0] == kept[0], (seed, back, report)


def test_throttled_report_over_small_arrow_batches(spark):
    rows = folds.random_feed(seed=3, rows=1500, hot=0.5, weights=(1, 1, 400, 1, 1, 1))
    df = spark.createDataFrame(rows, folds.FEED_SCHEMA)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        for slice_rows in (50, 100_000):
            kept = throttled_report(df, "state", 60, slice_rows)
            want = []
            for run_rows in folds.by_run(rows).values():
                want += folds.throttled(run_rows, 60)
            assert sorted(r.seq for r in kept.collect()) == sorted(want)
            assert kept.schema == df.schema
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("slice_rows", [50, 100_000])
def test_other_types(spark, slice_rows):
    """Text run ids, also null ones; unzoned time; a report that is a number."""
    rows = folds.random_feed(seed=5, rows=800, hot=0.5)
    for row in rows:
        row["run_id"] = None if row["run_id"] == 0 else f"run {row['run_id']}"
        row["level"] = None if row["state"] == "KILLED" else len(row["state"])
    schema = folds.FEED_SCHEMA.replace("run_id bigint", "run_id string").replace(
        "ts timestamp", "ts timestamp_ntz"
    )
    df = spark.createDataFrame(rows, f"{schema}, level int")
    runs = folds.by_run(rows).values()
    kept = throttled_report(df, "level", 60, slice_rows)
    assert kept.schema == df.schema
    want = [seq for run in runs for seq in folds.throttled(run, 60, "level")]
    assert sorted(r.seq for r in kept.collect()) == sorted(want)
    got = {r.seq: r.progress for r in ops.running_progress(df, slice_rows).collect()}
    assert got == {k: v for run in runs for k, v in folds.progress(run).items()}


def test_empty_feed(spark):
    df = spark.createDataFrame([], folds.FEED_SCHEMA)
    assert throttled_report(df).count() == 0
    assert ops.running_progress(df).count() == 0
    assert ops.reconcile_state(df).count() == 0
