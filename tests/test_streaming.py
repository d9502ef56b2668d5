import pytest

from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from runledger.operators import run_status as ops
from runledger.operators.throttle import throttled_report
from runledger.plans.run_status_queries import RUN_STATUS_QUERIES
from runledger.sources.shared import fresh_folder
from runledger.streaming import resume
from runledger.streaming import run_status as streams
from runledger.streaming.sinks import append_available, read_updates, update_available

import folds

PARTS = 3


@pytest.fixture(scope="module")
def feed(spark):
    """A feed in three files in time order, the hot run in all of them."""
    rows = folds.random_feed(seed=7, rows=900, hot=0.3)
    for row in rows:
        if row["progress"] != row["progress"]:
            row["progress"] = None
    rows.sort(key=lambda r: (r["ts"], r["seq"]))
    folder = fresh_folder(spark, "feed")
    size = len(rows) // PARTS
    for part in range(PARTS):
        some = spark.createDataFrame(rows[part * size : (part + 1) * size], folds.FEED_SCHEMA)
        some.coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder), folder


def stream(spark, feed):
    df, folder = feed
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )


def updated(spark, rows):
    out = fresh_folder(spark, "out")
    query = update_available(rows, out, fresh_folder(spark, "progress"))
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == PARTS
    return read_updates(spark, out)


def appended(spark, rows):
    out = fresh_folder(spark, "out")
    append_available(rows, out, fresh_folder(spark, "progress")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = [sorted(map(str, df.select(columns).collect())) for df in (a, b)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize(
    "operator", [ops.current_state, ops.reconcile_state, ops.final_outcome, ops.failure_reason]
)
def test_one_row_per_run(spark, feed, operator):
    same(updated(spark, operator(stream(spark, feed))), operator(feed[0]))


def test_state_flags(spark, feed):
    same(appended(spark, ops.state_flags(stream(spark, feed))), ops.state_flags(feed[0]))


def test_first_arrived_outcome(spark, feed):
    got = appended(spark, streams.first_arrived_outcome(stream(spark, feed)))
    assert got.count() == got.select("run_id").distinct().count()
    want = {r.run_id: r.outcome for r in ops.final_outcome(feed[0]).collect()}
    assert {r.run_id for r in got.collect()} == set(want)


def test_running_progress(spark, feed):
    got = appended(spark, streams.running_progress_stream(stream(spark, feed)))
    same(got, ops.running_progress(feed[0]))


@pytest.mark.parametrize("heartbeat", [20, 100_000])
def test_throttled_report(spark, feed, heartbeat):
    got = appended(
        spark,
        streams.throttled_report_stream(
            stream(spark, feed), heartbeat_seconds=heartbeat
        ),
    )
    same(got, throttled_report(feed[0], heartbeat_seconds=heartbeat))


def test_runs_are_forgotten(spark, feed):
    """Rows an hour apart with nothing kept for longer: every batch starts anew."""
    rows = streams.running_progress_stream(
        stream(spark, feed), delay="1 second", forget_after_seconds=1
    )
    out, checkpoint = fresh_folder(spark, "out"), fresh_folder(spark, "progress")
    query = append_available(rows, out, checkpoint)
    query.awaitTermination()
    removed = [
        op["numRowsRemoved"] for p in query.recentProgress for op in p["stateOperators"]
    ]
    assert sum(removed) > 0
    assert spark.read.parquet(out).where(F.col("progress") < 0).count() == 0


def test_running_progress_resumed(spark, feed, slice_rows=40):
    out = fresh_folder(spark, "out")
    resume.running_progress_available(
        stream(spark, feed), out, fresh_folder(spark, "progress"), slice_rows
    ).awaitTermination()
    same(resume.read_resumed(spark, out), ops.running_progress(feed[0]))


@pytest.mark.parametrize("slice_rows, heartbeat", [(40, 20), (40, 100_000), (100_000, 20)])
def test_throttled_report_resumed(spark, feed, slice_rows, heartbeat):
    out = fresh_folder(spark, "out")
    resume.throttled_report_available(
        stream(spark, feed),
        out,
        fresh_folder(spark, "progress"),
        heartbeat_seconds=heartbeat,
        slice_rows=slice_rows,
    ).awaitTermination()
    same(
        resume.read_resumed(spark, out),
        throttled_report(feed[0], heartbeat_seconds=heartbeat),
    )


def test_resumed_runs_are_forgotten(spark, feed):
    """Nothing is kept for longer than a second: few runs are known at the end."""
    out = fresh_folder(spark, "out")
    resume.running_progress_available(
        stream(spark, feed), out, fresh_folder(spark, "progress"), forget_after_seconds=1
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/known/0").count() == 6
    kept = resume._not_forgotten(spark.read.parquet(f"{out}/known/0"), 1)
    assert 1 <= kept.count() < 6
    assert resume.read_resumed(spark, out).count() == feed[0].count()


@pytest.mark.parametrize("name", ["running_progress", "throttled_report"])
def test_registered_keyed_stream_keeps_all_rows_of_unordered_files(spark, sf, monkeypatch, name):
    """A bound on a micro-batch is made so small that each file would be one, as in a large table."""
    folder = fresh_folder(spark, "unordered")
    spark.read.parquet(f"{sf}/events.parquet").repartition(4).write.parquet(f"{folder}/events.parquet")
    option = DataStreamReader.option

    def smallest(self, key, value):
        return option(self, key, 1 if key.startswith("max") else value)

    monkeypatch.setattr(DataStreamReader, "option", smallest)
    want = RUN_STATUS_QUERIES[name].run(spark, folder).collect()
    got = RUN_STATUS_QUERIES[f"{name}_keyed_stream"].run(spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
