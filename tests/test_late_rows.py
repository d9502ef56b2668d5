"""Streams whose rows come in any order against the batch operators over all rows."""

import pytest
from pyspark.sql import functions as F

import folds
from runledger.streaming import late_rows

HEARTBEAT = 40


def arrive(spark, feed, tmp_path, parts):
    """The feed as one file per micro-batch: by hash, or the other way round in time."""
    ordered = sorted(feed, key=lambda r: (r["ts"], r["seq"]))
    size = -(-len(ordered) // parts)
    chunks = [ordered[i::parts] for i in range(parts)] if parts % 2 else [ordered[i * size : (i + 1) * size] for i in range(parts)][::-1]
    source = str(tmp_path / "source")
    for chunk in chunks:
        spark.createDataFrame([tuple(r.values()) for r in chunk], folds.FEED_SCHEMA).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(folds.FEED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)


@pytest.mark.parametrize("parts", [3, 4])
def test_progress(spark, tmp_path, parts):
    feed = folds.random_feed(parts, 400, runs=6, hot=0.33)
    stream, out = arrive(spark, feed, tmp_path, parts), str(tmp_path / "out")
    late_rows.running_progress_changes(stream, out, str(tmp_path / "c"), slice_rows=20).awaitTermination()
    got = {r.seq: r.progress for r in late_rows.read_changes(spark, out).collect()}
    assert got == {s: p for rows in folds.by_run(feed).values() for s, p in folds.progress(rows).items()}
    changes = spark.read.parquet(f"{out}/changes")
    corrected = changes.groupBy("seq").count().filter("count > 1").count()
    assert 0 < corrected < 400 and changes.filter("taken_back").count() == 0


@pytest.mark.parametrize("parts", [3, 4])
def test_reports(spark, tmp_path, parts):
    feed = folds.random_feed(10 + parts, 400, runs=6, hot=0.33, step=3, states=("SUBMITTED", "RUNNING"), weights=(1, 9))
    stream, out = arrive(spark, feed, tmp_path, parts), str(tmp_path / "out")
    late_rows.throttled_report_changes(stream, out, str(tmp_path / "c"), heartbeat_seconds=HEARTBEAT, slice_rows=20).awaitTermination()
    got = sorted(r.seq for r in late_rows.read_changes(spark, out).collect())
    assert got == sorted(s for rows in folds.by_run(feed).values() for s in folds.throttled(rows, HEARTBEAT))
    assert spark.read.parquet(f"{out}/changes").filter(F.col("taken_back")).count() > 0


def test_in_order_reads_no_older_rows(spark, tmp_path):
    """Files in time order change nothing that was written before."""
    feed = sorted(folds.random_feed(5, 200), key=lambda r: (r["ts"], r["seq"]))
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    for i in range(4):
        rows = [tuple(r.values()) for r in feed[50 * i : 50 * i + 50]]
        spark.createDataFrame(rows, folds.FEED_SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(folds.FEED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    late_rows.running_progress_changes(stream, out, str(tmp_path / "c")).awaitTermination()
    changes = spark.read.parquet(f"{out}/changes")
    assert changes.count() == changes.select("seq").distinct().count() == 200
    got = {r.seq: r.progress for r in late_rows.read_changes(spark, out).collect()}
    assert got == {s: p for rows in folds.by_run(feed).values() for s, p in folds.progress(rows).items()}
