"""Ordered operators over a stream, one micro-batch after the other.

What ``running_progress`` and ``throttled_report`` have to know of earlier rows is
one row per run: its highest progress, or its last kept report. Put in front of
the new rows of the run, it makes the batch operator go on where the last batch
ended. So a micro-batch may be large and may have a hot run, which is cut into
slices as in batch; use these forms to catch up on history, and the keyed ones of
``streaming.run_status`` for small batches or to go on with the stream.

Every micro-batch writes a folder of result rows and one of known runs, and reads
the known runs of the batch before: one that is repeated replaces its own. Rows
that come later than ones of an earlier batch are judged at their place in time,
without the reports kept after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runledger.operators.run_slices import MAX_SLICES, SLICE_ROWS
from runledger.operators.run_status import running_progress
from runledger.operators.throttle import throttled_report

FORGET_AFTER_SECONDS = 30 * 86400


def running_progress_available(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
    forget_after_seconds: int = FORGET_AFTER_SECONDS,
) -> StreamingQuery:
    """``running_progress`` of what is there now, after what was there before."""

    def operator(rows: DataFrame) -> DataFrame:
        return running_progress(rows, slice_rows, max_slices)

    def reached(rows: DataFrame) -> DataFrame:
        # Before all rows of its run, also late ones.
        first = F.lit("0001-01-01").cast(feed.schema["ts"].dataType)
        return rows.groupBy("run_id").agg(
            F.max("progress").alias("progress"),
            F.max("heard").alias("heard"),
            first.alias("ts"),
            F.lit(-1).cast("bigint").alias("seq"),
        )

    return _resume_available(feed, operator, reached, path, checkpoint, forget_after_seconds)


def throttled_report_available(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    compare: str = "state",
    heartbeat_seconds: float = 60.0,
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
    forget_after_seconds: int = FORGET_AFTER_SECONDS,
) -> StreamingQuery:
    """``throttled_report`` of what is there now, after what was there before."""

    def operator(rows: DataFrame) -> DataFrame:
        return throttled_report(rows, compare, heartbeat_seconds, slice_rows, max_slices)

    def last_kept(rows: DataFrame) -> DataFrame:
        last = F.max(F.struct("ts", "seq", compare, "heard")).alias("last")
        return rows.groupBy("run_id").agg(last).select("run_id", "last.*")

    return _resume_available(feed, operator, last_kept, path, checkpoint, forget_after_seconds)


def read_resumed(spark: SparkSession, path: str) -> DataFrame:
    """All result rows written so far."""
    return spark.read.parquet(f"{path}/rows").drop("batch_id")


def _resume_available(
    feed: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    known_of: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    forget_after_seconds: int,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = None
        if batch_id > 0:
            known = _not_forgotten(
                spark.read.parquet(f"{path}/known/{batch_id - 1}"), forget_after_seconds
            )
        rows_path = f"{path}/rows/batch_id={batch_id}"
        new = batch.withColumn("is_known", F.lit(False))
        if known is not None:
            earlier = known.drop("heard").withColumn("is_known", F.lit(True))
            new = new.unionByName(earlier, allowMissingColumns=True)
        result = operator(new).where(~F.col("is_known")).drop("is_known")
        result.write.mode("overwrite").parquet(rows_path)

        written = spark.read.schema(result.schema).parquet(rows_path)
        seen = written.withColumn("heard", F.col("ts"))
        if known is not None:
            seen = seen.unionByName(known, allowMissingColumns=True)
        known_of(seen).write.mode("overwrite").parquet(f"{path}/known/{batch_id}")

    return (
        feed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _not_forgotten(known: DataFrame, forget_after_seconds: int) -> DataFrame:
    """Known runs without those that were silent for long when the last was heard."""
    latest = known.agg(F.max("heard")).scalar()
    return known.where(F.col("heard") >= latest - F.make_interval(secs=F.lit(forget_after_seconds)))
