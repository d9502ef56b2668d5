"""Results of streams as parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runledger.operators.run_summary import merged, summarised


def append_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what is there now and append the emitted rows to ``path``."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def update_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what is there now and write the changed runs of every micro-batch.

    Each batch has a folder of its own, so one that is repeated after a failure
    replaces itself. Read the result with ``read_updates``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def read_updates(spark: SparkSession, path: str, key: str = "run_id") -> DataFrame:
    """The latest row of every key written by ``update_available``."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (key, "batch_id")]
    latest = F.max_by(F.struct(*columns), "batch_id").alias("latest")
    return rows.groupBy(key).agg(latest).select(key, "latest.*")


def summaries_available(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what is there now and write a summary of each run in each micro-batch.

    No state is kept between micro-batches: ``read_summaries`` merges what they wrote, which is
    the same in any order, also if one of them is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        summarised(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """One summary per run, merged from those of all micro-batches."""
    return merged(spark.read.parquet(path))
