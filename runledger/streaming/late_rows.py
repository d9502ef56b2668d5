"""Ordered operators over a stream whose rows come in any order, exactly.

Every micro-batch writes changes, not final rows: a change sets the result of a feed row, or takes
it back. The latest change of each row is its result, which after any number of micro-batches is
what the batch operator gives for all rows so far. No row is too late and no run is forgotten.

Per run a micro-batch reaches back to the oldest of its new rows. What happened before that is one
row, the last result before it; for a run whose new rows all follow what was heard of it, that row
is kept at hand. Only for runs with late rows are older rows read:

- Running progress: a new row can only raise rows after it, and only those that have reached less.
  So the results of the run since the late row, as far as they are below the best new row, are
  joined by the new rows and the operator is run on both; what comes out higher is a correction.
  Of the results that have reached more, only the steps up are read: the first row of each value.
- Throttled reports: the feed's own rows since the late row are read again, as one that was not
  reported may be now; results that no longer stand are taken back.

Both run the batch operator, which cuts hot runs, so a micro-batch may be of any size. A folder
holds ``seen`` (feed rows, for reports only), ``known`` (a row per run) and ``changes``, each by
micro-batch: one that is repeated after a failure replaces its own and reads those before it.
Rows have a run id; those of equal ``(ts, seq)`` in one run have no order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runledger.operators.run_slices import MAX_SLICES, SLICE_ROWS
from runledger.operators.run_status import running_progress
from runledger.operators.throttle import throttled_report

PLACE = ["ts", "seq"]


def running_progress_changes(
    feed: DataFrame, path: str, checkpoint: str, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> StreamingQuery:
    """Changes to ``running_progress`` (run_id, ts, seq, progress) by what is there now."""

    def operator(rows: DataFrame) -> DataFrame:
        return running_progress(rows, slice_rows, max_slices)

    rows = feed.select("run_id", *PLACE, "progress")
    return _changes_available(rows, path, checkpoint, operator, "progress", by_results=True)


def throttled_report_changes(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    compare: str = "state",
    heartbeat_seconds: float = 60.0,
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
) -> StreamingQuery:
    """Changes to ``throttled_report`` (run_id, ts, seq, the compared column) by what is there now."""

    def operator(rows: DataFrame) -> DataFrame:
        return throttled_report(rows, compare, heartbeat_seconds, slice_rows, max_slices)

    rows = feed.select("run_id", *PLACE, compare)
    return _changes_available(rows, path, checkpoint, operator, compare, by_results=False)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The results as they stand: the latest change of each row, without those taken back."""
    return _standing(spark.read.parquet(f"{path}/changes"))


def _standing(changes: DataFrame) -> DataFrame:
    (value,) = [c for c in changes.columns if c not in ("run_id", *PLACE, "taken_back", "batch_id")]
    latest = F.max_by(F.struct(value, "taken_back"), "batch_id").alias("latest")
    rows = changes.groupBy("run_id", *PLACE).agg(latest)
    return rows.filter(~F.col("latest.taken_back")).select("run_id", *PLACE, f"latest.{value}")


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What the micro-batches before this one wrote."""
    return spark.read.parquet(path).filter(F.col("batch_id") < batch_id)


def _changes_available(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    operator: Callable[[DataFrame], DataFrame],
    value: str,
    by_results: bool,
) -> StreamingQuery:
    kinds = {f.name: f.dataType for f in feed.schema.fields}
    place, columns = F.struct(*PLACE), ["run_id", *PLACE, value]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read several times below: written down first, and for reports needed later on.
        new_path = f"{path}/seen/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(new_path)
        new = spark.read.schema(feed.schema).parquet(new_path)
        best = F.max(F.nanvl(value, F.lit(0.0))) if by_results else F.lit(None)
        since = new.groupBy("run_id").agg(F.min(place).alias("since"), F.max(place).alias("heard"), best.alias("best"))
        if batch_id == 0:
            _end(operator(new), None, since, None, batch_id)
            return
        known = spark.read.parquet(f"{path}/known/batch_id={batch_id - 1}")
        reached = since.join(known.withColumnsRenamed({"heard": "heard_before", "last": "last_before"}), "run_id", "left")
        is_late = F.coalesce(F.col("since") < F.col("heard_before"), F.lit(False))
        late, timely = reached.filter(is_late), reached.filter(~is_late)
        context = _as_rows(timely.filter("last_before is not null").select("run_id", "last_before.*"))
        stood = None
        if not late.isEmpty():
            late = late.select("run_id", "since", "best")
            older = _before(spark, f"{path}/changes", batch_id).join(late, "run_id")
            # The oldest late row bounds what is read of each file.
            oldest = F.lit(late.agg(F.min("since.ts").cast("string")).first()[0]).cast(kinds["ts"])
            entry = _standing(older.filter(place < F.col("since")).drop("since", "best")).groupBy("run_id")
            entry = entry.agg(F.max(F.struct(*PLACE, value)).alias("last")).select("run_id", "last.*")
            stood = _standing(older.filter((F.col("ts") >= oldest) & (place >= F.col("since"))).drop("since", "best"))
            steps = None
            if by_results:
                # Only rows that have reached less than the best new one can rise.
                whole = stood.join(late.select("run_id", "best"), "run_id")
                again = stood = whole.filter(F.col(value) < F.col("best")).drop("best")
                steps = whole.filter(F.col(value) >= F.col("best")).groupBy("run_id", value)
                steps = _as_rows(steps.agg(F.min(place).alias("first")).select("run_id", "first.*", value))
            else:
                seen = _before(spark, f"{path}/seen", batch_id).filter(F.col("ts") >= oldest).join(late, "run_id")
                again = seen.filter(place >= F.col("since"))
            again = _as_rows(again.select(columns)).withColumn("is_entry", F.lit(False))
            context = context.withColumn("is_entry", F.lit(True)).unionByName(_as_rows(entry).withColumn("is_entry", F.lit(True)))
            context = context.unionByName(again)
            if steps is not None:
                context = context.unionByName(steps.withColumn("is_entry", F.lit(True)))
        else:
            context = context.withColumn("is_entry", F.lit(True))
        rows = context.unionByName(new.select(columns).withColumn("is_entry", F.lit(False)))
        _end(operator(rows), stood, since, known, batch_id)

    def _as_rows(rows: DataFrame) -> DataFrame:
        return rows.select("run_id", *[F.col(c).cast(kinds[c]).alias(c) for c in (*PLACE, value)])

    def _end(results: DataFrame, stood: DataFrame | None, since: DataFrame, known: DataFrame | None, batch_id: int) -> None:
        """Write what differs from how the results ``stood``, then what is known of each run."""
        spark = since.sparkSession
        if known is None:
            results = results.withColumn("is_entry", F.lit(False))
        out = f"{path}/changes/batch_id={batch_id}"
        kept = f"{path}/results/batch_id={batch_id}"
        results.select(*columns, "is_entry").write.mode("overwrite").parquet(kept)
        results = spark.read.parquet(kept)
        now = results.filter(~F.col("is_entry")).select(columns).withColumn("taken_back", F.lit(False))
        if stood is not None:
            was = stood.select(*columns[:-1], F.col(value).alias("was"), F.lit(True).alias("stood"))
            both = now.join(was, columns[:-1], "full")
            same = F.col("stood").isNotNull() & F.col("taken_back").isNotNull() & F.col(value).eqNullSafe(F.col("was"))
            now = both.filter(~same).select(
                *columns[:-1],
                F.coalesce(value, "was").alias(value),
                F.col("taken_back").isNull().alias("taken_back"),
            )
        now.write.mode("overwrite").parquet(out)
        last = results.groupBy("run_id").agg(F.max(F.struct(*PLACE, value)).alias("last"))
        state = since.join(last, "run_id", "left").select("run_id", "heard", "last")
        if known is not None:
            # Results of progress only rise, and not all are run again: the later, higher one stands.
            # Those of reports are all run again from the oldest new row on.
            own, before = F.col("last"), F.col("last_before")
            before_ = known.withColumnsRenamed({"heard": "heard_before", "last": "last_before"})
            state = state.join(before_, "run_id", "full").select(
                "run_id",
                F.greatest("heard", "heard_before").alias("heard"),
                (F.greatest(own, before) if by_results else F.coalesce(own, before)).alias("last"),
            )
        state.write.mode("overwrite").parquet(f"{path}/known/batch_id={batch_id}")

    return (
        feed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
