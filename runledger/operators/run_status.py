"""Queries over a run-status feed.

A feed has ``run_id``, an order ``(ts, seq)`` without nulls, ``src``, ``state``,
``progress`` and ``reason``; each operator reads only what it needs. Rows of equal
``(ts, seq)`` in one run have no order.
One row per run is always a plain aggregation: it combines before the shuffle,
so a run holding a third of the feed costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.functions import states
from runledger.operators.run_slices import (
    IN_ORDER,
    MAX_SLICES,
    SLICE_KEYS,
    SLICE_ROWS,
    cut_hot_runs,
)


def state_flags(feed: DataFrame) -> DataFrame:
    """The feed with the four membership flags of its state."""
    state = F.col("state")
    return feed.withColumns(
        {
            "is_failed": states.is_failed(state),
            "is_succeeded": states.is_succeeded(state),
            "is_finished": states.is_finished(state),
            "is_stage_succeeded": states.is_stage_succeeded(state),
        }
    )


def current_state(feed: DataFrame) -> DataFrame:
    """``(run_id, state, seq)``: the last status of every run.

    Progress messages have no state and leave it alone; a run that has sent
    nothing else is UNKNOWN, without a ``seq``.
    """
    told = F.col("state").isNotNull()
    last = F.max(F.when(told, F.struct("ts", "seq", "state"))).alias("last")
    state = F.coalesce("last.state", F.lit("UNKNOWN")).alias("state")
    return feed.groupBy("run_id").agg(last).select("run_id", state, "last.seq")


def reconcile_state(feed: DataFrame) -> DataFrame:
    """``(run_id, state)`` from both feeds.

    A RUNNING of the cluster report only counts while the run is SUBMITTED, so
    only one after the last row of any other kind can still matter. A run that
    has nothing else is UNKNOWN. Progress messages, without a state, take no part.
    """
    told = F.col("state").isNotNull()
    app_running = states.is_app_running(F.col("src"), F.col("state"))
    seen = feed.groupBy("run_id").agg(
        F.max(F.when(told & ~app_running, F.struct("ts", "seq", "state"))).alias("base"),
        F.max(F.when(told & app_running, F.struct("ts", "seq"))).alias("app"),
    )
    confirmed = (F.col("base.state") == "SUBMITTED") & (
        F.col("app") > F.struct("base.ts", "base.seq")
    )
    state = (
        F.when(F.col("base").isNull(), "UNKNOWN")
        .when(confirmed, "RUNNING")
        .otherwise(F.col("base.state"))
    )
    return seen.select("run_id", state.alias("state"))


def final_outcome(feed: DataFrame) -> DataFrame:
    """``(run_id, outcome, first_state, reason, seq)``: the first terminal row wins.

    The outcome is FINISHED or FAILED whichever way the run failed; runs that
    have not ended have no row.
    """
    ended = feed.where(states.is_finished(F.col("state")))
    first = F.min(F.struct("ts", "seq", "state", "reason")).alias("first")
    succeeded = states.is_succeeded(F.col("first.state"))
    return (
        ended.groupBy("run_id")
        .agg(first)
        .select(
            "run_id",
            F.when(succeeded, "FINISHED").otherwise("FAILED").alias("outcome"),
            F.col("first.state").alias("first_state"),
            F.when(~succeeded, F.col("first.reason")).alias("reason"),
            "first.seq",
        )
    )


def failure_reason(feed: DataFrame) -> DataFrame:
    """``(run_id, reason, seq)``: reason of the last failed row, null if none."""
    failed = states.is_failed(F.col("state"))
    last = F.max(F.when(failed, F.struct("ts", "seq", "reason"))).alias("last")
    return feed.groupBy("run_id").agg(last).select("run_id", "last.reason", "last.seq")


def running_progress(
    feed: DataFrame, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> DataFrame:
    """The feed with ``progress`` replaced by its running maximum, from 0.0 up."""
    progress = F.greatest(F.nanvl("progress", F.lit(0.0)), F.lit(0.0))
    cut = cut_hot_runs(
        feed.withColumn("progress", progress), slice_rows, max_slices
    )
    so_far = (
        Window.partitionBy(*SLICE_KEYS)
        .orderBy(*IN_ORDER)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.rows.withColumn("progress", F.max("progress").over(so_far))
    if cut.hot is None:
        return local.drop("run_slice")

    # One row per slice of a hot run: what the earlier slices had reached.
    earlier = (
        Window.partitionBy("run_id")
        .orderBy("run_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = (
        cut.hot.groupBy(*SLICE_KEYS)
        .agg(F.max("progress").alias("top"))
        .select(
            F.col("run_id").alias("of_run"),
            F.col("run_slice").alias("of_slice"),
            F.max("top").over(earlier).alias("before"),
        )
    )
    same_slice = F.col("run_id").eqNullSafe(F.col("of_run")) & (
        F.col("run_slice") == F.col("of_slice")
    )
    return (
        local.join(F.broadcast(reached), same_slice, "left")
        .withColumn("progress", F.greatest("progress", "before"))
        .drop("run_slice", "of_run", "of_slice", "before")
    )
