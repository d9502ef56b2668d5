"""Streaming forms of the run-status operators.

``state_flags`` and the one-row-per-run operators (``current_state``,
``reconcile_state``, ``final_outcome``, ``failure_reason``) take a stream as they
are: use output mode ``update`` or ``complete``. They order by ``(ts, seq)``, so
late rows find their place, and keep one state row per run.

The forms below keep state by hand. Rows of one run are put in order within a
micro-batch, and follow those of earlier batches; rows later than ``delay`` are
dropped, as with any watermark. What is known of a run is forgotten when nothing
was heard of it for ``forget_after_seconds``. The rows of a run within one
micro-batch are held by one task: bound them with the source's trigger limits.
Rows pass through pandas, which turns a NaN progress into null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from runledger.functions import states
from runledger.operators.throttle import keep_beats

DELAY = "1 day"
FORGET_AFTER_SECONDS = 30 * 86400


def with_event_time(feed: DataFrame, delay: str = DELAY) -> DataFrame:
    """The feed with a watermark on ``ts``, which has to be a zoned timestamp."""
    return feed.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def first_arrived_outcome(feed: DataFrame, delay: str | None = None) -> DataFrame:
    """``(run_id, outcome, reason, seq, ts)``: the terminal row that arrives first.

    Emits at once, one row per run: the state is the id of every run that has
    ended. With a ``delay`` a run is forgotten that long after its outcome, and
    has another row if it ends again later. Arrival order need not be event
    order; ``final_outcome`` in update mode follows the latter.
    """
    ended = feed.where(states.is_finished(F.col("state")))
    ended = ended.withColumn("ts", F.col("ts").cast("timestamp"))
    if delay is None:
        once = ended.dropDuplicates(["run_id"])
    else:
        once = with_event_time(ended, delay).dropDuplicatesWithinWatermark(["run_id"])
    succeeded = states.is_succeeded(F.col("state"))
    return once.select(
        "run_id",
        F.when(succeeded, "FINISHED").otherwise("FAILED").alias("outcome"),
        F.when(~succeeded, F.col("reason")).alias("reason"),
        "seq",
        "ts",
    )


def running_progress_stream(
    feed: DataFrame,
    delay: str = DELAY,
    forget_after_seconds: int = FORGET_AFTER_SECONDS,
) -> DataFrame:
    """Every row with the highest progress of its run so far; append mode."""

    def rise(rows: pd.DataFrame, known: tuple | None) -> tuple[pd.DataFrame, tuple]:
        reached = known[0] if known else 0.0
        best = np.maximum.accumulate(np.fmax(rows["progress"].to_numpy(float), reached))
        return rows.assign(progress=best), (float(best[-1]),)

    return _per_run(feed, rise, "reached double", delay, forget_after_seconds)


def throttled_report_stream(
    feed: DataFrame,
    compare: str = "state",
    heartbeat_seconds: float = 60.0,
    delay: str = DELAY,
    forget_after_seconds: int = FORGET_AFTER_SECONDS,
) -> DataFrame:
    """The rows that are reported, as ``throttled_report``; append mode."""
    heartbeat = int(heartbeat_seconds * 1_000_000)

    def throttle(rows: pd.DataFrame, known: tuple | None) -> tuple[pd.DataFrame, tuple]:
        t, report = rows["_us"].to_numpy(), rows["_report"].to_numpy()
        keep = np.append(True, (report[1:] != report[:-1]) | (t[1:] > t[:-1] + heartbeat))
        kept = t[0]
        if known:
            keep[0] = report[0] != known[0] or t[0] > known[1] + heartbeat
            kept = t[0] if keep[0] else known[1]
        starts = np.flatnonzero(keep)
        if not keep[0]:
            starts = np.append(0, starts)
        last_kept = t[starts]
        last_kept[0] = kept
        keep_beats(t, keep, starts, last_kept, heartbeat)
        if keep.any():
            kept = t[keep][-1]
        return rows[keep], (report[-1], int(kept))

    # No report at all is a report of its own.
    report = F.coalesce(F.concat(F.lit("="), F.col(compare).cast("string")), F.lit(""))
    return _per_run(
        feed.withColumn("_report", report),
        throttle,
        "report string, kept_us bigint",
        delay,
        forget_after_seconds,
    ).drop("_report")


def _per_run(
    feed: DataFrame,
    step: Callable[[pd.DataFrame, tuple | None], tuple[pd.DataFrame, tuple]],
    known_schema: str,
    delay: str,
    forget_after_seconds: int,
) -> DataFrame:
    """Apply ``step`` to the new rows of a run and to what is known of it."""
    timed = with_event_time(feed, delay)
    columns = timed.columns
    forget_after = forget_after_seconds * 1000

    def update(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches), ignore_index=True)
        rows = rows.take(np.lexsort((rows["seq"].to_numpy(), rows["_us"].to_numpy())))
        heard = max(state.getCurrentWatermarkMs(), int(rows["_us"].max()) // 1000)
        rows, known = step(rows, state.get if state.exists else None)
        state.update(known)
        state.setTimeoutTimestamp(heard + forget_after)
        yield rows[columns]

    return (
        timed.withColumn("_us", F.unix_micros("ts"))
        .groupBy("run_id")
        .applyInPandasWithState(
            update, timed.schema, known_schema, "append", GroupStateTimeout.EventTimeTimeout
        )
    )

