"""What is known of a run at each of its rows, and the report line it gives.

A summary of a run merges (``operators.run_summary``), so it can be carried along: at a row it is
the summary of the run's rows so far. Within a slice of a hot run that is a window; what the
earlier slices come to is one summary per slice, merged by the same minima and maxima, and
broadcast. State and reason are carried forward apart, as they come from different rows: a
progress message changes neither, a failed status both, a lost driver the reason alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.functions import states
from runledger.operators.run_slices import IN_ORDER, MAX_SLICES, SLICE_KEYS, SLICE_ROWS, cut_hot_runs, same_keys
from runledger.operators.run_summary import PARTS, run_events, said, told
from runledger.operators.throttle import throttled_report


def running_summary(
    feed: DataFrame, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES, keep: tuple[str, ...] = ("ts", "seq")
) -> DataFrame:
    """What ``told`` says of a run, for every row of the feed: by that row and those before it."""
    events = run_events(feed, keep)
    rows = events.select(*dict.fromkeys(("run_id", *IN_ORDER, *keep)), *[part.alias(name) for name, part in said().items()])
    cut = cut_hot_runs(rows, slice_rows, max_slices)
    so_far = (
        Window.partitionBy(*SLICE_KEYS).orderBy(*IN_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.rows.withColumns({name: merge(name).over(so_far) for name, merge in PARTS.items()})
    if cut.hot is None:
        return told(local.drop("run_slice"), keep)
    earlier = Window.partitionBy("run_id").orderBy("run_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.hot.groupBy(*SLICE_KEYS).agg(*[merge(name).alias(name) for name, merge in PARTS.items()])
    before = slices.select(
        F.col("run_id").alias("of_run"),
        F.col("run_slice").alias("of_slice"),
        *[merge(name).over(earlier).alias(f"{name}_before") for name, merge in PARTS.items()],
    )
    joined = local.join(F.broadcast(before), same_keys(SLICE_KEYS, ["of_run", "of_slice"]), "left")
    either = {F.min: F.least, F.max: F.greatest}
    whole = joined.withColumns({name: either[merge](name, f"{name}_before") for name, merge in PARTS.items()})
    return told(whole, keep)


def report_lines(feed: DataFrame, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES) -> DataFrame:
    """``(run_id, ts, seq, line)``: the report line of a run at each row of its feed."""
    known = running_summary(feed, slice_rows, max_slices, keep=("ts", "seq", "app_id"))
    line = states.report_line(F.col("app_id"), F.col("state"), F.col("reason"))
    return known.select("run_id", "ts", "seq", line.alias("line"))


def throttled_lines(
    feed: DataFrame, heartbeat_seconds: float = 60.0, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> DataFrame:
    """The report lines that would be reported: changed since the last one, or a heartbeat later."""
    return throttled_report(report_lines(feed, slice_rows, max_slices), "line", heartbeat_seconds, slice_rows, max_slices)
