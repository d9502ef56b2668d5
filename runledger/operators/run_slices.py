"""Cutting the feed of a hot run into slices that fit one task.

Operators that look at the rows of a run in ``(ts, seq)`` order would send a run
that holds a large part of the feed to a single task. ``cut_hot_runs`` gives
every row a ``run_slice`` number: slices are contiguous in ``(ts, seq)``, number
upwards within their run and hold about ``slice_rows`` rows. Ordinary runs stay
whole, as slice 0. An operator then works per ``(run_id, slice)`` and hands on
what a slice has to know about the earlier ones as one small row per slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000
MAX_SLICES = 50_000
MARKS_PER_SLICE = 32

SLICE_KEYS = ["run_id", "run_slice"]
IN_ORDER = ["ts", "seq"]


@dataclass(frozen=True)
class SlicedFeed:
    """``rows`` is the whole feed with ``run_slice``; ``hot`` its cut runs only.

    ``hot`` is None when no run had to be cut.
    """

    rows: DataFrame
    hot: DataFrame | None


def cut_hot_runs(
    feed: DataFrame, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> SlicedFeed:
    """Add ``run_slice``; counts rows per run first and stops there if none is hot.

    A feed with hot runs is read several times, and has to be the same each time.
    At most about ``max_slices`` slices are made: beyond that they get longer.
    Everything broadcast here or by the callers is bounded by that number.
    """
    return cut_hot(feed, ["run_id"], IN_ORDER, slice_rows, max_slices, "run_slice")


def cut_hot(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    slice_rows: int,
    max_slices: int,
    name: str,
    first: int = 0,
) -> SlicedFeed:
    """The same for any keys and order; slices of hot keys are numbered from ``first`` on.

    Order columns have no nulls. Rows alike in all of them lie in one slice.
    """
    cuts = _find_cuts(rows.select(*keys, *order), keys, order, slice_rows, max_slices)
    if cuts is None:
        return SlicedFeed(rows.withColumn(name, F.lit(0)), None)
    longest = cuts.agg(F.max(F.size("cuts"))).first()[0]
    number = _cuts_up_to(F.col("cuts"), longest, order) + first
    names = _cut_names(keys)
    joined = rows.join(F.broadcast(cuts), same_keys(keys, names), "left")
    cut = joined.withColumn(name, F.when(F.col("cuts").isNull(), 0).otherwise(number))
    hot = cut.where(F.col("cuts").isNotNull())
    return SlicedFeed(cut.drop(*names, "cuts"), hot.drop(*names, "cuts"))


def _cut_names(keys: list[str]) -> list[str]:
    return [f"_cut_{i}" for i in range(len(keys))]


def same_keys(left: list[str], right: list[str]) -> Column:
    both = F.lit(True)
    for a, b in zip(left, right):
        both &= F.col(a).eqNullSafe(F.col(b))
    return both


def _find_cuts(
    rows: DataFrame, keys: list[str], order: list[str], slice_rows: int, max_slices: int
) -> DataFrame | None:
    """Keys (by ``_cut_names``) longer than a slice, and ``cuts`` from evenly spread marks.

    A mark is a row whose hash falls into one of ``every`` classes. Which rows
    are marks only moves the borders between slices, never the result, and the
    hash makes a re-run task choose the same ones.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot_rows = sizes.where(F.col("_n") > slice_rows).agg(F.sum("_n")).first()[0]
    if hot_rows is None:
        return None
    slice_rows = max(slice_rows, -(-hot_rows // max_slices))
    every = max(1, slice_rows // MARKS_PER_SLICE)
    names = _cut_names(keys)
    named = [F.col(k).alias(n) for k, n in zip(keys, names)]
    hot = sizes.where(F.col("_n") > slice_rows).select(*named)
    marks = rows.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0).join(
        F.broadcast(hot), same_keys(keys, names), "left_semi"
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cuts = (
        marks.withColumn("_nth", nth)
        .where(F.col("_nth") % (slice_rows // every) == 0)
        .groupBy(*named)
        .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("cuts"))
    )
    # No more than max_slices cuts in all: brought here once, so that every later
    # use (and every re-run task) sees the same borders.
    found = cuts.toArrow()
    if found.num_rows == 0:
        return None
    return rows.sparkSession.createDataFrame(found, schema=cuts.schema)


def _cuts_up_to(cuts: Column, longest: int, order: list[str]) -> Column:
    """How many of the sorted ``cuts`` are not after the row, by halving steps."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(longest.bit_length()))))

    def step(found: Column, width: Column) -> Column:
        further = found + width
        cut = F.get(cuts, further - 1)
        # Field by field: several times faster here than comparing structs.
        not_after = cut[order[-1]] <= F.col(order[-1])
        for name in reversed(order[:-1]):
            not_after = (cut[name] < F.col(name)) | ((cut[name] == F.col(name)) & not_after)
        return F.when(not_after, further).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)
