"""How many spans of time overlap each span, without forming pairs.

A span overlaps those that begin no later than it ends, less those that end before it begins. Both
are places in one order of all begins and ends: of a point, the points before it less those of
its own sort. The order is cut into slices of bounded size (``hot_windows``), so a busy hour costs
as much as its rows, not their square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.operators.hot_windows import ranked
from runledger.operators.run_slices import MAX_SLICES, SLICE_ROWS

_POINT = ["_at", "_sort"]


def overlapping(
    spans: DataFrame,
    ids: list[str],
    begin: str = "begin",
    end: str = "end",
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
) -> DataFrame:
    """(ids, n_overlapping) of each span: how many other spans share an instant with it, ends included.

    ``ids`` are unique and not null. A span without begin or end, or that ends before it begins,
    holds no instant: it overlaps none.
    """
    whole = F.coalesce(F.col(begin) <= F.col(end), F.lit(False))
    # At one instant begins come before ends, as spans that touch overlap.
    points = F.array(*[F.struct(F.col(c).alias("_at"), F.lit(i).alias("_sort")) for i, c in enumerate((begin, end))])
    rows = spans.filter(whole).select(*ids, F.explode(points).alias("p")).select(*ids, "p.*", F.lit(0).alias("_all"))
    extra = ("rank", "dense_rank", "n_rows")
    placed = ranked(rows, ["_all"], _POINT, [*_POINT, *ids], slice_rows, max_slices).drop(*extra)
    placed = placed.withColumnRenamed("row_no", "_place")
    placed = ranked(placed, ["_sort"], ["_at"], ["_at", *ids], slice_rows, max_slices).drop(*extra)
    others = F.col("_place") - F.col("row_no")
    counts = placed.groupBy(*ids).agg(F.sum(F.when(F.col("_sort") == 1, others).otherwise(-others)).alias("n"))
    none = spans.filter(~whole).select(*ids, F.lit(0).cast("long").alias("n_overlapping"))
    return counts.select(*ids, (F.col("n") - 1).alias("n_overlapping")).union(none)
