"""Window functions over keys that may hold any part of the rows.

A window gives all rows of a key to one task. Here a key with many rows is cut:

- Row numbers: rows are cut into slices, contiguous in order and of about ``slice_rows``. Numbers
  within a slice need that slice only; where it begins is a running sum over slices, one row each.
- Rank and dense rank also need to know whether the first value of a slice goes on from the slice
  before, and where that value began: the last value begun in an earlier slice, again over slices.
- Once rows are numbered, blocks of equal size need no borders to be looked for: block = number
  div size. What a window of bounded width sees beyond its block is handed over by copying the few
  rows next to a border into the block behind or before it; the copies are dropped afterwards.

Everything handed on is a row per slice, and slices are bounded in number, so those are broadcast.
If no key exceeds ``slice_rows`` the plan is the plain window.

Order columns are ascending and without nulls (negate or replace them before); rows that tie in
all of them are told apart by nothing, so give a unique last column. Null keys are a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.operators.run_slices import MAX_SLICES, SLICE_ROWS, cut_hot, same_keys

SLICE = "_slice"


def ranked(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    order: list[str],
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
) -> DataFrame:
    """``df`` with row_no, rank, dense_rank (all from 1) and n_rows of its key.

    ``order`` tells rows apart; ``values``, which it begins with, are what ranks compare.
    """
    if order[: len(values)] != values:
        raise ValueError("the order has to begin with the ranked values")
    cut = cut_hot(df, keys, order, slice_rows, max_slices, SLICE, first=1)
    in_slice = Window.partitionBy(*keys, SLICE)
    by_value, by_row = in_slice.orderBy(*values), in_slice.orderBy(*order)
    local = cut.rows.withColumns(
        {
            "row_no": F.row_number().over(by_row).cast("long"),
            "rank": F.rank().over(by_value).cast("long"),
            "dense_rank": F.dense_rank().over(by_value).cast("long"),
            "n_rows": F.count("*").over(in_slice),
        }
    )
    if cut.hot is None:
        return local.drop(SLICE)
    value = F.struct(*values)
    slices = (
        local.filter(F.col(SLICE) > 0)
        .groupBy(*keys, SLICE)
        .agg(
            F.count("*").alias("n"),
            F.max("dense_rank").alias("n_values"),
            F.min(value).alias("first"),
            F.max(value).alias("last"),
            # Where the last value of the slice begins in it.
            F.max("rank").alias("last_rank"),
        )
    )
    of_key = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = of_key.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("first") == F.lag("last").over(of_key), F.lit(False))
    slices = (
        slices.withColumn("goes_on", goes_on)
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("of_key", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("new_values", F.col("n_values") - F.col("goes_on").cast("long"))
        .withColumn("values_before", F.coalesce(F.sum("new_values").over(earlier), F.lit(0)))
        # A slice of nothing but the value before it begins no value.
        .withColumn("begun", F.when(~F.col("goes_on") | (F.col("n_values") > 1), F.col("before") + F.col("last_rank")))
        .withColumn("began", F.last("begun", ignorenulls=True).over(earlier))
    )
    names = [f"_k{i}" for i in range(len(keys))]
    handed = slices.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(SLICE).alias("_s"),
        "before", "values_before", "goes_on", "began", "of_key",
    )
    joined = local.join(F.broadcast(handed), same_keys([*keys, SLICE], [*names, "_s"]), "left")
    on, none = F.col("goes_on") & (F.col("dense_rank") == 1), F.lit(0)
    return joined.withColumns(
        {
            "row_no": F.col("row_no") + F.coalesce("before", none),
            "rank": F.when(on, F.col("began")).otherwise(F.col("rank") + F.coalesce("before", none)),
            "dense_rank": F.col("dense_rank") + F.coalesce(F.col("values_before") - F.col("goes_on").cast("long"), none),
            "n_rows": F.coalesce("of_key", "n_rows"),
        }
    ).drop(*names, "_s", "before", "values_before", "goes_on", "began", "of_key", SLICE)


def tile(row_no: Column, n_rows: Column, tiles: int) -> Column:
    """The tile (from 1) of a row: the first ``n_rows`` mod ``tiles`` tiles have one row more."""
    size, longer = F.floor(n_rows / tiles), n_rows % tiles
    in_longer = row_no <= longer * (size + 1)
    return F.when(in_longer, F.floor((row_no - 1) / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(row_no - 1 - longer * (size + 1), size))
    ).cast("long") + 1


def numbered(
    df: DataFrame, keys: list[str], order: list[str], slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> DataFrame:
    """``df`` with row_no (from 1) of each row among those of its key."""
    cut = cut_hot(df, keys, order, slice_rows, max_slices, SLICE)
    by_row = Window.partitionBy(*keys, SLICE).orderBy(*order)
    local = cut.rows.withColumn("row_no", F.row_number().over(by_row).cast("long"))
    if cut.hot is None:
        return local.drop(SLICE)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_k{i}" for i in range(len(keys))]
    counts = cut.hot.groupBy(*keys, SLICE).agg(F.count("*").alias("n"))
    handed = counts.withColumn("before", F.sum("n").over(earlier)).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(SLICE).alias("_s"), "before"
    )
    return (
        local.join(F.broadcast(handed), same_keys([*keys, SLICE], [*names, "_s"]), "left")
        .withColumn("row_no", F.col("row_no") + F.coalesce("before", F.lit(0)))
        .drop(*names, "_s", "before", SLICE)
    )


def over_blocks(
    df: DataFrame,
    keys: list[str],
    columns: dict[str, Column],
    before: int = 0,
    after: int = 0,
    row_no: str = "row_no",
    block_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df``, numbered by ``row_no`` in each key, with window ``columns`` of bounded width.

    A column may look ``before`` rows back and ``after`` rows ahead; it is taken ``over`` the
    window that ``block_window`` gives, from the rows of a block and those next to it.
    """
    if max(before, after) > block_rows:
        raise ValueError("a window wider than a block")
    at = F.col(row_no) - 1
    own = F.floor(at / block_rows)
    # A row is also seen by the next block if it is among the last of its own, and the other way.
    next_ = F.when(at % block_rows >= block_rows - before, own + 1)
    last = F.when((at % block_rows < after) & (own > 0), own - 1)
    seen = F.array_compact(F.array(own, next_, last))
    copied = df.withColumn("_own", own).withColumn(SLICE, F.explode(seen))
    return (
        copied.withColumns(columns)
        .filter(F.col("_own") == F.col(SLICE))
        .drop("_own", SLICE)
    )


def block_window(keys: list[str], row_no: str = "row_no"):
    """The window of a block, in order; for columns of ``over_blocks``."""
    return Window.partitionBy(*keys, SLICE).orderBy(row_no)


def with_first(
    df: DataFrame, keys: list[str], column: str, name: str, row_no: str = "row_no", block_rows: int = SLICE_ROWS
) -> DataFrame:
    """``df``, numbered by ``row_no`` in each key, with ``column`` of the key's first row.

    The first row is given to every block of its key, so that rows and it meet block by block.
    """
    block = F.floor((F.col(row_no) - 1) / block_rows)
    names = [f"_k{i}" for i in range(len(keys))]
    blocks = df.groupBy(*keys).agg(
        F.max(block).alias("_last"), F.max(F.when(F.col(row_no) == 1, F.struct(F.col(column).alias("v")))).alias("_first")
    )
    given = blocks.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("_b"),
        F.col("_first.v").alias(name),
    )
    return (
        df.withColumn(SLICE, block).join(given, same_keys([*keys, SLICE], [*names, "_b"])).drop(*names, "_b", SLICE)
    )
