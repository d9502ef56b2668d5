"""Sources mixed to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies in the mix. Of all rates that
give each source its target number of tokens, entropy balancing takes those nearest to one in
relative entropy, summed over documents. They are tilted exponentially by the document's tokens,

    rate = min(limit, exp(dual of its source * size)),

so where a source has to grow its long documents grow most. The dual is convex, and its Newton
steps need, for each source, the tokens that the present rates take (the gradient) and their
derivative. Each step sums both in Spark, from the number of documents of each (source, size). A
step that would leave the interval known to hold the solution is replaced by halving it.

Rates are then rounded to copies. Documents of a source are dealt by hash into blocks of about
``BLOCK_ROWS``; in a block, longest first, each takes the whole number below or above its rate
that keeps the tokens taken so far nearest to the tokens due. What is off at the end is mended by
one or two documents at a time, those whose other whole number brings it nearest to zero, as long
as that helps; a block of few documents then also takes one copy more or less than that of any.
Blocks are independent tasks, whatever a source's size.

Defined cases: a null text or one without words has size 0, takes 0 words and keeps one copy
at most; a null source is a source of its own, last in order; repeated rows are documents of
their own; an empty table gives no rows. Columns of the input stay, but for ones named like an
added column, which is replaced.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import stored

#: Rows of a source that are rounded together, about.
BLOCK_ROWS = 512

#: Newton steps on a convex dual settle in about ten; far more mean a fault.
NEWTON_STEPS = 100

ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def token_targets(sizes: DataFrame, weights: tuple[float, ...], limit: float) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target.

    Weights repeat over the sources by code point, null last. A target stops at ``limit`` times
    its source's size, and what is over is shared among the others by weight, until none is
    above. In order of limit over weight, a source stops if the level of those not stopped
    before it would lift it over its limit; so two running sums over sources do it. From the first
    that does not stop on, levels only fall, so that one has the level of all the others.
    """
    in_order = Window.partitionBy().orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.row_number().over(in_order) - 1) % len(weights) + 1,
    )
    by_limit = Window.partitionBy().orderBy("full", F.col("source").isNull(), "source")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(limit))
        .withColumn("full", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after),
        )
        .withColumn("stops", F.col("level") >= F.col("full"))
        .withColumn("last_level", F.max(F.when(~F.col("stops"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("stops"), F.col("most")).otherwise(F.col("weight") * F.col("last_level")))
        .select("source", "source_size", "target")
    )


def balanced_duals(classes: DataFrame, targets: DataFrame, limit: float, tolerance: float = 1e-9) -> DataFrame:
    """``targets`` with the dual variable of each source.

    ``classes`` (source, size, n) counts the documents of a size. Steps are taken until every
    source is within ``tolerance`` of its target; a source without tokens has no constraint, and
    one whose target is its limit has all documents there. Each step is written down, so a later
    one does not repeat the earlier ones.
    """
    # At ``top`` every document with a token is at the limit; at ``low`` too little is taken, as
    # exp(dual * size) is at most exp(dual) below zero.
    top, goal = math.log(limit), F.col("target")
    full = goal >= F.col("source_size") * float(limit) * (1 - 1e-12)
    has_tokens = (F.col("source_size") > 0) & (goal > 0)
    low = -1 - F.log(F.greatest(F.col("source_size") / goal, F.lit(1.0)))
    duals = targets.withColumns(
        {
            "dual": F.when(has_tokens & full, F.lit(top)).otherwise(0.0),
            "low": F.when(has_tokens, low).otherwise(0.0),
            "high": F.lit(top),
        }
    )
    size, n = F.col("size"), F.col("n")
    state = ("source", "source_size", "target", "dual", "low", "high")
    for _ in range(NEWTON_STEPS):
        rate = _rate(limit)
        off, slope = F.col("taken") - goal, F.col("slope")
        low = F.when(off < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") - F.try_divide(off, slope)
        inside = (newton > low) & (newton < high)
        far = (F.col("source_size") > 0) & (F.abs(off) > tolerance * F.greatest(goal, F.lit(1.0)))
        step = (
            classes.withColumnRenamed("source", "of")
            .join(duals, F.col("of").eqNullSafe(F.col("source")))
            .groupBy(*state)
            .agg(
                F.sum(size * n * rate).alias("taken"),
                F.sum(F.when(rate < limit, size * size * n * rate).otherwise(0.0)).alias("slope"),
            )
            .withColumn("far", far)
            .withColumn("moved", F.when(~far, F.col("dual")).when(inside, newton).otherwise((low + high) / 2))
        )
        step = stored(step.withColumns({"low": low, "high": high}).drop("dual").withColumnRenamed("moved", "dual"), "duals")
        still = step.agg(F.max("far")).first()[0]
        duals = step.select(*state)
        if not still:
            return duals.drop("low", "high")
    raise ArithmeticError(f"duals are not settled after {NEWTON_STEPS} Newton steps")


def _rate(limit: float) -> Column:
    """The rate of a document of ``size`` by the ``dual`` of its source."""
    return F.least(F.exp(F.col("dual") * F.col("size")), F.lit(float(limit)))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    limit: int = 3,
    source: str = "source",
    size: Column | None = None,
    key: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies times size).

    ``size`` defaults to the words of ``text``; ``key`` names columns that tell documents apart.
    """
    size = word_count(F.col("text")) if size is None else size
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    # Plain positions for names: the caller's columns may have any name.
    sized = docs.select(
        size.cast("long").alias("size"),
        F.col(source).alias("source"),
        F.pmod(F.xxhash64(*key, size), F.lit(1 << 40)).alias("mark"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row"),
    )
    classes = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    sizes = classes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows")
    )
    duals = balanced_duals(classes, token_targets(sizes.drop("rows"), weights, limit), limit)
    sources = (
        duals.join(
            sizes.select(F.col("source").alias("of"), "rows"), F.col("of").eqNullSafe(F.col("source"))
        ).select(
            "of",
            "source_size",
            "target",
            "dual",
            F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("blocks"),
        )
    )
    rated = sized.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", F.pmod(F.col("mark"), F.col("blocks")).alias("block"), "mark",
        "size", "source_size", "target", _rate(limit).alias("rate"), "row",
    )
    fields = [f for f in rated.schema.fields if f.name in ("size", "source_size", "target", "row")]
    out = T.StructType([*fields, T.StructField("copies", T.IntegerType())])
    rounded = rated.groupBy("source", "block").applyInArrow(lambda block: _rounded(block, limit), out)
    return rounded.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)],
        "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _rounded(block: pa.Table, limit: int) -> pa.Table:
    """Copies for the documents of one block, at most ``limit`` each."""
    order = np.lexsort((block["mark"].to_numpy(), -block["size"].to_numpy()))
    size, rate = block["size"].to_numpy()[order], block["rate"].to_numpy()[order]
    low = np.floor(rate).astype(np.int64)
    copies = np.where(size > 0, low, np.minimum(low, 1))
    due = 0.0  # tokens due less tokens taken
    for i, (n, part) in enumerate(zip(size.tolist(), (rate - low).tolist())):
        due += part * n
        if n and 2 * due > n and part:
            copies[i] += 1
            due -= n
    due = _mended(copies, size, due, low, np.ceil(rate).astype(np.int64))
    if abs(due) > 1:
        _mended(copies, size, due, np.zeros_like(low), np.full_like(low, limit))
    columns = block.take(order).select(["size", "source_size", "target", "row"])
    return columns.append_column("copies", pa.array(copies, pa.int32()))


def _mended(copies: np.ndarray, size: np.ndarray, due: float, least: np.ndarray, most: np.ndarray) -> float:
    """Change ``copies`` by one here and there, within bounds, while that brings ``due`` to zero."""
    while True:
        way = 1 if due > 0 else -1
        up, down = (copies < most) & (size > 0), (copies > least) & (size > 0)
        forth, back = np.flatnonzero(up if way > 0 else down), np.flatnonzero(down if way > 0 else up)
        where = np.concatenate([forth, back])
        steps = np.concatenate([np.full(len(forth), way), np.full(len(back), -way)])
        picked = _nearest(size[where] * steps, due) > 0
        if not picked.any():  # also where there is nothing to change
            return due
        np.add.at(copies, where[picked], steps[picked])
        due -= float((size[where] * steps)[picked].sum())


def _nearest(steps: np.ndarray, due: float) -> np.ndarray:
    """Which none, one or two of ``steps`` (1 there, else 0) come nearest to ``due``."""
    if not len(steps):
        return steps
    order = np.argsort(steps, kind="stable")
    ordered = steps[order]
    picked, off = [], abs(due)
    # Two different ones: the other stands next to where the rest of the way would be.
    at = np.searchsorted(ordered, due - ordered)
    me = np.arange(len(ordered))
    for other in (at - 2, at - 1, at, at + 1, np.full(len(at), -1)):
        alone = other < 0
        usable = alone | ((other < len(ordered)) & (other != me))
        sums = ordered + np.where(alone, 0, ordered[np.clip(other, 0, len(ordered) - 1)])
        miss = np.where(usable, np.abs(due - sums), np.inf)
        best = int(miss.argmin())
        if miss[best] < off - 1e-9:
            off, picked = miss[best], [best] if alone[best] else [best, int(other[best])]
    out = np.zeros(len(steps), np.int64)
    out[order[picked]] = 1
    return out


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns."""
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    held = docs.select(
        F.col(options.pop("source", "source")).alias("source"),
        word_count(F.col("text")).alias("words"),
        # Documents alike in id and size are told apart by their texts, so that reruns agree.
        F.xxhash64("doc_id", "text").alias("id"),
        row.alias("whole"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return (
        mix(held, size=F.col("words"), key=("id",), **options)
        .select("whole", copies.alias("copy"))
        .select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    )
