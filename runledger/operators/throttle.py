"""Throttled reports: repeat an unchanged report only after a heartbeat.

A row is kept if its report differs from the last kept one of its run, or if it
is more than the heartbeat later. Since an unkept row always equals the last kept
one, "differs" only needs the row just before; and a row that differs, or follows
a gap longer than the heartbeat, is kept whatever came earlier. Those rows are
found for whole Arrow batches at once. Only the beats inside an unchanged stretch
depend on each other, and are found by jumping from one to the next.

For runs cut into slices, what a slice leaves behind is first summed up as a step
table: "last kept before the slice" -> "last kept at its end". Only rows within
one heartbeat of the slice's start can be the first kept one, so the table has no
more rows than that. Step tables are functions, constant on stretches, and two
neighbouring ones compose into one for both slices, no longer than the first.
So the slices of a run form a tree: ``FAN_IN`` neighbours are composed in one task,
then ``FAN_IN`` of these, up to the whole run; and down again each gives its parts
what they have to know. The rounds grow with the logarithm of the number of slices,
and no task reads more than ``FAN_IN`` tables, however long a run is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.operators.run_slices import (
    IN_ORDER,
    MAX_SLICES,
    SLICE_KEYS,
    SLICE_ROWS,
    cut_hot_runs,
)
from runledger.sources.shared import fresh_folder


def throttled_report(
    feed: DataFrame,
    compare: str = "state",
    heartbeat_seconds: float = 60.0,
    slice_rows: int = SLICE_ROWS,
    max_slices: int = MAX_SLICES,
) -> DataFrame:
    """The rows of ``feed`` that would be reported, comparing one column."""
    heartbeat = int(heartbeat_seconds * 1_000_000)
    if heartbeat < 0:
        raise ValueError("heartbeat_seconds must not be negative")
    columns, report = feed.columns, compare
    if feed.schema[compare].dataType != T.StringType():
        report = "_report"
        feed = feed.withColumn(report, F.col(compare).cast("string"))
    cut = cut_hot_runs(feed, slice_rows, max_slices)
    rows = cut.rows
    if cut.hot is not None:
        hot = cut.hot.select(*SLICE_KEYS, *IN_ORDER, F.col(report).alias("report"))
        same_slice = F.col("run_id").eqNullSafe(F.col("of_run")) & (
            F.col("run_slice") == F.col("of_slice")
        )
        # One row per slice, so no more than max_slices and a few.
        entries = F.broadcast(_slice_entries(hot, heartbeat))
        rows = rows.join(entries, same_slice, "left").drop("of_run", "of_slice")
    in_order = rows.repartition(*SLICE_KEYS).sortWithinPartitions(*SLICE_KEYS, *IN_ORDER)
    keep = _KeepReports(columns, report, heartbeat, entered=cut.hot is not None)
    return in_order.mapInArrow(keep, feed.select(*columns).schema)


def micros(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A timestamp column as microseconds."""
    if not pa.types.is_integer(column.type):
        column = pc.cast(column, pa.timestamp("us", tz=column.type.tz))
    return pc.cast(column, pa.int64()).to_numpy(zero_copy_only=False)


def differs(column: pa.Array, before: pa.Array) -> np.ndarray:
    """Per row: is the value another one than in ``before``? Null equals null."""
    unequal = pc.fill_null(pc.not_equal(column, before), False)
    one_null = pc.xor(pc.is_null(column), pc.is_null(before))
    return np.array(pc.or_(unequal, one_null))


def shifted(column: pa.Array, first: pa.Array) -> pa.Array:
    """The column moved down one row, starting with the one-row ``first``."""
    return pa.concat_arrays([first, column.slice(0, len(column) - 1)])


def keep_beats(
    t: np.ndarray, keep: np.ndarray, starts: np.ndarray, kept: np.ndarray, heartbeat: int
) -> None:
    """Mark in ``keep`` the beats of every stretch.

    Stretch i begins at row ``starts[i]``, with ``kept[i]`` the time of the last
    kept row at that point (the row itself, if it is kept).
    """
    ends = np.append(starts[1:], len(t))
    for i in np.flatnonzero(t[ends - 1] > kept + heartbeat):
        at, end, last = starts[i], ends[i], kept[i]
        while True:
            at += np.searchsorted(t[at:end], last + heartbeat, side="right")
            if at >= end:
                break
            keep[at] = True
            last = t[at]


class _KeepReports:
    """Filter for partitions sorted by slice, ts, seq; batch by batch.

    With ``entered``, rows have in ``entry`` what their slice has to know about
    the rows before it: the last report and its time, and when one was last kept.
    """

    def __init__(self, columns: list[str], report: str, heartbeat: int, entered: bool):
        self.columns = columns
        self.report = report
        self.heartbeat = heartbeat
        self.entered = entered

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keep, tail = self._keep(batch, tail)
            yield batch.select(self.columns).filter(pa.array(keep))

    def _keep(self, batch, tail):
        t = micros(batch["ts"])
        first_batch = tail is None
        keys = {name: batch[name] for name in (*SLICE_KEYS, self.report)}
        if first_batch:
            tail = {name: column.slice(0, 1) for name, column in keys.items()}
            tail.update(t=t[0], kept=0)
        before = {name: shifted(column, tail[name]) for name, column in keys.items()}
        new_slice = differs(keys["run_id"], before["run_id"])
        new_slice |= differs(keys["run_slice"], before["run_slice"])
        new_slice[0] |= first_batch
        before_t = np.concatenate(([tail["t"]], t[:-1]))
        report = keys[self.report]
        keep = differs(report, before[self.report]) | (t > before_t + self.heartbeat)

        # A slice starts afresh, unless earlier rows of its run continue into it.
        heads = np.flatnonzero(new_slice)
        keep[heads] = True
        last_kept = np.where(keep, t, 0)
        if self.entered:
            entry = batch["entry"].take(pa.array(heads))
            known = np.array(pc.is_valid(entry))
            last_t, kept_t = (
                np.array(pc.fill_null(pc.struct_field(entry, name), 0))
                for name in ("last_us", "kept_us")
            )
            same = ~differs(report.take(pa.array(heads)), pc.struct_field(entry, "last_report"))
            continues = known & same & (t[heads] <= last_t + self.heartbeat)
            keep[heads[continues]] = False
            last_kept[heads[continues]] = kept_t[continues]

        starts = np.flatnonzero(keep | new_slice)
        if not (keep[0] or new_slice[0]):
            starts = np.concatenate(([0], starts))
            last_kept[0] = tail["kept"]
        keep_beats(t, keep, starts, last_kept[starts], self.heartbeat)

        end, start = len(t) - 1, starts[-1]
        tail = {name: column.slice(end, 1) for name, column in keys.items()}
        beats = np.flatnonzero(keep[start:])
        tail.update(t=t[end], kept=t[start + beats[-1]] if len(beats) else last_kept[start])
        return keep, tail


#: Step tables that one task composes.
FAN_IN = 16


def _slice_entries(hot: DataFrame, heartbeat: int) -> DataFrame:
    """``(of_run, of_slice, entry)`` for every slice but the first of a run."""
    spark, run_type = hot.sparkSession, hot.schema["run_id"].dataType
    node = T.StructType().add("run_id", run_type).add("run_slice", T.IntegerType())
    table_schema = (
        T.StructType(list(node.fields))
        .add("first_report", T.StringType())
        .add("first_us", T.LongType())
        .add("last_report", T.StringType())
        .add("last_us", T.LongType())
        .add("at", T.ArrayType(T.LongType()))
        .add("ends", T.ArrayType(T.LongType()))
    )
    entry_fields = [
        T.StructField("last_report", T.StringType()),
        T.StructField("last_us", T.LongType()),
        T.StructField("kept_us", T.LongType()),
    ]
    known_schema = T.StructType([*node.fields, *entry_fields])

    def steps(slice_rows: pa.Table) -> pa.Table:
        return _step_table(slice_rows, heartbeat)

    def compose(tables: pa.Table) -> pa.Table:
        return _composed(tables, heartbeat)

    def hand_down(tables: pa.Table) -> pa.Table:
        return _handed_down(tables, heartbeat, known_schema.names)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = fresh_folder(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # Up: a node of the next level stands for FAN_IN nodes, by their number.
    levels = [written(hot.groupBy(*SLICE_KEYS).applyInArrow(steps, table_schema), "steps")]
    widest = levels[0].agg(F.max("run_slice")).first()[0]
    above = F.floor(F.col("run_slice") / FAN_IN).cast("int").alias("group")
    while widest > 0:
        grouped = levels[-1].withColumn("group", above).groupBy("run_id", "group")
        levels.append(written(grouped.applyInArrow(compose, table_schema), "steps"))
        widest //= FAN_IN
    # Down: what a node knows of the rows before it goes to its parts, the first of them as it is.
    known = spark.createDataFrame([], known_schema)
    for tables in reversed(levels[:-1]):
        parts = tables.withColumn("group", above)
        of_group = known.withColumnsRenamed({"run_slice": "group"}).select(
            "run_id", "group", F.struct("last_report", "last_us", "kept_us").alias("entry")
        )
        same = F.col("run_id").eqNullSafe(F.col("of_run")) & (F.col("group") == F.col("of_group"))
        of_group = of_group.withColumnsRenamed({"run_id": "of_run", "group": "of_group"})
        parts = parts.join(of_group, same, "left").drop("of_run", "of_group")
        known = written(parts.groupBy("run_id", "group").applyInArrow(hand_down, known_schema), "entries")
    return known.select(
        F.col("run_id").alias("of_run"),
        F.col("run_slice").alias("of_slice"),
        F.struct("last_report", "last_us", "kept_us").alias("entry"),
    )


def _step_table(rows: pa.Table, heartbeat: int) -> pa.Table:
    """Where a slice ends up, by when its run was last kept before it.

    A row ``(at, ends)`` reads: if ``at`` is the first row of the slice that is
    kept, then ``ends`` is the last one. A slice with a row that is kept anyway
    has a single step with a null ``at``, as its end depends on nothing before.
    """
    rows = rows.sort_by([(name, "ascending") for name in IN_ORDER])
    t = micros(rows["ts"])
    report = rows["report"].combine_chunks()
    sure = differs(report, shifted(report, report.slice(0, 1)))
    sure[1:] |= t[1:] > t[:-1] + heartbeat
    after_sure = np.flatnonzero(sure)
    begin = after_sure[-1] if len(after_sure) else 0
    ends = _last_beats(t[begin:], heartbeat)
    if len(after_sure):
        at, ends = pa.nulls(1, pa.int64()), ends[:1]
    else:
        reach = np.searchsorted(t, t[0] + heartbeat, side="right") + 1
        starts, ends = t[:reach], ends[:reach]
        last_of_step = np.append(ends[1:] != ends[:-1], True)
        at, ends = pa.array(starts[last_of_step]), ends[last_of_step]
    first, last = rows.slice(0, 1), rows.slice(len(t) - 1, 1)
    return _one_table(
        first["run_id"], first["run_slice"], first["report"], t[0], last["report"], t[-1], at, ends
    )


def _one_table(run_id, run_slice, first_report, first_us, last_report, last_us, at, ends) -> pa.Table:
    """A step table as one row."""
    return pa.table(
        {
            "run_id": run_id,
            "run_slice": run_slice,
            "first_report": first_report,
            "first_us": pa.array([first_us], pa.int64()),
            "last_report": last_report,
            "last_us": pa.array([last_us], pa.int64()),
            "at": pa.array([pa.array(at).to_pylist()], pa.list_(pa.int64())),
            "ends": pa.array([np.asarray(ends).tolist()], pa.list_(pa.int64())),
        }
    )


def _last_beats(t: np.ndarray, heartbeat: int) -> np.ndarray:
    """For every row: when the last beat is, if the beats start at that row."""
    n = len(t)
    to = np.searchsorted(t, t + heartbeat, side="right")
    to = np.where(to < n, to, np.arange(n))
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return t[to]
        to = further


class _Steps:
    """The step table of a slice, or of several neighbours, as a function.

    ``at`` ascends, with ``ends`` for each; a table whose end depends on nothing before has a
    single step, at the end of time.
    """

    def __init__(self, row: dict):
        never = np.iinfo(np.int64).max
        self.row = row
        self.at = np.array([never if x is None else x for x in row["at"]], np.int64)
        self.ends = np.array(row["ends"], np.int64)

    def follows(self, before: dict, heartbeat: int) -> bool:
        """Whether the first row goes on from the last one ``before``, so may be left out."""
        same = self.row["first_report"] == before["last_report"]
        return same and self.row["first_us"] <= before["last_us"] + heartbeat

    def left(self, kept: np.ndarray, follows: bool, heartbeat: int) -> np.ndarray:
        """When a row was last kept at the end, if one was last kept at ``kept`` before."""
        if not follows:
            return np.full(len(kept), self.ends[0])
        step = np.searchsorted(self.at, kept + heartbeat, side="right")
        return np.where(step < len(self.at), self.ends[np.minimum(step, len(self.at) - 1)], kept)


def _in_order(tables: pa.Table) -> list[dict]:
    return sorted(tables.to_pylist(), key=lambda row: row["run_slice"])


def _composed(tables: pa.Table, heartbeat: int) -> pa.Table:
    """One step table for neighbouring slices, numbered as their group."""
    rows = _in_order(tables)
    first = _Steps(rows[0])
    at, ends, before = first.at, first.ends, rows[0]
    # Beyond the last step nothing of the slices so far was kept: a later one may start there.
    for row in rows[1:]:
        table = _Steps(row)
        follows = table.follows(before, heartbeat)
        further = table.at > at[-1] if follows else np.zeros(len(table.at), bool)
        ends = np.append(table.left(ends, follows, heartbeat), table.ends[further])
        if not follows and at[-1] != np.iinfo(np.int64).max:
            # Whatever is kept before, the first row of this slice is.
            at, ends = np.append(at, np.iinfo(np.int64).max), np.append(ends, table.ends[0])
        else:
            at = np.append(at, table.at[further])
        # No row kept before the first slice is more than a heartbeat before a row it leaves out.
        needed = int(np.searchsorted(at, rows[0]["first_us"] + heartbeat, side="right")) + 1
        at, ends = at[:needed], ends[:needed]
        before = row
    last_of_step = np.append(ends[1:] != ends[:-1], True)
    at, ends = at[last_of_step], ends[last_of_step]
    nulls = pa.array(at, mask=at == np.iinfo(np.int64).max)
    head, last = tables.slice(0, 1), rows[-1]

    def text(value: str | None) -> pa.Array:
        return pa.array([value], pa.string())

    return _one_table(
        head["run_id"], head["group"], text(rows[0]["first_report"]), rows[0]["first_us"],
        text(last["last_report"]), last["last_us"], nulls, ends,
    )


def _handed_down(tables: pa.Table, heartbeat: int, names: list[str]) -> pa.Table:
    """What each part of a group has to know, from what the group knows; none for the run's first."""
    rows, out = _in_order(tables), []
    known = rows[0]["entry"]
    for row in rows:
        table = _Steps(row)
        if known is None:
            kept = table.ends[0]
        else:
            out.append((row["run_slice"], known["last_report"], known["last_us"], known["kept_us"]))
            kept = table.left(np.array([known["kept_us"]]), table.follows(known, heartbeat), heartbeat)[0]
        known = {"last_report": row["last_report"], "last_us": row["last_us"], "kept_us": int(kept)}
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
    run_id = pa.chunked_array([tables["run_id"].slice(0, 1).combine_chunks()] * len(out), tables["run_id"].type)
    columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)]
    return pa.table([run_id, *columns], names)
