"""A user's aggregate in Python whose states merge, so that it combines before the shuffle.

A grouped pandas function sees all rows of a group in one task. Here every task reduces its
own rows to a state per group, and only states are shuffled: a group with any part of the rows
is a few states a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: States that a task holds at once; beyond that it hands them on and begins anew.
MAX_HELD = 10_000

State = tuple[float, ...]


@dataclass(frozen=True)
class UserAggregate:
    """``start`` reduces values (never none) to a state of ``width`` numbers; ``merge`` joins two."""

    width: int
    start: Callable[[np.ndarray], State]
    merge: Callable[[State, State], State]
    finish: Callable[[State], float | None]


def aggregated(df: DataFrame, keys: list[str], value: str, aggregate: UserAggregate, name: str) -> DataFrame:
    """(keys, name): the aggregate of the values of each group that are not null; null if there are none."""
    plain = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(p) for k, p in zip(keys, plain)], F.col(value).cast("double").alias("v"))
    group = [rows.schema[p] for p in plain]
    parts_schema = T.StructType([*group, T.StructField("state", T.ArrayType(T.DoubleType()))])
    whole_schema = T.StructType([*group, T.StructField("whole", T.DoubleType())])

    def batch_of(states: dict, types: list[pa.DataType]) -> pa.RecordBatch:
        columns = list(zip(*states)) if states else [()] * len(plain)
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        state = pa.array([None if s is None else list(s) for s in states.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*arrays, state], [*plain, "state"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, State | None] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.schema.field(p).type for p in plain]
            grouped = pa.Table.from_batches([batch]).group_by(plain).aggregate([("v", "list")])
            for *key, values in zip(*(grouped.column(c).to_pylist() for c in [*plain, "v_list"])):
                held = states.setdefault(tuple(key), None)
                known = np.array([v for v in values if v is not None])
                if len(known):
                    new = aggregate.start(known)
                    states[tuple(key)] = new if held is None else aggregate.merge(held, new)
            if len(states) > MAX_HELD:
                yield batch_of(states, types)
                states = {}
        if states:
            yield batch_of(states, types)

    def merge(table: pa.Table) -> pa.Table:
        whole: State | None = None
        for state in table.column("state").to_pylist():
            if state is not None:
                whole = tuple(state) if whole is None else aggregate.merge(whole, tuple(state))
        end = pa.array([None if whole is None else aggregate.finish(whole)], pa.float64())
        return table.select(plain).slice(0, 1).append_column("whole", end)

    parts = rows.mapInArrow(partial, parts_schema)
    ends = parts.groupBy(*plain).applyInArrow(merge, whole_schema)
    return ends.select(*[F.col(p).alias(k) for p, k in zip(plain, keys)], F.col("whole").alias(name))


def _moments(values: np.ndarray) -> State:
    mean = float(values.mean())
    off = values - mean
    return float(len(values)), mean, float((off**2).sum()), float((off**3).sum())


def _merged_moments(a: State, b: State) -> State:
    (n, mean, two, three), (m, other, two_b, three_b) = a, b
    all_, gap = n + m, other - mean
    return (
        all_,
        mean + gap * m / all_,
        two + two_b + gap**2 * n * m / all_,
        three + three_b + gap**3 * n * m * (n - m) / all_**2 + 3 * gap * (n * two_b - m * two) / all_,
    )


#: Skewness of a population, from moments that merge without cancelling.
SKEWNESS = UserAggregate(
    4, _moments, _merged_moments, lambda s: None if s[2] == 0 else float(np.sqrt(s[0]) * s[3] / s[2] ** 1.5)
)
