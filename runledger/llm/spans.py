"""Spans that tasks find in texts, as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import slices

Span = tuple[int, int, int]  # start, number of the kind, end: code points, end exclusive
Found = tuple[list[list[Span]], list[list[Span]]]

ADDED = ("base_spans", "all_spans")


def with_spans(docs: DataFrame, find: Callable[[list[str]], Found], kinds: tuple[str, ...], text: str) -> DataFrame:
    """``docs`` with base_spans and all_spans, arrays of (start, kind, end) by start, then kind.

    ``find`` gives, for a list of texts, the base spans of each and what is added to them.
    """
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    held = docs.select(row.alias("row"), F.col(text).alias("body"))
    integer, string = T.IntegerType(), T.StringType()
    span = T.ArrayType(
        T.StructType([T.StructField("start", integer), T.StructField("kind", string), T.StructField("end", integer)])
    )
    schema = T.StructType([held.schema["row"], *[T.StructField(c, span) for c in ADDED]])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def listed(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"start": b, "kind": kinds[k], "end": e} for b, k, e in s] for s in found], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                base, more = find([t or "" for t in part.column("body").to_pylist()])
                both = [sorted(x + y) for x, y in zip(base, more)]
                yield pa.RecordBatch.from_arrays([part.column("row"), listed(base), listed(both)], ["row", *ADDED])

    found = held.mapInArrow(run, schema)
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *ADDED)


def last_over(found: list[Span], places: Iterable[tuple[int, int]]) -> list[int | None]:
    """For each of ``places`` (begin, end; apart, in order) the kind of the last span that touches it.

    ``found`` is in order of start; both are walked once.
    """
    out: list[int | None] = []
    open_: list[Span] = []
    at = 0
    for begin, end in places:
        while at < len(found) and found[at][0] < end:
            open_.append(found[at])
            at += 1
        # What ends before this place touches no later one.
        while open_ and open_[-1][2] <= begin:
            open_.pop()
        out.append(open_[-1][1] if open_ else None)
    return out


def sample(docs: DataFrame, hint: Column, most: int, doc_id: str, text: str) -> DataFrame:
    """(draw, text) of at most ``most`` documents of which ``hint`` holds, the same ones every time."""
    draw = F.xxhash64(F.col(doc_id), F.col(text))
    hinted = docs.filter(hint).select(draw.alias("draw"), F.col(text).alias("text"))
    last = hinted.select("draw").distinct().orderBy("draw").limit(most).agg(F.max("draw")).first()[0]
    if last is None:
        return hinted.limit(0)
    return hinted.filter(F.col("draw") <= last).dropDuplicates(["draw"])


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
