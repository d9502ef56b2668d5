"""What the operators of this package share: staging, column names, words as arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from runledger.sources.shared import fresh_folder

#: Bytes of text that a Python task turns into arrays at once; a longer text is one slice.
SLICE_BYTES = 1 << 20

#: White space between words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends here."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs begun within hand tasks' Python at most so many rows at once, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_name(taken: Iterable[str], base: str) -> str:
    """A column name that no other column has, whatever its case."""
    used = {name.lower() for name in taken}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of at most ``SLICE_BYTES`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts in a row and where each begins, with the end; null is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Polynomial:
    """Hashes of runs of a sequence modulo 2**64, from running sums of value * base**index."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def runs(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of ``values[begin[i]:end[i]]`` for each i; equal runs have equal hashes."""
        n = len(values)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        return mixed((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


#: Two independent families; both together give 128 bits.
FIRST, SECOND = Polynomial(0x9E3779B97F4A7C15), Polynomial(0xD1342543DE82EF95)


class Words:
    """The words of several texts: ``first[i]:first[i + 1]`` are those of text i."""

    def __init__(self, column: pa.Array):
        self.data, rows = text_bytes(column)
        space = _IS_SPACE[self.data]
        begins, ends = ~space, ~space
        begins[1:] &= space[:-1]
        ends[:-1] &= space[1:]
        inner = rows[(rows > 0) & (rows < len(space))]
        begins[inner] = ~space[inner]
        ends[inner - 1] = ~space[inner - 1]
        self.begin = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, rows)

    def hashes(self, family: Polynomial = FIRST) -> np.ndarray:
        """One 64-bit hash per word; long texts are hashed a stretch at a time."""
        out = np.zeros(len(self.begin), np.uint64)
        at = 0
        while at < len(out):
            low = self.begin[at]
            to = max(at + 1, int(np.searchsorted(self.end, low + SLICE_BYTES, "right")))
            values = self.data[low : self.end[to - 1]].astype(np.uint64) + np.uint64(1)
            out[at:to] = family.runs(values, self.begin[at:to] - low, self.end[at:to] - low)
            at = to
        return out


def windows(hashes: np.ndarray, width: int, family: Polynomial = FIRST) -> np.ndarray:
    """A hash of each ``width`` consecutive items."""
    begin = np.arange(max(0, len(hashes) - width + 1))
    return family.runs(hashes, begin, begin + width)
