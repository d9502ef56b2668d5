"""Exact top-k inner products, by norm buckets.

Vectors are grouped by length: a bucket's lengths lie within a factor of ``STEP``. For a query
with a known lower bound on its k-th best product, a bucket whose longest vector is ``l`` can only
help with vectors whose cosine to the query is at least

    local threshold = bound / (length of the query * l).

Over one, the bucket is skipped. From ``COORDINATE_FROM`` on, vectors are pruned by coordinate:
on the query's largest coordinates, a unit vector of that cosine lies in a known interval, and
only vectors inside all of them are candidates. Below, intervals would hold nearly everything, and
vectors are pruned by length alone: those too short for the bound are left out. Products of
candidates are then computed exactly, and raise the bound for the buckets that follow.

Buckets are cut into blocks and queries into groups, so a task holds one group and one stripe of
blocks, whatever a bucket's size. First bounds come from the products with the ``SEEDS`` longest
vectors, a sample of fixed size; groups are made of queries of like bounds, so that a bucket is
sent only to the groups it can help. Scores that equal the bound stay in, so ties are whole.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do
rows without an id; of several vectors with one id the least takes part, so repeated rows count
once; shorter vectors are continued by zeros, and an empty one is all zeros; a vector of length
``LONGEST`` or more, whose products need not fit 64 bits, raises an error; an empty table, or one
vector alone, gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import stored

#: Lengths of a bucket, and bounds of a group, differ by this factor at most.
STEP = 1.1

#: Vectors of a block, blocks of a stripe, queries of a group, vectors that give the first bounds.
BLOCK_ROWS, STRIPE_BLOCKS, GROUP_ROWS, SEEDS = 2048, 8, 1024, 2048

#: The local threshold from which coordinates prune, and how many of them are looked at.
COORDINATE_FROM, COORDINATES = 0.9, 3

#: Products that are held at once.
HELD = 1 << 21

#: Products of vectors shorter than this fit 64 bits.
LONGEST = 3e9

_NO_BOUND = np.iinfo(np.int64).min


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale))))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of at most ``width`` whole numbers, continued by zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _packed(values: np.ndarray) -> tuple[int, bytes]:
    """The numbers in as few bytes each as hold them."""
    largest = np.abs(values).max(initial=0)
    size = next(s for s in (1, 2, 4, 8) if s == 8 or largest < 1 << (8 * s - 1))
    return size, values.astype(f"<i{size}").tobytes()


def _unpacked(size: int, data: bytes, width: int) -> np.ndarray:
    values = np.frombuffer(data, f"<i{size}").astype(np.int64)
    return values.reshape(-1, width) if width else values.reshape(-1, 0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    # Sums may wrap on the way; they end right, as vectors are shorter than LONGEST.
    return a @ b.T


def lengths(values: np.ndarray) -> np.ndarray:
    return np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))


class Block:
    """Vectors of one bucket, longest first, with what prunes them."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.length = lengths(values)
        self._unit: np.ndarray | None = None
        self._order: dict[int, np.ndarray] = {}

    def near(self, query: np.ndarray, threshold: float) -> np.ndarray:
        """Rows that may have a cosine of ``threshold`` or more to the unit vector ``query``."""
        if self._unit is None:
            self._unit = self.values / np.maximum(self.length, 1e-300)[:, None]
        best, intervals = None, []
        for f in np.argsort(-np.abs(query))[:COORDINATES].tolist():
            q = float(query[f])
            spread = math.sqrt(max(0.0, (1 - q * q) * (1 - threshold * threshold)))
            low = (-1.0 if q < -threshold else q * threshold - spread) - 1e-9
            high = (1.0 if q > threshold else q * threshold + spread) + 1e-9
            if f not in self._order:
                self._order[f] = np.argsort(self._unit[:, f])
            order = self._order[f]
            begin, end = np.searchsorted(self._unit[:, f], (low, high), sorter=order)
            intervals.append((f, low, high))
            if best is None or end - begin < len(best):
                best = order[begin:end]
        rows = np.arange(len(self.ids)) if best is None else best
        for f, low, high in intervals:
            at = self._unit[rows, f]
            rows = rows[(at >= low) & (at <= high)]
        return rows


class Best:
    """The k best of each query so far: scores descending, ties by id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, k: int):
        self.ids, self.values, self.k = ids, values, k
        self.length = lengths(values)
        self.bounds = bounds.copy()
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates for query ``q``; those below its bound are left out."""
        good = np.flatnonzero((scores >= self.bounds[q]) & (ids != self.ids[q]))
        if not len(good):
            return
        order = good[np.lexsort((ids[good], -scores[good]))[: self.k]]
        both = self.found[q] + [(-int(s), int(i)) for s, i in zip(scores[order], ids[order])]
        self.found[q] = sorted(both)[: self.k]
        if len(self.found[q]) == self.k:
            self.bounds[q] = max(self.bounds[q], -self.found[q][-1][0])

    def search(self, block: Block) -> None:
        longest = block.length.max(initial=0.0)
        reach = self.length * longest
        bounds = self.bounds.astype(np.float64)
        # All products are within +-reach; 1e-9 covers the rounding of lengths.
        open_ = bounds <= reach * (1 + 1e-9) + 1e-6
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach > 0, bounds / reach, -1.0)
        by_coordinate = np.flatnonzero(open_ & (local >= COORDINATE_FROM))
        for q in by_coordinate:
            threshold = min(float(local[q]), 1.0) - 1e-9
            rows = block.near(self.values[q] / self.length[q], threshold)
            if len(rows):
                self.offer(q, block.ids[rows], products(self.values[q : q + 1], block.values[rows])[0])
        by_length = np.flatnonzero(open_ & ~(local >= COORDINATE_FROM))
        at_once = max(1, HELD // max(1, len(block.ids)))
        for i in range(0, len(by_length), at_once):
            some = by_length[i : i + at_once]
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where((bounds[some] > 0) & (self.length[some] > 0), bounds[some] / self.length[some], 0.0)
            # Longest first: only so many are long enough for the least demanding of these queries.
            n = int(np.searchsorted(-block.length, -least.min() * (1 - 1e-9) + 1e-6, "right"))
            scores = products(self.values[some], block.values[:n])
            for row, q in enumerate(some):
                self.offer(q, block.ids[:n], scores[row])


def _numbered(df: DataFrame, bucket: str, rows: int, key: str) -> tuple[DataFrame, dict[int, range]]:
    """``df`` with a number ``part``: each bucket is dealt by hash into parts of about ``rows``.

    Buckets are powers of ``STEP`` between the least and the greatest double: a few thousand at
    most, and their counts are all that comes to the driver.
    """
    counts = df.groupBy(bucket).agg(F.count("*").alias("n")).collect()
    parts, at = {}, 0
    for row in sorted(counts):
        n = -(-row["n"] // rows)
        parts[row[bucket]] = range(at, at + n)
        at += n
    if not parts:
        return df.withColumn("part", F.lit(0)), parts
    pairs = [F.lit(x) for b, r in parts.items() for x in (b, r.start)]
    sizes = [F.lit(x) for b, r in parts.items() for x in (b, len(r))]
    first = F.element_at(F.create_map(*pairs), F.col(bucket))
    size = F.element_at(F.create_map(*sizes), F.col(bucket))
    return df.withColumn("part", (first + F.pmod(F.xxhash64(key), size)).cast("int")), parts


def _bucket(x: Column) -> Column:
    """The power of ``STEP`` below ``x``; for zero and less, one below all others."""
    return F.when(x > 0, F.floor(F.log(x) / math.log(STEP))).otherwise(-100_000).cast("int")


def top_products(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best others for each vector of which ``asked`` holds.

    ``vectors`` has vec_id and vector, whole numbers; ``asked`` is a condition on vec_id.
    """
    spark = vectors.sparkSession
    one = vectors.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    one = one.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("vector").alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = stored(one.withColumn("length", length).withColumn("bucket", _bucket(F.col("length"))), "vectors")
    result = "query_id long, vec_id long, score long"
    width, longest = rows.agg(F.max(F.size("v")), F.max("length")).first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    if longest >= LONGEST:
        raise OverflowError(f"a vector of length {longest:g}: its products may not fit 64 bits")
    seeds = rows.orderBy(F.desc("length"), F.xxhash64("vec_id")).limit(SEEDS).select("vec_id", "v").toArrow()
    seed_ids, seed_values = seeds["vec_id"].to_numpy(), _matrix(seeds["v"], width)

    def bounded(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = products(_matrix(part.column("v"), width), seed_values)
                own = part.column("vec_id").to_numpy()[:, None] == seed_ids
                scores[own] = _NO_BOUND
                bound = np.full(part.num_rows, _NO_BOUND)
                if scores.shape[1] >= k:
                    bound = np.partition(scores, -k, axis=1)[:, -k]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bound)], [*part.schema.names, "bound"])

    fields = [f for f in rows.schema.fields if f.name != "bucket"]
    queries = rows.filter(asked).drop("bucket")
    queries = queries.mapInArrow(bounded, T.StructType([*fields, T.StructField("bound", T.LongType())]))
    # What a bucket's longest vector must reach to help a query.
    queries = stored(queries.withColumn("need", _bucket(F.try_divide(F.col("bound").cast("double"), F.col("length")))), "queries")
    blocked, blocks = _numbered(rows, "bucket", BLOCK_ROWS, "vec_id")
    grouped, groups = _numbered(queries, "need", GROUP_ROWS, "vec_id")
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Groups are numbered from the least need on, so a bucket helps the first ones only.
    served = {b: max([r.stop for need, r in groups.items() if need <= b + 2], default=0) for b in blocks}
    n_stripes = -(-max(r.stop for r in blocks.values()) // STRIPE_BLOCKS)

    def pack(part: pa.Table) -> pa.Table:
        values, ids = _matrix(part["v"], width), part["vec_id"].to_numpy()
        order = np.lexsort((ids, -lengths(values)))
        size, data = _packed(values[order])
        bound = part["bound"].to_numpy()[order] if "bound" in part.column_names else np.zeros(0, np.int64)
        return pa.table(
            {
                "part": part["part"].slice(0, 1),
                "bucket": part["bucket"].slice(0, 1),
                "size": pa.array([size], pa.int32()),
                "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([data], pa.binary()),
                "bounds": pa.array([bound.astype("<i8").tobytes()], pa.binary()),
            }
        )

    packed = "part int, bucket int, size int, ids binary, data binary, bounds binary"
    helps = F.element_at(F.create_map(*[F.lit(x) for b, n in served.items() for x in (b, n)]), F.col("bucket"))
    vector_side = (
        blocked.select("vec_id", "v", "bucket", "part").groupBy("part").applyInArrow(pack, packed)
        .withColumn("stripe", F.floor(F.col("part") / STRIPE_BLOCKS).cast("int"))
        .withColumn("grp", F.explode(F.when(helps > 0, F.sequence(F.lit(0), helps - 1))))
        .withColumn("is_query", F.lit(False))
    )
    query_side = (
        grouped.select("vec_id", "v", "bound", F.col("need").alias("bucket"), "part").groupBy("part").applyInArrow(pack, packed)
        .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(n_stripes - 1))))
        .withColumn("grp", F.col("part"))
        .withColumn("is_query", F.lit(True))
    )

    def search(cell: pa.Table) -> pa.Table:
        rows_ = sorted(cell.to_pylist(), key=lambda r: (not r["is_query"], -r["bucket"], r["part"]))
        out: tuple[list[int], ...] = ([], [], [])
        if rows_[0]["is_query"]:
            q, *rest = rows_
            best = Best(
                np.frombuffer(q["ids"], "<i8"), _unpacked(q["size"], q["data"], width), np.frombuffer(q["bounds"], "<i8"), k
            )
            for r in rest:
                best.search(Block(np.frombuffer(r["ids"], "<i8"), _unpacked(r["size"], r["data"], width)))
            for query_id, found in zip(best.ids.tolist(), best.found):
                for score, vec_id in found:
                    for column, value in zip(out, (query_id, vec_id, -score)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    found = vector_side.unionByName(query_side).groupBy("grp", "stripe").applyInArrow(search, result)
    in_order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
