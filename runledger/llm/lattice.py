"""Near-duplicate embeddings by hashing to the E8 lattice.

A table projects unit vectors at random to a few blocks of eight dimensions and takes the
nearest point of the E8 lattice in each; the points are the vector's cell. A vector also probes
the cells that differ from its own in one block, by the minimal vectors of the lattice that lead
nearest to its projection. Vectors that meet in a cell of any table are candidates, and are
linked if their cosine, in double precision, is at least the threshold and their labels agree.

Equal vectors of a label are one node, so a vector with any number of copies is one row of
every join. Links between different vectors are all kept.

Measured on 64 dimensions (``tests/llm/test_lattice.py``): over 0.98 of all pairs right at a
cosine of 0.93 are found, and nearly all above 0.95.

Defined cases: a vector that is null, empty or zero, or holds a null or a number that is not
finite, or has no label, links with nothing; vectors of different lengths do not link;
repeated rows are vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import mixed, stored
from runledger.llm.components import components

THRESHOLD = 0.93

#: Tables, blocks of a cell, cells probed per block, and the side of a cell in projections.
TABLES, BLOCKS, PROBES, SIDE = 8, 2, 4, 1.9

#: Rows whose cells are computed at once.
ROWS = 2_000


@functools.cache
def minimal_vectors() -> np.ndarray:
    """The 240 lattice points nearest to zero."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-1, 1):
                for b in (-1, 1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        if bin(signs).count("1") % 2 == 0:
            out.append(np.array([-0.5 if signs >> k & 1 else 0.5 for k in range(8)]))
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points whose coordinates have an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=-1) % 2)
    worst = np.abs(off[odd]).argmax(axis=-1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point to each row of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=-1) < ((x - whole) ** 2).sum(axis=-1)
    return np.where(closer[:, None], half, whole)


def _block_hash(points: np.ndarray, block: int) -> np.ndarray:
    out = np.full(points.shape[:-1], block + 1, np.uint64)
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    for k in range(8):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + doubled[..., k])
    return out


@functools.lru_cache(maxsize=4)
def _projection(dimensions: int, tables: int, blocks: int) -> np.ndarray:
    """Random directions, the same in every task."""
    return np.random.default_rng(20240).normal(size=(dimensions, tables * blocks * 8))


def cells(unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, side: float = SIDE):
    """Hashes (rows, tables) of own cells, and (rows, tables, blocks * probes) of probed ones."""
    n = len(unit)
    x = (unit @ _projection(unit.shape[1], tables, blocks) / side).reshape(n, tables, blocks, 8)
    own = np.zeros((n, tables), np.uint64)
    parts = np.zeros((n, tables, blocks), np.uint64)
    moved = np.zeros((n, tables, blocks, probes), np.uint64)
    least = minimal_vectors()
    for t in range(tables):
        for b in range(blocks):
            at = x[:, t, b]
            point = nearest(at)
            toward = (at - point) @ least.T
            best = np.argpartition(-toward, probes, axis=1)[:, :probes]
            parts[:, t, b] = _block_hash(point, b)
            moved[:, t, b] = _block_hash(point[:, None] + least[best], b)
        own[:, t] = parts[:, t].sum(axis=1)
    probed = (own[:, :, None, None] - parts[:, :, :, None] + moved).reshape(n, tables, -1)
    salt = np.arange(1, tables + 1, dtype=np.uint64)
    return mixed(own + mixed(salt)), mixed(probed + mixed(salt)[None, :, None])


def _unit_rows(column: pa.Array, label: pa.Array) -> list[np.ndarray | None]:
    out: list[np.ndarray | None] = []
    for value, of in zip(column.to_pylist(), label.to_pylist()):
        vector = None
        if value and of is not None and None not in value:
            raw = np.array(value, float) + 0.0
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = raw / np.abs(raw).max() if np.abs(raw).max() > 0 else raw
            if np.isfinite(raw).all() and raw.any():
                vector = scaled / np.linalg.norm(scaled)
        out.append(vector)
    return out


def _hashed(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, node, vector, own, probed) of each row; null from node on if it cannot link."""
    schema = T.StructType(
        [
            vectors.schema["vec_id"],
            vectors.schema["label"],
            T.StructField("node", T.BinaryType()),
            T.StructField("vector", vectors.schema["embedding"].dataType),
            T.StructField("own", T.ArrayType(T.LongType())),
            T.StructField("probed", T.ArrayType(T.LongType())),
        ]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                units = _unit_rows(part.column("embedding"), part.column("label"))
                values, labels = part.column("embedding").to_pylist(), part.column("label").to_pylist()
                nodes, own, probed = ([None] * len(units) for _ in range(3))
                for size in {len(u) for u in units if u is not None}:
                    rows = [i for i, u in enumerate(units) if u is not None and len(u) == size]
                    mine, tried = cells(np.array([units[i] for i in rows]))
                    # Cells of different labels or lengths are different cells.
                    salt = [md5(repr((labels[i], size)).encode()).digest()[:8] for i in rows]
                    salt = np.frombuffer(b"".join(salt), np.uint64)
                    mine, tried = mixed(mine + salt[:, None]), mixed(tried + salt[:, None, None])
                    for k, i in enumerate(rows):
                        raw = (np.array(values[i], float) + 0.0).tobytes()
                        nodes[i] = md5(repr(labels[i]).encode() + b"|" + raw).digest()
                        own[i] = mine[k].view(np.int64).tolist()
                        probed[i] = tried[k].reshape(-1).view(np.int64).tolist()
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("label"),
                        pa.array(nodes, pa.binary()),
                        part.column("embedding"),
                        pa.array(own, longs),
                        pa.array(probed, longs),
                    ],
                    schema.names,
                )

    return vectors.mapInArrow(made, schema)


def similar_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between ``nodes`` (node, vector, own, probed) that meet in a cell."""
    home = nodes.select(F.col("node").alias("a"), F.explode("own").alias("cell"))
    tried = nodes.select(F.col("node").alias("b"), F.explode(F.concat("own", "probed")).alias("cell"))
    pairs = (
        home.join(tried, "cell")
        .filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    sides = pairs.join(
        nodes.select(F.col("node").alias("a"), F.col("label").alias("la"), F.col("vector").alias("va")), "a"
    ).join(nodes.select(F.col("node").alias("b"), F.col("label").alias("lb"), F.col("vector").alias("vb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for la, lb, x, y in zip(*(batch.column(c).to_pylist() for c in ("la", "lb", "va", "vb"))):
                fine = la == lb and len(x) == len(y)
                if fine:
                    x, y = np.array(x, float), np.array(y, float)
                    x, y = x / np.abs(x).max(), y / np.abs(y).max()
                    fine = float(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y)) >= threshold
                keep.append(fine)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.select("a", "b", "la", "lb", "va", "vb").mapInArrow(check, pairs.schema)


def vector_classes(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    rows = stored(_hashed(plain), "vectors")
    able = rows.filter(F.col("node").isNotNull())
    sizes = able.groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes = stored(able.select("node", "label", "vector", "own", "probed").dropDuplicates(["node"]), "nodes")
    links = stored(similar_pairs(nodes, threshold), "links")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = (
        both.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("m")), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("m").alias("m"))
    )
    labels = components(links)
    named = stored(
        sizes.join(around, "node", "left")
        .join(labels.withColumnRenamed("label", "class"), "node", "left")
        .select(
            "node",
            (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"),
            "first",
            F.coalesce("class", "node").alias("class"),
        ),
        "named",
    )
    heads = named.groupBy("class").agg(F.min("first").alias("component_id"))
    known = named.join(heads, "class").select("node", "n_links", "component_id")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "node")
        .join(known, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
