"""Near-duplicate documents by order min-hash over word shingles.

Shingles are five words, each labelled with its number of occurrence in the text, so that all
labelled shingles of a text differ. A sketch holds, for each of ``REPEATS`` hash functions, the
``PICKS`` shingles of least hash in the order they have in the text; texts agree there if
they share these shingles and their order, which is sensitive to edits and moves alike. Texts
that agree for one function share a bucket.

Similarity: shingles of both texts are aligned in order, within the band of places that the
threshold allows; aligned over all shingles of either text is the similarity, linked at 0.8
or more.

A bucket never emits all its pairs. Exact copies are one node. In each round every bucket
compares its members with one leader: the one with the smallest share of shingles that it has alone,
so the most typical, of those outside the components of earlier leaders. Components are formed, and
only members that are still apart from their leader's component go on with the next leader.
What is apart after ``LEADER_ROUNDS`` is compared pair by pair, across components only and in the
first bucket that the pair shares, so no pair that shares a bucket is lost and none comes twice. Shingles that no other candidate has bound what a text can have
in common with any; pairs whose bounds exclude the threshold are left out everywhere. Two texts of a
large group may each be near the rest and still far from each other: before the last comparison the
parities of both, bit by bit, bound what the pair has in common, so that of such a group hardly
any but the links are aligned.

Defined cases: texts without words (null, empty, blank) link with nothing; a text of fewer
than five words is one shingle of all of them; repeated rows are copies; a class is named by
its least document id (a null id only if there is no other); an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import WORD_SPLIT, Words, mixed, slices, stored, windows
from runledger.llm.components import extended

SHINGLE, SIMILARITY = 5, 0.8
REPEATS, PICKS = 16, 3
LEADER_ROUNDS = 4

#: Odd multipliers, one per hash function.
_FACTORS = mixed(np.arange(1, REPEATS + 1, dtype=np.uint64)) | np.uint64(1)


def node_of(text: Column) -> Column:
    """What exact copies share: a digest of the words; null for a text without words."""
    words = F.array_join(F.array_remove(F.split(text, WORD_SPLIT), ""), " ")
    return F.when(words != "", F.unhex(F.md5(words)))


def labelled_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the labelled shingles of all texts in order, and where each text's begin."""
    hashes = words.hashes()
    counts = np.diff(words.first)
    shingles = np.where(counts == 0, 0, np.maximum(counts - SHINGLE + 1, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    row = np.repeat(np.arange(len(counts)), shingles)
    at = np.arange(first[-1]) - first[row] + words.first[row]
    out = np.zeros(first[-1], np.uint64)
    long = counts[row] >= SHINGLE
    if long.any():
        out[long] = windows(hashes, SHINGLE)[at[long]]
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        out[first[i]] = windows(hashes[words.first[i] : words.first[i + 1]], counts[i])[0]
    own = mixed(out + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    new = np.ones(len(own), bool)
    new[1:] = own[order[1:]] != own[order[:-1]]
    nth = np.arange(len(own)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(own) else np.zeros(0, int)
    label = np.zeros(len(own), np.uint64)
    label[order] = nth
    return mixed(out + label * np.uint64(0xD6E8FEB86659FD93)), first


def sketch_keys(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bucket keys, one row per text that has shingles, one column per hash function."""
    full = np.flatnonzero(np.diff(first))
    begin = first[:-1][full]
    row = np.repeat(np.arange(len(full)), np.diff(first)[full])
    keys = np.zeros((len(full), REPEATS), np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k, factor in enumerate(_FACTORS if len(full) else ()):
        values = shingles * factor
        places = np.full((len(full), PICKS), len(shingles))
        for pick in range(PICKS):
            least = np.minimum.reduceat(values, begin)
            hit = np.flatnonzero((values == least[row]) & (values != top))[::-1]
            places[row[hit], pick] = hit
            values[hit] = top
        places.sort(axis=1)
        picked = np.append(shingles, np.uint64(0))[places]
        key = np.full(len(full), k, np.uint64)
        for pick in range(PICKS):
            key = mixed(key * np.uint64(0x9FB21C651E98DF25) + picked[:, pick])
        keys[:, k] = key
    return keys


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, node, shingles, keys) of each row of ``docs`` (doc_id, text)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("node", T.BinaryType()),
            T.StructField("shingles", T.LongType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = labelled_shingles(Words(part.column("text")))
                counts = np.diff(first)
                keys = iter(sketch_keys(shingles, first).view(np.int64).tolist())
                texts = part.column("text").to_pylist()
                nodes = [md5(b" ".join(t.encode().split())).digest() if n else None for t, n in zip(texts, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(nodes, pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array([next(keys) if n else None for n in counts], pa.list_(pa.int64())),
                    ],
                    schema.names,
                )

    return docs.mapInArrow(made, schema)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The most shingles that can be matched in order, places at most ``band`` apart."""
    order = np.argsort(b)
    at = np.searchsorted(b[order], a)
    at[at == len(b)] = 0
    place = order[at]
    mine = np.flatnonzero((b[place] == a) & (np.abs(place - np.arange(len(a))) <= band))
    place = place[mine]
    if len(place) < 2 or (place[1:] > place[:-1]).all():
        return len(place)
    ends: list[int] = []  # the least last place of an increasing run of each length
    for p in place.tolist():
        i = bisect_left(ends, p)
        ends[i : i + 1] = [p]
    return len(ends)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts (node, text) are similar enough."""
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                one, first = labelled_shingles(Words(part.column("text_a")))
                two, second = labelled_shingles(Words(part.column("text_b")))
                keep = []
                for i in range(part.num_rows):
                    x, y = one[first[i] : first[i + 1]], two[second[i] : second[i + 1]]
                    both = len(x) + len(y)
                    # Similar texts leave at most this many shingles out.
                    band = int(both * (1 - similarity) / (1 + similarity)) + 1
                    n = aligned(x, y, band)
                    keep.append(n >= similarity * (both - n) - 1e-9)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.select("a", "b", "text_a", "text_b").mapInArrow(check, pairs.schema)


#: Two numbers in place of a node, as those need no buffers of their own in an aggregation.
MARK = ("mark", "mark_2")


def _marks() -> list[Column]:
    return [F.xxhash64("node").alias(MARK[0]), F.xxhash64("node", F.lit(1)).alias(MARK[1])]


def _own_shingles(texts: DataFrame) -> DataFrame:
    """(MARK, own): how many shingles of each of ``texts`` none of the others has."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = labelled_shingles(Words(part.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*map(part.column, MARK), lists], [*MARK, "shingles"])

    return (
        texts.select(*_marks(), "text")
        .mapInArrow(listed, "mark long, mark_2 long, shingles array<long>")
        .select(*MARK, F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), *[F.max(m).alias(m) for m in MARK])
        .filter("n = 1")
        .groupBy(*MARK)
        .agg(F.count("*").alias("own"))
    )


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether each of 2 to 4 bits per shingle is hit an odd number of times, in 64-bit numbers.

    What two texts share cancels out, so at least as many shingles differ as bits do. The halves of a
    longer one, one xor the other, are the parities at half the length.
    """
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    hits = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _parities(texts: DataFrame) -> DataFrame:
    """(node, whole, half) of each of ``texts`` (node, text): its parities, and those at half the length."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                shingles, first = labelled_shingles(Words(part.column("text")))
                whole = [parities(shingles[first[i] : first[i + 1]]) for i in range(part.num_rows)]
                half = [x[: len(x) // 2] ^ x[len(x) // 2 :] if len(x) > 1 else x for x in whole]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (whole, half)]
                yield pa.RecordBatch.from_arrays([part.column("node"), *lists], ["node", "whole", "half"])

    return texts.select("node", "text").mapInArrow(made, "node binary, whole array<long>, half array<long>")


def _differing() -> Column:
    """At least how many shingles only one of both has, from parities at the shorter one's length."""
    longer = F.size("w_a") - F.size("w_b")
    one = F.when(longer > 0, F.col("h_a")).otherwise(F.col("w_a"))
    two = F.when(longer < 0, F.col("h_b")).otherwise(F.col("w_b"))
    bits = F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    # Lengths further apart have no parities of one length, and tell nothing.
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda n, x: n + x), F.lit(0))


def document_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, node, component_id, kept) of every row; kept is true for one id of each class."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(sketches(docs), "sketches")
    nodes = rows.filter(F.col("node").isNotNull()).dropDuplicates(["node"])
    bands = nodes.select("node", "shingles", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = stored(bands.join(shared, "key").distinct(), "members")
    texts = stored(
        docs.select(node_of(F.col("text")).alias("node"), "text")
        .filter(F.col("node").isNotNull())
        .dropDuplicates(["node"])
        .join(members.select("node").distinct(), "node", "left_semi"),
        "texts",
    )
    members = stored(
        members.select("*", *_marks())
        .join(_own_shingles(texts), list(MARK), "left")
        .withColumn("common", F.col("shingles") - F.coalesce("own", F.lit(0)))
        .filter(F.col("common") >= F.lit(similarity) * F.col("shingles") - 1e-9)
        .join(nodes.select("node", "keys"), "node")
        .select("node", "shingles", "common", "key", "keys"),
        "members",
    )
    # At most what both have in common with others is aligned.
    both = F.col("n_a") + F.col("n_b")

    def reachable(most: Column) -> Column:
        return most >= F.lit(similarity) * (both - most) - 1e-9

    close = reachable(F.least("c_a", "c_b"))
    pair = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    tested = labels = leaders = None
    for round_ in range(LEADER_ROUNDS + 1):
        of = members.withColumn("label", F.col("node"))
        if labels is not None:
            of = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        # Buckets of one component have nothing left to compare.
        open_ = of.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        of = stored(of.join(open_.filter("least != most").select("key"), "key"), "open")
        # Components only grow, so a bucket that is closed stays closed.
        members = of.drop("label")
        left = of.select("key", F.col("node").alias("x"), F.col("shingles").alias("n_a"), F.col("common").alias("c_a"), F.col("label").alias("l_a"), F.col("keys").alias("k_a"))
        right = of.select("key", F.col("node").alias("y"), F.col("shingles").alias("n_b"), F.col("common").alias("c_b"), F.col("label").alias("l_b"), F.col("keys").alias("k_b"))
        if round_ < LEADER_ROUNDS:
            left, right = left.drop("k_a"), right.drop("k_b")
            if leaders is not None:
                barred = leaders if labels is None else leaders.join(labels, "node", "left")
                barred = barred.select("key", F.coalesce("label" if labels is not None else "node", "node").alias("l_b"))
                right = right.join(barred.distinct(), ["key", "l_b"], "left_anti")
            draw = F.struct((1 - F.col("c_b") / F.col("n_b")).alias("alone"), F.xxhash64("y", "key").alias("h"), "y")
            right = right.join(right.groupBy("key").agg(F.min(draw).alias("first")).select("key", F.col("first.y").alias("y")), ["key", "y"])
            chosen = stored(right.select("key", F.col("y").alias("node")), "leaders")
            leaders = chosen if leaders is None else leaders.union(chosen)
            apart = F.col("l_a") != F.col("l_b")
        else:
            marks = stored(_parities(texts.join(of.select("node").distinct(), "node", "left_semi")), "parities")
            left = left.join(marks.toDF("x", "w_a", "h_a"), "x")
            right = right.join(marks.toDF("y", "w_b", "h_b"), "y")
            apart = (F.col("l_a") < F.col("l_b")) & (F.array_intersect("k_a", "k_b")[0] == F.col("key"))
            close = close & reachable((both - _differing()) / 2)
        pairs = left.join(right, "key").filter(apart & close).select(*pair).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if not pairs.isEmpty():
            found = stored(verified(pairs, texts, similarity), "found")
            tested = pairs if tested is None else tested.union(pairs)
            if not found.isEmpty():
                labels = extended(labels, found)
    grouped = rows.withColumn("label", F.col("node")) if labels is None else rows.join(labels, "node", "left")
    grouped = grouped.select("doc_id", "node", F.coalesce("label", "node").alias("class"))
    heads = grouped.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("head"))
    named = grouped.join(heads, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    return named.select(
        "doc_id", "node", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class"
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, and every row without words; same columns."""
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    whole = docs.select("doc_id", node_of(F.col("text")).alias("node"), row.alias("row"))
    # Of a class, the least (id, node); rows alike in both are copies.
    kept = (
        document_classes(docs)
        .filter("kept and class is not null")
        .groupBy("class")
        .agg(F.min("node").alias("node"), F.min("doc_id").alias("id"))
        .select("node", "id")
    )
    one = (
        whole.filter(F.col("node").isNotNull())
        .join(kept, "node")
        .filter(F.col("doc_id").eqNullSafe(F.col("id")))
        .dropDuplicates(["node"])
        .select("row")
    )
    blank = whole.filter(F.col("node").isNull()).select("row")
    return one.union(blank).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
