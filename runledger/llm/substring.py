"""Exact repeats of at least ``WIDTH`` words, found from fixed blocks and removed.

A window of ``WIDTH`` words holds a whole block of ``BLOCK`` words, wherever the blocks of its
document begin, as BLOCK is half of WIDTH, rounded up. So the index holds the non-overlapping
blocks of every document, and every rolling window of BLOCK words of every document probes it.
A block that occurs at two places is a hit for the documents of both; from hits, repeats are
extended: the windows of WIDTH words around a hit are compared by 96-bit hashes, and runs of
windows that occur twice are the maximal repeats.

Index and probes are 4-byte fingerprints in buckets, packed per chunk of documents, once per
document: a word of text costs some 4 bytes of shuffle, and a passage common to all documents
is one entry of each. A bucket is streamed past its blocks, never held. A fingerprint that is
equal by chance only adds windows to compare. Exact copies of a text are one text with a count.

Defined cases: a null or empty text has no words and the hash of the empty string; texts of
fewer than WIDTH words lose nothing; repeated rows repeat all their windows, so they lose
all words that are in one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import FIRST, SECOND, Words, batches_of, slices, stored, windows

WIDTH = 35

#: Words of the documents that share a chunk, about; buckets for each shuffle partition.
CHUNK_WORDS, BUCKETS_PER_PARTITION = 500_000, 4

#: Hits that a task holds before it hands them on, about, of 16 bytes each.
HITS_HELD = 1_000_000

#: Rows that a task's Python is handed at once: entries are some 16 kB each, hits of a chunk some MB.
BATCH_ROWS = 64


def _text_key(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "little", signed=True)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, packed) of each row: a number for the text, and the text compressed."""
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("packed", T.BinaryType())]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                keys = pa.array([_text_key(t) for t in texts], pa.int64())
                packed = pa.array([pack(t.encode()) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), keys, packed], schema.names)

    return docs.mapInArrow(made, schema)


def _unpacked(part: pa.RecordBatch) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(t).decode() for t in part.column("packed").to_pylist()], pa.large_string())


def _fingerprints(words: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and place in the row of every run of ``block`` words."""
    hashes = windows(words.hashes(), block)
    counts = np.diff(words.first)
    row = np.repeat(np.arange(len(counts)), np.maximum(counts - block + 1, 0))
    within = np.arange(len(row)) - np.concatenate([[0], np.cumsum(np.maximum(counts - block + 1, 0))])[row]
    return hashes[words.first[row] + within] if len(row) else np.zeros(0, np.uint64), row, within


def _packed_counts(counts: np.ndarray) -> bytes:
    """The bytes of a count, 1, 2, 4 or 8 as the largest needs, then the counts."""
    kind = np.min_scalar_type(counts.max())
    return bytes([kind.itemsize]) + counts.astype(kind).tobytes()


def _counts(packed: pa.Buffer) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1)


def _entries(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    """Packed rows: kind 0, the blocks of a chunk; 1, its probes; 2, its documents' keys."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "kind", "chunk", "counts", "prints"]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        keys: list[int] = []
        words_held, task, number = 0, TaskContext.get().partitionId(), 0

        def chunk() -> pa.RecordBatch:
            chunk_keys = np.array(keys, np.int64).tobytes()
            # With task and number, as chunks of copies only have the same keys.
            label = f"{task} {number} ".encode() + chunk_keys
            name = int.from_bytes(hashlib.md5(label).digest()[:8], "little", signed=True)
            prints = np.concatenate([h[0] for h in held])
            row = np.concatenate([h[1] for h in held])
            home = np.concatenate([h[2] for h in held])
            rows = {n: [] for n in names}

            def add(bucket: int, kind: int, counts: bytes, body: bytes) -> None:
                for n, v in zip(names, (bucket, kind, name, counts, body)):
                    rows[n].append(v)

            bucket = (prints >> np.uint64(32)) % np.uint64(buckets)
            low = prints.astype(np.uint32)
            # A document holds a print once, or twice for any larger number.
            order = np.lexsort((low, row, bucket))
            bucket, row, low, home = bucket[order], row[order], low[order], home[order]
            same = np.zeros(len(low), bool)
            same[1:] = (low[1:] == low[:-1]) & (row[1:] == row[:-1]) & (bucket[1:] == bucket[:-1])
            third = same.copy()
            third[1:] &= same[:-1]
            border = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in range(buckets):
                at = slice(border[b], border[b + 1])
                blocks = np.unique(low[at][home[at]])
                if len(blocks):
                    add(b, 0, b"", blocks.tobytes())
                keep = ~third[at]
                if keep.any():
                    add(b, 1, _packed_counts(np.bincount(row[at][keep], minlength=len(keys))), low[at][keep].tobytes())
            add(name % buckets, 2, b"", chunk_keys)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(names, types)], names)

        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                prints, row, within = _fingerprints(words, block)
                held.append((prints, row + len(keys), within % block == 0))
                keys += [_text_key(t or "") for t in part.column("text").to_pylist()]
                words_held += len(words.begin)
                if words_held >= CHUNK_WORDS or len(keys) >= 20_000:
                    yield chunk()
                    held, keys, words_held, number = [], [], 0, number + 1
        if keys:
            yield chunk()

    return docs.select("text").mapInArrow(packed, "bucket int, kind int, chunk long, counts binary, prints binary")


def _hits(entries: DataFrame, partitions: int) -> DataFrame:
    """(chunk, documents, prints, keys): prints that a block has and that occur twice, by chunk.

    The keys of a chunk's documents are a row of their own, from the same run over the documents,
    as another run may see them in another order.
    """
    names = ["chunk", "documents", "prints", "keys"]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []
        index = seen = None  # sorted prints of the bucket's blocks; occurrences so far, at most 2
        where = None  # chunk and document of an only occurrence
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # chunk, document and print of hits

        def rows() -> pa.RecordBatch:
            chunk, document, prints = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(chunk, kind="stable")
            chunks, begin = np.unique(chunk[order], return_index=True)
            begin = np.append(begin, len(order)) * 4
            bodies = (document[order].tobytes(), prints[order].tobytes())
            lists = [[body[i:j] for i, j in zip(begin, begin[1:])] for body in bodies]
            types = (pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(chunks), *[pa.array(x, t) for x, t in zip([*lists, [None] * len(chunks)], types)]], names
            )

        held = 0
        for batch in batches:
            heads: dict[int, bytes] = {}
            numbers = zip(*(batch.column(n).to_pylist() for n in ("bucket", "kind", "chunk")))
            for i, (bucket, kind, chunk) in enumerate(numbers):
                if kind == 2:
                    heads[chunk] = batch.column("prints")[i].as_py()
                    continue
                # A view of the batch, not a copy.
                prints = np.frombuffer(batch.column("prints")[i].as_buffer(), np.uint32)
                if bucket != now:
                    now, blocks, index = bucket, [], None
                if kind == 0:
                    blocks.append(prints.copy())
                    if len(blocks) >= 64:
                        blocks = [np.unique(np.concatenate(blocks))]
                    continue
                if index is None:
                    index = np.unique(np.concatenate([*blocks, np.zeros(0, np.uint32)]))
                    blocks, seen = [], np.zeros(len(index), np.uint8)
                    where = np.zeros(len(index), np.int64), np.zeros(len(index), np.int32)
                if not len(index):
                    continue
                at = np.searchsorted(index, prints)
                at[at == len(index)] = 0
                mine = np.flatnonzero(index[at] == prints)
                at = at[mine]
                counts = _counts(batch.column("counts")[i].as_buffer())
                document = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[mine]
                here = np.bincount(at, minlength=0)
                before = seen[at].copy()
                twice = (before > 0) | (here[at] > 1)
                # Occurrences that were alone until now.
                k = np.unique(at[twice & (before == 1)])
                if len(k):
                    found.append((where[0][k], where[1][k], index[k]))
                alone = ~twice
                where[0][at[alone]], where[1][at[alone]] = chunk, document[alone]
                seen[at] = np.where(twice, 2, 1)
                if twice.any():
                    hits = document[twice]
                    found.append((np.full(len(hits), chunk), hits, prints[mine][twice]))
                held += len(k) + int(twice.sum())
                if held >= HITS_HELD:
                    yield rows()
                    found, held = [], 0
            if heads:
                none = pa.nulls(len(heads), pa.binary())
                keys = pa.array(list(heads.values()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(heads), pa.int64()), none, none, keys], names)
        if found:
            yield rows()

    # The bucket is part of a print, so the same print of two buckets is not the same.
    return (
        entries.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(streamed, "chunk long, documents binary, prints binary, keys binary")
    )


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text of a chunk, copies in one; a chunk is as large as the task that made it held."""
    for batch in batches:
        for i in range(batch.num_rows):
            keys = batch.column("keys")[i].as_py()
            if keys is None:
                raise RuntimeError("hits of a chunk without its documents: a task that ran again saw them in another order")
            keys, which = np.unique(np.frombuffer(keys, np.int64), return_inverse=True)
            found = batch.column("found")[i].as_py()
            text = which[np.concatenate([np.frombuffer(f["documents"], np.int32) for f in found])]
            prints = np.concatenate([np.frombuffer(f["prints"], np.uint32) for f in found])
            order = np.argsort(text, kind="stable")
            own, border = np.unique(text[order], return_index=True)
            parts = np.split(prints[order], border[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[own]), pa.array([np.unique(p).tobytes() for p in parts], pa.binary())],
                ["key", "prints"],
            )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per key of rows in order of key: the prints of its copies, of which one set is held."""
    now, known = None, np.zeros(0, np.uint32)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([known.tobytes()], pa.binary())], ["key", "prints"])

    for batch in batches:
        for key, prints in zip(batch.column("key").to_pylist(), batch.column("prints")):
            prints = np.frombuffer(prints.as_buffer(), np.uint32)
            if key == now:
                if not np.array_equal(known, prints):
                    known = np.union1d(known, prints)
                continue
            if now is not None:
                yield row()
            now, known = key, prints.copy()
    if now is not None:
        yield row()


def _prints_of_texts(chunks: DataFrame, partitions: int) -> DataFrame:
    """(key, prints): the hits of each text once, however many copies it has, from (found, keys) of chunks."""
    return (
        chunks.select("found", "keys")
        .mapInArrow(_owned, "key long, prints binary")
        .repartition(partitions, "key")
        .sortWithinPartitions("key")
        .mapInArrow(_merged, "key long, prints binary")
    )


def repeated_places(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, places): of each text, where windows begin that begin somewhere else as well.

    ``docs`` has a column ``text``; keys are numbers of texts as in ``_keyed``.
    """
    spark = docs.sparkSession
    block = (width + 1) // 2
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * BUCKETS_PER_PARTITION
    entries = _entries(docs, block, buckets)
    with batches_of(spark, BATCH_ROWS):
        hits = stored(_hits(entries, partitions), "hits")

    pair = F.when(F.col("documents").isNotNull(), F.struct("documents", "prints"))
    chunks = hits.groupBy("chunk").agg(F.collect_list(pair).alias("found"), F.max("keys").alias("keys"))
    owners = _prints_of_texts(chunks.filter("size(found) > 0"), partitions)
    texts = _keyed(docs.select(F.lit(0).alias("doc_id"), "text")).groupBy("key").agg(
        F.count("*").alias("n"), F.first("packed").alias("packed")
    )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                words = Words(_unpacked(part))
                one, two = words.hashes(FIRST), words.hashes(SECOND)
                n = len(one) - width + 1
                if n <= 0:
                    continue
                known = np.frombuffer(part.column("prints")[0].as_py(), np.uint32)
                hit = np.flatnonzero(np.isin(windows(one, block).astype(np.uint32), known))
                # Windows that hold a hit begin up to width - block before it.
                cover = np.zeros(len(one) + 1, np.int64)
                np.add.at(cover, np.maximum(hit - (width - block), 0), 1)
                np.add.at(cover, hit + 1, -1)
                place = np.flatnonzero(np.cumsum(cover)[:n] > 0)
                if not len(place):
                    continue
                h = windows(one, width, FIRST)[place].view(np.int64)
                g = windows(two, width, SECOND)[place].astype(np.uint32).view(np.int32)
                # A window that the text itself repeats is one row with all its places.
                order = np.lexsort((place, g, h))
                h, g, place = h[order], g[order], place[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                begin = np.append(np.flatnonzero(new), len(h))
                copies = np.minimum(2, np.diff(begin) * part.column("n")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[new]),
                        pa.array(g[new]),
                        pa.array(np.full(len(copies), part.column("key")[0].as_py()), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(place, pa.int32())),
                        pa.array(copies, pa.int32()),
                    ],
                    ["h", "g", "key", "places", "n"],
                )

    dealt = (
        texts.join(owners, "key")
        .mapInArrow(candidates, "h long, g int, key long, places array<int>, n int")
        .repartition(partitions, "h", "g")
    )
    # Both uses read the same exchange; the join streams the many rows of a common window.
    repeats = dealt.groupBy("h", "g").agg(F.sum("n").alias("all")).filter("all > 1").select("h", "g")
    return dealt.join(repeats, ["h", "g"], "left_semi").groupBy("key").agg(
        F.flatten(F.collect_list("places")).alias("places")
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of each row; kept is the text that is left."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with batches_of(docs.sparkSession, BATCH_ROWS):
        places = stored(repeated_places(docs, width), "repeats")
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            n_words, n_removed, digests, kept = [], [], [], []
            for packed, begins in zip(batch.column("packed").to_pylist(), batch.column("places").to_pylist()):
                words = unpack(packed).split()
                gone = np.zeros(len(words) + 1, np.int64)
                if begins:
                    begins = np.array(begins)
                    np.add.at(gone, begins, 1)
                    np.add.at(gone, begins + width, -1)
                left = np.flatnonzero(np.cumsum(gone)[: len(words)] == 0)
                body = b" ".join([words[i] for i in left] if begins is not None else words)
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                digests.append(hashlib.sha256(body).hexdigest())
                kept.append(body.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                schema.names,
            )

    return _keyed(docs).join(places, "key", "left").select("doc_id", "packed", "places").mapInArrow(cut, schema)
