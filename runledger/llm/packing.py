"""Documents packed into training sequences of a fixed number of tokens.

Documents longer than a sequence are cut; the pieces are packed in two steps. Pieces over a
third of the capacity fit at most two to a sequence: the longest is matched greedily with the
longest that still fits beside it. The smaller ones, longest first, go each where it leaves
the smallest gap.

Both steps depend on lengths only, and there are at most ``capacity`` of these. So the plan is
made from the number of pieces of each length, a table of fixed size, and says which ranks of
a length go where. The rows themselves are tokenized, ranked and placed by Spark: ranks are
numbered within a salt of each length, and every salt begins where those before it end, so
that no length, however common, is one task's work.

Defined cases: a null or empty text is a document of no tokens (its end mark alone is packed);
repeated rows are packed as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import slices, stored

#: Pieces that one salt of a length holds, about, where there are many; and the least number of salts.
SALT_ROWS, LEAST_SALTS = 100_000, 256

#: Memory for chunks of text whose ids a worker remembers, in each of two generations: what an
#: entry takes besides its characters and ids, the total, and the longest chunk that is remembered.
ENTRY_BYTES, REMEMBERED_BYTES, LONGEST_REMEMBERED = 250, 32 << 20, 64

#: Fixed value: how the vocabulary splits text before merging.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_WHITE_AFTER_SPACE = re.compile(r" \s")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it prints, else as a letter from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenIds(dict):
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    No token spans a single space before a visible character, so a text is tokenized by the
    chunks between these, and the ids of common chunks are remembered. The vocabulary file is
    read once per worker. Names of added tokens in a text are those tokens.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        byte, vocabulary = _byte_of_char(), loaded["model"]["vocab"]
        names = {t["content"]: t["id"] for t in loaded.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in names}
        self.names = {name: array("I", [i]).tobytes() for name, i in names.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        #: The bytes of each id that ordinary text has.
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._encoded(" " + chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            size = ENTRY_BYTES + len(chunk) + len(ids)
            if self.held + size > REMEMBERED_BYTES:
                self.older, self.held = dict(self), 0
                self.clear()
            self.held += size
            self[chunk] = ids
        return ids

    def _encoded(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def of(self, text: str, names: bool = True) -> bytes:
        """Ids of a text; without ``names`` those of added tokens are ordinary text too."""
        if names and self.split and self.split.search(text):
            parts = self.split.split(text)
            return b"".join(self.names.get(part) or self._ordinary(part) for part in parts if part)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        chunks = text.split(" ")
        if text.endswith(" ") or _WHITE_AFTER_SPACE.search(text):
            joined = chunks[:1]
            for chunk in chunks[1:]:
                if chunk == "" or chunk[0].isspace():
                    joined[-1] += " " + chunk
                else:
                    joined.append(chunk)
            chunks = joined
        return self._encoded(chunks[0]) + b"".join(map(self.__getitem__, chunks[1:]))


@functools.lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    return TokenIds(path)


def document_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document, each document ended by id 0.

    ``vocabulary`` is a byte-level BPE file that every worker can read. Rows: doc_id, piece,
    start (ids before it), length, ids_crc32, and the ids themselves as bytes ``with_ids``.
    """
    end = array("I", [0]).tobytes()
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fields = [
        T.StructField("doc_id", kept.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = token_ids(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, value in enumerate(part.column("text").to_pylist()):
                    whole = ids_of.of(value or "") + end
                    n = len(whole) // 4
                    at, to = 0, n % capacity or min(n, capacity)
                    while at < n:
                        bytes_ = whole[4 * at : 4 * to]
                        row.append(i)
                        piece.append(0 if at == 0 else piece[-1] + 1)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(bytes_))
                        ids.append(bytes_)
                        at, to = to, to + capacity
                columns = [
                    part.column("doc_id").take(pa.array(row, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields][: len(columns)])

    return kept.mapInArrow(cut, T.StructType(fields if with_ids else fields[:-1]))


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go.

    A row (length, rank, sequence, each, offset): from this rank of the length on, pieces go
    ``each`` to a sequence, from this sequence on, the first of a sequence at this offset.
    """
    left = dict(counts)
    rank = dict.fromkeys(counts, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number)
    sizes: list[int] = []  # the gaps there are, ascending
    sequences = 0

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        rows.append((length, rank[length], sequence, each, offset))
        rank[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                insort(sizes, gap)
            gaps.setdefault(gap, []).append((sequence, n))

    large = sorted(x for x in left if 3 * x > capacity and left[x])
    while large:
        a = large[-1]
        at = bisect_right(large, capacity - a) - 1
        if at >= 0 and large[at] == a and left[a] == 1:
            at -= 1
        if at < 0:
            n, gap = left[a], capacity - a
            put(a, n, sequences, 1, 0)
        elif large[at] == a:
            n, gap = left[a] // 2, capacity - 2 * a
            put(a, 2 * n, sequences, 2, 0)
        else:
            b = large[at]
            n, gap = min(left[a], left[b]), capacity - a - b
            put(a, n, sequences, 1, 0)
            put(b, n, sequences, 1, a)
            if not left[b]:
                large.pop(at)
        if not left[a]:
            large.pop()
        leave(gap, sequences, n)
        sequences += n

    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(sizes, s)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first = capacity, sequences
                n = -(-left[s] // (capacity // s))
                sequences += n
            each = gap // s
            full = min(n, left[s] // each)
            if full:
                put(s, full * each, first, each, capacity - gap)
                leave(gap - each * s, first, full)
            if full < n and left[s]:
                last = left[s]
                put(s, last, first + full, last, capacity - gap)
                leave(gap - last * s, first + full, 1)
                full += 1
            leave(gap, first + full, n - full)
    return rows


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Sequence and offset of every piece, as added columns sequence_id and offset.

    ``pieces`` (as of ``document_pieces``) is read several times: give a stored table.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(LEAST_SALTS, -(-sum(counts.values()) // SALT_ROWS))
    key = [F.col(c) for c in ("doc_id", "piece", "ids_crc32")]
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*key), F.lit(salts)))
    begins = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
        .select("length", "salt", "before")
    )
    ranked = (
        salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*key)))
        .join(begins, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("rank") - 1)
        .select(*pieces.columns, "rank")
    )
    names = pieces.columns
    plan = np.array(sorted(packing_plan(counts, capacity)), np.int64).reshape(-1, 5)
    shift = np.int64(1 << 44)  # lengths are below 2**19, ranks below 2**44

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = plan[:, 0] * shift + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(begin, length * shift + rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return ranked.mapInArrow(place, T.StructType([*pieces.schema.fields, *added]))


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, with_ids: bool = False, **columns: str
) -> DataFrame:
    """Every document of a table in sequences of at most ``capacity`` tokens, a row per piece."""
    pieces = document_pieces(docs, vocabulary, capacity, with_ids=with_ids, **columns)
    return pack(stored(pieces, "pieces"), capacity)
