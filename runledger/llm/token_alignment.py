"""Tokens of two vocabularies aligned over the bytes of each text.

Tokenizer A is a byte-level vocabulary, read with a space before the text; tokenizer B is a piece
vocabulary, which puts that space there by itself. Both cut the same bytes. Where a token of A and
one of B end together a group ends. An A and a B token are linked where their bytes overlap: every
stretch between two neighbouring ends, of either kind, lies in one token of each, and linked tokens
share exactly one such stretch. So the links of a text are its stretches.

No token of either kind goes on from a visible character into a space (of A by its pattern, of B
as its pieces show), so tokens, groups and links are those of the chunks between, one after the
other, and a worker remembers what common chunks give. A vocabulary with a piece that does go on is
asked for whole texts.

Rows are shuffled by their full text first, so each distinct text is tokenized and aligned once, in
one task, whatever the number of its copies, which are counted before the shuffle. The counts of id
pairs over the corpus are sums of links weighted by copies. Their table is bounded by the two
vocabularies, not by the corpus: up to ``BROADCAST_PAIRS`` rows it is broadcast, beyond it is
joined by pair; both give the same measures. Measures are then joined to the ids of documents.

Defined cases: a text that is null or empty, or whose tokens of either kind do not join to a space
and the text (such as one that holds the sign that B uses for spaces), has no tokens: all measures
are 0 and the groups empty. Repeated rows are documents of their own, with equal measures. An empty
table gives no rows. Names of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import slices, stored
from runledger.llm.packing import token_ids

#: Rows of the table of id pairs that are broadcast at most: 24 bytes of numbers each.
BROADCAST_PAIRS = 2_000_000

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

#: Fixed value: the sign that a piece vocabulary writes for a space.
PIECE_SPACE = "▁"


#: Memory for chunks that a worker remembers, in each of two generations: what an entry takes
#: besides its key, groups and links, the total, and the longest chunk that is remembered.
ENTRY_BYTES, REMEMBERED_BYTES, LONGEST_REMEMBERED = 330, 128 << 20, 64

_WHITE = re.compile(r"\s")
_WHITE_AFTER_SPACE = re.compile(r" \s")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")

#: What a stretch of text gives: tokens of A, groups, and its links as 64-bit numbers; None if its
#: tokens do not join to it.
Chunk = tuple[int, str, bytes] | None


class Pieces:
    """A piece vocabulary: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces_ = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(PIECE_SPACE, " ").encode()
            for i, piece in enumerate(pieces_)
        ]
        inside = re.compile(f"[^{PIECE_SPACE}]{PIECE_SPACE}")
        self.by_chunk = not any(inside.search(piece) for i, piece in enumerate(pieces_) if not self.model.is_byte(i))


class Aligner(dict):
    """Aligns texts, chunk by chunk; made once per worker."""

    def __init__(self, byte_path: str, piece_path: str):
        super().__init__()
        self.a, self.b = token_ids(byte_path), Pieces(piece_path)
        self.n_b = len(self.b.tokens)
        self.older: dict[str, Chunk] = {}
        self.held = 0

    def __missing__(self, chunk: str) -> Chunk:
        return self._kept(chunk, self.older[chunk] if chunk in self.older else self.aligned(chunk))

    def _kept(self, chunk: str, found: Chunk) -> Chunk:
        if len(chunk) <= LONGEST_REMEMBERED:
            size = ENTRY_BYTES + len(chunk) + (len(found[1]) + len(found[2]) if found else 0)
            if self.held + size > REMEMBERED_BYTES:
                self.older, self.held = dict(self), 0
                self.clear()
            self.held += size
            self[chunk] = found
        return found

    def learn(self, chunks: set[str]) -> None:
        """Align the new ones of ``chunks`` that have no white space, all at once."""
        new = [c for c in chunks if c not in self and c not in self.older and c and not _WHITE.search(c)]
        whole = (" " + " ".join(new)).encode("utf-8", "surrogatepass")
        if not new or not self.b.by_chunk:
            return
        a = np.array(self.a.encoding.encode_ordinary(" " + " ".join(new)))
        b = np.array(self.b.model.encode(" ".join(new), num_threads=1))
        a_tokens, b_tokens = ([v.tokens[i] for i in ids.tolist()] for v, ids in ((self.a, a), (self.b, b)))
        if b"".join(a_tokens) != whole or b"".join(b_tokens) != whole:
            return  # one by one then
        a_ends, b_ends = (np.cumsum([len(t) for t in tokens]) for tokens in (a_tokens, b_tokens))
        common, ends = np.intersect1d(a_ends, b_ends, assume_unique=True), np.union1d(a_ends, b_ends)
        links = (a[np.searchsorted(a_ends, ends)] * self.n_b + b[np.searchsorted(b_ends, ends)]).astype(np.int64)
        # In a group the tokens of A come first: a token stands after those of its own kind before
        # it and those of the other kind that earlier groups, for B its own too, have.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        named = np.empty(len(a) + len(b), object)
        for own, at, last, end in (
            (a, np.searchsorted(b_group, a_group), common[a_group] == a_ends, "|"),
            (b, np.searchsorted(a_group, b_group, "right"), common[b_group] == b_ends, ";"),
        ):
            names = [f"{i}{end}" if e else f"{i}," for i, e in zip(own.tolist(), last.tolist())]
            named[np.arange(len(own)) + at] = names
        chunk_ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) + 1 for c in new])
        to_a, to_b, to_link = (np.searchsorted(x, chunk_ends, "right").tolist() for x in (a_ends, b_ends, ends))
        named, links = named.tolist(), links.tobytes()
        from_a = from_b = from_link = 0
        for chunk, n_a, n_b, n_link in zip(new, to_a, to_b, to_link):
            groups = "".join(named[from_a + from_b : n_a + n_b])[:-1]
            self._kept(chunk, (n_a - from_a, groups, links[8 * from_link : 8 * n_link]))
            from_a, from_b, from_link = n_a, n_b, n_link

    def aligned(self, chunk: str) -> Chunk:
        """What a chunk without the space before it gives, of which A is told and B is not."""
        whole = (" " + chunk).encode("utf-8", "surrogatepass")
        a = self.a.encoding.encode_ordinary(" " + chunk)
        b = self.b.model.encode(chunk, num_threads=1)
        a_tokens, b_tokens = [self.a.tokens[i] for i in a], [self.b.tokens[i] for i in b]
        if b"".join(a_tokens) != whole or b"".join(b_tokens) != whole:
            return None
        groups, links = [], array("q")
        i = j = i_first = j_first = 0
        i_end, j_end = len(a_tokens[0]), len(b_tokens[0])
        while True:
            links.append(a[i] * self.n_b + b[j])
            step_a, step_b = i_end <= j_end, j_end <= i_end
            i, j = i + step_a, j + step_b
            if step_a and step_b:
                groups.append(f"{','.join(map(str, a[i_first:i]))}|{','.join(map(str, b[j_first:j]))}")
                i_first, j_first = i, j
                if i == len(a):
                    return len(a), ";".join(groups), links.tobytes()
            if step_a:
                i_end += len(a_tokens[i])
            if step_b:
                j_end += len(b_tokens[j])

    def chunks(self, text: str) -> list[str]:
        """The text in chunks, each without the space that begins it."""
        if not self.b.by_chunk:
            return [text]
        if not text.endswith(" ") and not text.startswith(" ") and not _WHITE_AFTER_SPACE.search(text):
            return text.split(" ")
        parts = _BEFORE_SPACE.split(" " + text)
        if len(parts) > 1 and parts[-1] == " ":
            parts[-2:] = [parts[-2] + " "]
        return [part[1:] for part in parts]

    def texts(self, texts: list[str | None]) -> list[Chunk]:
        """The same for whole texts."""
        chunked = [self.chunks(text) if text else [] for text in texts]
        self.learn(set().union(*chunked))
        out = []
        for chunks in chunked:
            found = list(map(self.__getitem__, chunks))
            if not found or None in found:
                out.append(None)
                continue
            counts, groups, links = zip(*found)
            out.append((sum(counts), ";".join(groups), b"".join(links)))
        return out


@functools.lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def _counted(links: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers of each row, one row after the other, how often each comes, and how many."""
    values = np.frombuffer(b"".join(links), np.int64)
    row = np.repeat(np.arange(len(links)), [len(x) // 8 for x in links])
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    first = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (row[1:] != row[:-1]))[: len(values)])
    return values[first], np.diff(np.append(first, len(values))), np.bincount(row[first], minlength=len(links))


def aligned_texts(texts: DataFrame, byte_path: str, piece_path: str, with_groups: bool = False) -> DataFrame:
    """What one text alone tells, a row for each of ``texts`` (key, text, copies).

    Columns: key, copies, n_a, n_b, n_groups, n_links, groups_sha256, the linked pairs as the lists
    a_ids, b_ids and times, and the groups themselves ``with_groups``.
    """
    ids, longs = T.ArrayType(T.IntegerType(), False), [T.StructField(m, T.LongType()) for m in MEASURES[:4]]
    fields = [
        T.StructField("key", T.BinaryType()), T.StructField("copies", T.LongType()), *longs,
        T.StructField("groups_sha256", T.StringType()), T.StructField("a_ids", ids), T.StructField("b_ids", ids),
        T.StructField("times", ids), *[T.StructField("groups", T.StringType())] * with_groups,
    ]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_path, piece_path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [found or (0, "", b"") for found in own.texts(part.column("text").to_pylist())]
                n_a, groups, links = (np.array([r[0] for r in rows]), [r[1] for r in rows], [r[2] for r in rows])
                n_groups = np.array([g.count(";") + 1 if g else 0 for g in groups])
                n_links = np.array([len(x) // 8 for x in links])
                # Every token but the last of a group ends one link, the last of both kinds one more.
                counts = [pa.array(c, pa.int64()) for c in (n_a, n_links + n_groups - n_a, n_groups, n_links)]
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                pairs, times, sizes = _counted(links)
                first = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(first, pa.array(values.astype(np.int32)))
                    for values in (pairs // own.n_b, pairs % own.n_b, times)
                ]
                text_of = [pa.array(groups, pa.string())] if with_groups else []
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("copies"), *counts, pa.array(digest, pa.string()), *lists, *text_of],
                    [f.name for f in fields],
                )

    return texts.select("key", "copies", "text").mapInArrow(align, T.StructType(fields))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, links, is_best): links of each id pair over the corpus; whether its B id has no higher."""
    one = aligned.select("copies", F.explode(F.arrays_zip("a_ids", "b_ids", "times")).alias("l"))
    counts = one.groupBy(_pair("l.a_ids", "l.b_ids").alias("pair")).agg(F.sum(F.col("l.times") * F.col("copies")).alias("links"))
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pairs")
    best = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(best, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("is_best"))


def _pair(a: str, b: str):
    return F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b).cast("long"))


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False
) -> DataFrame:
    """(doc_id, the six measures, groups_sha256) of every row; groups too ``with_groups``."""
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = F.unhex(F.md5("text"))
    distinct = (
        held.filter(F.col("text") != "").groupBy("text").agg(F.count("*").alias("copies")).withColumn("key", key)
    )
    aligned = stored(aligned_texts(distinct, byte_path, piece_path, with_groups), "aligned")
    # Written once, so that its size can be told before it is sent anywhere.
    counts = stored(pair_counts(aligned), "counts")
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    links = aligned.select("key", F.explode(F.arrays_zip("a_ids", "b_ids", "times")).alias("l"))
    links = links.select("key", _pair("l.a_ids", "l.b_ids").alias("pair"), F.col("l.times").alias("times"))
    scored = (
        links.join(counts, "pair")
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("links")).alias("count_sum"),
        )
    )
    own = ["groups_sha256", *["groups"] * with_groups]
    measures = stored(aligned.select("key", *MEASURES[:4], *own).join(scored, "key", "left"), "measures")
    return (
        held.select("doc_id", F.when(F.col("text") != "", key).alias("key"))
        .join(measures, "key", "left")
        .select("doc_id", *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES], *[F.coalesce(c, F.lit("")).alias(c) for c in own])
    )
