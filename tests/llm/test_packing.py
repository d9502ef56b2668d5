import functools
import random
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from runledger.llm import packing
from runledger.llm.registered import LLM_QUERIES

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@functools.cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def placed(counts, capacity):
    """Contents of each sequence by the plan, checked for gaps and overlaps."""
    sequences = defaultdict(list)
    rows = sorted(packing.packing_plan(counts, capacity))
    for i, (length, rank, sequence, each, offset) in enumerate(rows):
        last = i + 1 == len(rows) or rows[i + 1][0] != length
        for r in range(rank, counts[length] if last else rows[i + 1][1]):
            n = r - rank
            sequences[sequence + n // each].append((offset + n % each * length, length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in pieces) <= 2
    assert Counter(x for s in sequences.values() for _, x in s) == Counter(counts)
    return sequences


@pytest.mark.parametrize("seed", range(40))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 64, 2048])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 7, 100, 1500])))
    sequences = placed(counts, capacity)
    least = -(-sum(k * n for k, n in counts.items()) // capacity)
    large = sum(n for k, n in counts.items() if 2 * k > capacity)
    assert max(least, large) <= len(sequences) <= max(least, large) * 11 / 9 + 1


def test_plan_of_common_lengths():
    placed({700: 1_000, 1400: 3, 650: 1_001, 5: 4_003, 2048: 7, 1: 50}, 2048)


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", "  a  b ", "a\n b", "a \n b", "don't  x  y", "é ü　 z  q", "<|endoftext|> x <|endoftext|>", "a <|endoftext|>b <|endoftext|>  <|endo", "<|endoftext|><|endoftext|>", "\x1c a \x1c", "a\r\n\r\n  b\t c", "x" * 5000, "12 3.4 ½ ²"],
)
def test_token_ids(text):
    assert packing.token_ids(PATH).of(text) == array("I", brute_ids(text)[:-1]).tobytes()


def test_names_as_ordinary_text():
    loaded = Tokenizer.from_file(PATH)
    loaded.encode_special_tokens = True
    text = "a <|endoftext|> b"
    assert packing.token_ids(PATH).of(text, names=False) == array("I", loaded.encode(text, add_special_tokens=False).ids).tobytes()


def test_memory_is_bounded():
    ids = packing.TokenIds(PATH)
    ids.of("a " + "long" * 500)
    for i in range(150):
        ids.of(" ".join(f"w{i * 1000 + k}" for k in range(1000)))
    held = sum(packing.ENTRY_BYTES + len(k) + len(v) for part in (ids, ids.older) for k, v in part.items())
    assert held <= 2 * packing.REMEMBERED_BYTES and len(ids.older) > 0


def test_forgets_but_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 3 * packing.ENTRY_BYTES + 50)
    ids = packing.TokenIds(PATH)
    text = "one two three four five one two six one seven two"
    for _ in range(3):
        assert ids.of(text) == array("I", brute_ids(text)[:-1]).tobytes()


def test_whole_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = LLM_QUERIES["op1_best_fit_packing"].run(spark, sf).collect()
    check(rows, docs, 2048)


def check(rows, docs, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc_id, text in docs.items():
        ids, at = brute_ids(text), 0
        for i, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at)
            assert r.length == capacity or i == 0
            own = array("I", ids[at : at + r.length]).tobytes()
            assert r.ids_crc32 == zlib.crc32(own)
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_edges(spark, frame):
    rows = [(1, None, 9), (2, "", 9), (None, "a b c", 9), (4, "w " * 3000, 9)] + [(5, "same text", 9)] * 40
    docs = frame(rows, "doc_id long, text string, sequence_id int")
    got = packing.pack_documents(docs, PATH, capacity=64, with_ids=True).collect()
    assert sum(r.length for r in got) == sum(len(brute_ids(t)) for _, t, _ in rows)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
