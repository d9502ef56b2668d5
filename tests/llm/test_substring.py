import hashlib
import random
from collections import Counter

import pytest

from runledger.llm import substring
from runledger.llm.registered import LLM_QUERIES


def brute(texts, width=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {k for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for k in range(i, i + width)}
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return out


def test_whole_table(spark, sf):
    folder = sf.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {d.doc_id: w for d, w in zip(docs, brute([d.text for d in docs]))}
    rows = LLM_QUERIES["op8_fixed_block_substrings"].run(spark, folder).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    assert len(rows) == len(docs) and sum(w[1] for w in want.values()) > 0


def test_edges(spark, frame):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(35)]
    texts = [None, "", " \n", "short text", " ".join(passage[:34]), " ".join(passage[:34])]
    texts += [" ".join([word() for _ in range(k)] + passage + [word() for _ in range(9)]) for k in range(40)]
    texts += [" ".join(passage[1:] + [word() for _ in range(60)]), "x " * 300, "y z " * 18, "\t".join(passage) + "\n end"]
    texts += [" ".join(word() for _ in range(80))] * 3
    body = [word() for _ in range(500)]
    texts += [" ".join(body), " ".join(body[:250] + ["changed"] + body[250:])]
    docs = frame([(i, t, i) for i, t in enumerate(texts)] + [(None, texts[-1], 0)], "doc_id long, text string, kept int", 5)
    want = {i: w for i, w in zip([*range(len(texts)), None], brute([*texts, texts[-1]]))}
    rows = substring.without_repeats(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in rows)
    assert substring.without_repeats(docs.limit(0)).count() == 0


def test_narrow_windows_over_many_chunks(spark, monkeypatch):
    """Few words, so repeats of all lengths; tiny chunks, so matches cross them."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for width in (8, 9):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.without_repeats(docs, width=width).collect()}
        assert got == dict(enumerate(brute(texts, width)))


@pytest.fixture
def conf(spark):
    """Sets a session setting until the test ends."""
    before = {}

    def put(key, value):
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def test_many_adjacent_copies(spark, monkeypatch, conf):
    """Chunks of copies only are told apart, and copies are one row of a chunk, not one each."""
    monkeypatch.setattr(substring, "CHUNK_WORDS", 2_000)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    rng = random.Random(9)
    copied = " ".join(f"w{rng.randrange(3000)}" for _ in range(100))
    other = " ".join(f"v{rng.randrange(3000)}" for _ in range(60)) + " " + copied[: len(copied) // 2]
    texts = [copied] * 600 + [other]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    heads = substring._entries(docs, 18, 16).filter("kind = 2").select("chunk", "prints").collect()
    assert len({h.chunk for h in heads}) == len(heads) > 20
    found = [{"documents": b"".join(i.to_bytes(4, "little") for i in range(50)), "prints": b"abcd" * 50}]
    chunks = [(found, bytes(8) * 50)] * 30
    schema = "found array<struct<documents: binary, prints: binary>>, keys binary"
    rows = substring._prints_of_texts(spark.createDataFrame(chunks, schema), 4).collect()
    assert [(r.key, r.prints) for r in rows] == [(0, b"abcd")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.without_repeats(docs).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_long_text_in_few_buckets(spark, conf):
    """More prints of a text in a bucket than 16 bits count."""
    conf("spark.sql.shuffle.partitions", "1")
    rng = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(50))
    long = " ".join(f"w{i}" for i in range(320_000))
    texts = ["short one", f"{long} {passage} {' '.join(f'z{i}' for i in range(100))}", f"{rng.random()} {passage} end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.without_repeats(docs).collect()}
    assert got == {0: (2, 0), 1: (320_150, 50), 2: (52, 50)}


def test_order_differs_between_runs(spark):
    """Documents that come in another order whenever they are read."""
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(20 + i % 9)) + " " + passage for i in range(200)]

    def mixed_up(batches):
        import os

        import pyarrow as pa

        for batch in batches:
            order = random.Random(os.urandom(8)).sample(range(batch.num_rows), batch.num_rows)
            yield batch.take(pa.array(order))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = substring.without_repeats(docs.mapInArrow(mixed_up, docs.schema)).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}
    assert got == dict(enumerate(brute(texts)))


def test_hits_are_handed_on(spark, monkeypatch, conf):
    """A task holds few hits and few rows at once, and all are found."""
    conf("spark.sql.shuffle.partitions", 2)
    rng = random.Random(8)
    passages = [[f"w{rng.randrange(900)}" for _ in range(60)] for _ in range(30)]
    texts = [" ".join(w for _ in range(6) for w in rng.choice(passages)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def hits():
        found = {}
        rows = substring._hits(substring._entries(docs.coalesce(1), 18, 8), 2).filter("keys is null").collect()
        for r in rows:
            pairs = (r.documents[i : i + 4] + r.prints[i : i + 4] for i in range(0, len(r.prints), 4))
            found.setdefault(r.chunk, Counter()).update(map(bytes, pairs))
        return found, len(rows)

    monkeypatch.setattr(substring, "CHUNK_WORDS", 10_000)
    whole, few = hits()
    monkeypatch.setattr(substring, "HITS_HELD", 100)
    same, many = hits()
    assert same == whole and many > few
    at_once = []
    stored, name = substring.stored, "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(substring, "stored", lambda df, purpose: at_once.append(int(spark.conf.get(name))) or stored(df, purpose))
    before = spark.conf.get(name)
    got = sorted(substring.without_repeats(docs).collect())
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in got] == brute(texts)
    assert at_once == [substring.BATCH_ROWS] * 2 and spark.conf.get(name) == before
