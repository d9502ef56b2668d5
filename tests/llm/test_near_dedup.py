import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from runledger.llm import near_dedup as nd
from runledger.llm.common import Words
from runledger.llm.registered import LLM_QUERIES


def shingles(text):
    """Labelled shingles in order."""
    w = (text or "").encode().split()
    if not w:
        return []
    s = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]
    seen = Counter()
    out = []
    for x in s:
        out.append((x, seen[x]))
        seen[x] += 1
    return out


def similarity(a, b):
    place = {x: i for i, x in enumerate(b)}
    order = [place[x] for x in a if x in place]
    if order == sorted(order):
        n = len(order)
    else:
        best = [0] * len(order)
        for i, p in enumerate(order):
            best[i] = 1 + max((best[k] for k in range(i) if order[k] < p), default=0)
        n = max(best)
    return n / (len(a) + len(b) - n)


def brute_classes(texts):
    """Least key reachable by links, by comparing whatever shares a shingle."""
    own = {d: shingles(t) for d, t in texts.items()}
    holders = defaultdict(set)
    for d, s in own.items():
        for x in s:
            holders[x].add(d)
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in own.items():
        shared = Counter(e for x in s for e in holders[x] if e < d)
        for e, n in shared.items():
            if n >= 0.8 * (len(s) + len(own[e]) - n) and similarity(own[e], s) >= 0.8:
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: find(d) for d in texts}


def test_whole_table(spark, sf):
    folder = sf.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = LLM_QUERIES["op3_order_minhash_near_dedup"].run(spark, folder).collect()
    want = brute_classes(texts)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len(set(want.values())) < len(want)


def test_shingles_are_labelled():
    texts = ["a b c d e a b c d e a b c d e", None, "x y", "", "a b c d e", "p q r s t u"]
    hashes, first = nd.labelled_shingles(Words(pa.array(texts)))
    assert list(np.diff(first)) == [len(shingles(t)) for t in texts]
    want = [x for t in texts for x in shingles(t)]
    by = defaultdict(set)
    for h, x in zip(hashes.tolist(), want):
        by[x].add(h)
    assert all(len(v) == 1 for v in by.values()) and len(set(hashes.tolist())) == len(by)


def test_aligned():
    a = np.array([5, 9, 1, 7, 3], np.uint64)
    assert nd.aligned(a, a, 0) == 5
    assert nd.aligned(a, a[::-1].copy(), 5) == 1
    assert nd.aligned(a, np.array([9, 5, 1, 3], np.uint64), 1) == 3
    assert nd.aligned(a, np.array([2], np.uint64), 9) == 0


def test_edges(spark, frame):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    moved = base[60:] + base[:60]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "one  two\n"), (6, " ".join(base)),
            (7, " ".join(near)), (8, " ".join(moved)), (8, " ".join(moved)), (None, "one two")]
    docs = frame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    got = {(r.doc_id, r.component_id) for r in nd.document_classes(docs).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 6), (8, 8), (None, 4)}
    kept = nd.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8]
    assert nd.document_classes(docs.limit(0)).count() == 0
    assert nd.distinct_documents(docs.limit(0)).count() == 0


def test_large_groups(spark):
    """Near copies of one text, many of them; some only through others."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    texts = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nd.document_classes(docs).collect()}
    assert got == brute_classes(texts)


def test_alike_but_unlinked(spark):
    """Moved passages share most buckets and do not align: a row and a class for each document."""
    one, two = (" ".join(f"{name}{i}" for i in range(100)) for name in "vw")
    docs = spark.createDataFrame([(1, f"{one} {two}"), (2, f"{two} {one}")], "doc_id long, text string")
    got = nd.document_classes(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (2, 2, True)]


def test_parities_bound_what_differs():
    """At any length, also the next shorter one's: never more bits than shingles that differ."""
    rng = np.random.default_rng(4)
    for n in [1, 2, 31, 32, 33, 64, 65, 400, 3000]:
        a = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        for kept in {0, n // 2, n * 9 // 10, n}:
            b = np.concatenate([a[:kept], rng.integers(0, 1 << 64, (n - kept) * 9 // 10 + 1, np.uint64, endpoint=False)])
            x, y = nd.parities(a), nd.parities(b)
            while len(x) != len(y):
                x, y = [z if len(z) <= min(len(x), len(y)) else z[: len(z) // 2] ^ z[len(z) // 2 :] for z in (x, y)]
            differ = len(a) + len(b) - 2 * kept
            bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert bits <= differ
            assert bits >= differ * 0.5 or kept < n // 2 or n < 400


def test_group_far_from_each_other(spark, monkeypatch):
    """Each is near a text that is not there, and few are near each other: hardly a pair is aligned."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for place in rng.sample(range(8, 192), 4):
            words[place] = f"x{i}.{place}"
        rows.append((i, " ".join(words)))
    # Links, one with a text of another length of parities.
    rows += [(200, rows[3][1] + " y1 y2 y3"), (201, rows[4][1].replace("w1 ", "z ")), (202, " ".join(rows[5][1].split()[12:]))]
    counted = []
    verified = nd.verified
    monkeypatch.setattr(nd, "verified", lambda pairs, *rest: counted.append(pairs.count()) or verified(pairs, *rest))
    monkeypatch.setattr(nd, "LEADER_ROUNDS", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nd.document_classes(docs).collect()}
    want = brute_classes(dict(rows))
    assert got == want and len(set(want.values())) < len(rows)
    assert sum(counted) < 5 * len(rows)
