import random
import re
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from runledger.llm import prefix_trie as t
from runledger.llm.registered import LLM_QUERIES, TRIE_ORACLE

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, every=20, most=3):
    """Nodes of the trie from (conv_id, turn, role, text), turns told apart by ``turn``."""
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        whole[c] = tuple(own.get(c - c % every, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, below = {}, {}
    for node in members:
        children.setdefault(node, 0)
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves, total = below.get(node[:d], (0, 0))
            below[node[:d]] = (leaves + (children[node] == 0), total + saved)
    out = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), len(node), parent, len(convs), children[node], *below[node], sha256(ends.encode()).hexdigest()))
    return out


def trie(frame, rows):
    df = frame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r[c] for c in COLUMNS) for r in t.conversation_trie(df).collect()]
    assert len(set(got)) == len(got)
    return set(got)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    result = LLM_QUERIES["op13_prefix_trie"].run(spark, path)
    got = {tuple(r[c] for c in COLUMNS) for r in result.collect()}
    assert got == brute([tuple(r) for r in rows])
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{path}/conversations.parquet'")
    assert got == set(duck.execute(TRIE_ORACLE).fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_small_shards_and_slices(frame, monkeypatch, seed):
    """Heavy nodes several levels deep, one long conversation, many alike: cut everywhere."""
    for name, value in dict(LIGHT_TURNS=6, SHARD_TURNS=20, SLICE_TURNS=5, BROADCAST_NODES=seed * 1000, IDS_AT_ONCE=2).items():
        monkeypatch.setattr(t, name, value)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 120):
        if c % 3 == 0:  # alike from the first turn on
            turns = [("user", "same hello"), ("bot", "same answer here")] + [("user", rng.choice("ab"))] * rng.randint(0, 2)
        else:
            turns = [(rng.choice(["user", None, ""]), rng.choice(["a", "b c", "", None, " x\ty "])) for _ in range(rng.randint(1, 4))]
        rows += [(c, i if rng.random() < 0.95 or i else None, *turn) for i, turn in enumerate(turns)]
    rows += [(1000, i, "user", f"w{i % 3}") for i in range(60)] + [(1003, i, "user", f"w{i % 3}") for i in range(40)]
    assert trie(frame, rows) == brute(rows)


def test_edges(spark, frame):
    rows = [(3, 0, "a", "b"), (None, 0, "a", "b"), (3, None, None, None), (7, 0, "x", "y"), (-21, 1, "", "z z"), (40, 2, "r", "t")]
    wanted = [r if r[0] != -21 else (-21, 1, "", "z z") for r in rows]
    got = trie(frame, [r for r in rows if r[0] != -21])
    assert got == brute([r for r in wanted if r[0] != -21])
    # Repeated rows are turns of their own; other columns do not matter.
    twice = [(40, 1, "r", "t", 5)] * 3 + [(41, 1, "r", "long " * 50_000, 5)]
    df = frame(twice, "conv_id long, turn long, role string, text string, depth int")
    whole = t.conversation_trie(df)
    assert whole.count() == len(brute([(c, i, r, x) for i, (c, _, r, x, _) in enumerate(twice)]))
    empty = t.conversation_trie(df.limit(0))
    assert empty.count() == 0 and empty.columns == COLUMNS


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_slots(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, size=(2 * n, 2), dtype=np.uint64)
    table = t.PerfectSlots(keys[:n])
    assert sorted(table.of(keys[:n])) == list(range(n))
    assert (table.of(keys[n:]) == -1).all()
