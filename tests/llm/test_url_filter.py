import random

import duckdb
import pytest

from runledger.llm import registered
from runledger.llm.url_filter import Trie, host_and_path, judged_urls


def brute(host, path, rules):
    fits = [
        (len(h), len(p), v == "block", h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits else None


@pytest.mark.parametrize(
    ("url", "want"),
    [(None, ("", "")), ("", ("", "")), ("a.b/c", ("", "")), ("HTTP://A.b/C?d#e", ("a.b", "/C")), ("x://h", ("h", "")),
     ("x://h?q/r", ("h", "")), ("x://h#f", ("h", "")), ("x://y://z/", ("y:", "//z/")), ("://", ("", "")), ("a://É.Net/É", ("É.net", "/É"))],
)
def test_parts(url, want):
    assert host_and_path(url) == want


def made(rng):
    label = lambda: rng.choice(["a", "b", "net", "x"])
    host = ".".join(label() for _ in range(rng.randint(1, 3)))
    return host, "".join(rng.choice(["", "/", "/p", "/pq", "/p/"]) for _ in range(rng.randint(0, 3)))


def test_trie():
    rng = random.Random(1)
    for _ in range(200):
        rules = [(*made(rng), rng.choice(["allow", "block"])) for _ in range(rng.randint(0, 12))]
        trie = Trie(rules)
        for _ in range(20):
            host, path = made(rng)
            assert trie.longest(host, path) == brute(host, path, rules)


@pytest.mark.parametrize("most", [100, 0])
def test_both_ways(spark, frame, most):
    """By the trie, and by the join for more rules than it may hold."""
    rng = random.Random(2)
    rules = [(*made(rng), rng.choice(["allow", "block"])) for _ in range(15)]
    urls = ["http://{}{}?q".format(*made(rng)) for _ in range(300)] + [None, "", "none", "x://", None]
    pages = frame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, Verdict string")
    got = judged_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), max_rules=most)
    rows = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert rows == {i: brute(*host_and_path(u), rules) or (None, "allow") for i, u in enumerate(urls)}
    assert judged_urls(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string"), max_rules=most).count() == 0


def test_oracle(spark, sf):
    case = registered.LLM_QUERIES["op4_url_trie"]
    got = sorted(map(repr, map(tuple, case.run(spark, sf).collect())))
    connection = duckdb.connect()
    connection.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    assert got == sorted(map(repr, connection.execute(case.oracle).fetchall()))
