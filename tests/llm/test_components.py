import random

from runledger.llm.components import components, extended


def brute(links):
    parent = {x: x for ab in links for x in ab}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    links = chain + [(7, 2000 + i) for i in range(200)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    frame = spark.createDataFrame(links, "a long, b long")
    assert dict(components(frame).collect()) == brute(links)
    more = [(7, 1030), (5000, 5001), (2003, 5001)]
    labels = extended(extended(None, frame), spark.createDataFrame(more, "a long, b long"))
    assert dict(labels.collect()) == brute(links + more)
    assert labels.count() == len(brute(links + more))
