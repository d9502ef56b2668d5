import math

import numpy as np

from runledger.llm import lattice
from runledger.llm.registered import LLM_QUERIES


def brute(rows, threshold=0.93):
    """Links and components by comparing all vectors of a label."""
    fit = {}
    for i, (v, label) in rows.items():
        if v and label is not None and None not in v and all(map(math.isfinite, v)) and any(v):
            fit[i] = (label, np.array(v, float) / np.linalg.norm(v))
    links = {i: set() for i in rows}
    for i, (a, x) in fit.items():
        for j, (b, y) in fit.items():
            if i < j and a == b and len(x) == len(y) and x @ y >= threshold:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in sorted(rows):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in component:
                component[k] = i
                todo += links[k]
    return {i: (len(links[i]), component[i]) for i in rows}


def planted(n=400, d=64, seed=1):
    rng = np.random.default_rng(seed)
    rows = {}
    for i in range(n):
        x = rng.normal(size=d)
        if i % 2 and i > 1:
            y = np.array(rows[i - 1][0])
            c = rng.uniform(0.9, 1.0)
            x -= x @ y / (y @ y) * y
            x = c * y / np.linalg.norm(y) + math.sqrt(1 - c * c) * x / np.linalg.norm(x)
        rows[i] = (x.astype(np.float32).tolist(), int((i // 2) % 3))
    return rows


def test_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice.nearest(x)
    for q in p:
        assert (np.allclose(q % 1, 0) or np.allclose(q % 1, 0.5)) and q.sum() % 2 == 0
    far = ((x - p) ** 2).sum(axis=1)
    around = ((x[:, None] - p[:, None] - lattice.minimal_vectors()) ** 2).sum(axis=2)
    assert (far <= around.min(axis=1) + 1e-9).all()
    assert lattice.minimal_vectors().shape == (240, 8)
    assert np.allclose((lattice.minimal_vectors() ** 2).sum(axis=1), 2)


def test_recall_of_planted_pairs(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, v, label) for i, (v, label) in rows.items()], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.vector_classes(docs).collect()}
    want = brute(rows)
    linked = [i for i in want if want[i][0]]
    assert len(linked) > 150
    assert sum(got[i] == want[i] for i in linked) >= 0.97 * len(linked)
    assert all(got[i][0] <= want[i][0] for i in want)


def test_whole_table(spark, sf):
    rows = {r.vec_id: (r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = LLM_QUERIES["op5_e8_lattice_near_dedup"].run(spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_edges(spark, frame):
    one, two = [1.0, 2.0, 3.0], [2.0, 4.0, 6.1]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 3, 1), (4, [float("nan"), 1.0, 1.0], 1), (5, [float("inf"), 1.0, 1.0], 1), (6, [None, 1.0, 1.0], 1),
            (7, one, None), (8, one, 1), (9, one, 1), (10, two, 1), (11, one, 2), (12, one + [0.0], 1), (13, [0.0, 0.0, 5.0], 1), (14, [-0.0, 0.0, 5.0], 1), (15, [1e30] * 3, 3), (16, [1e-30] * 3, 3)]
    docs = frame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.vector_classes(docs).collect()}
    alone = {i: (0, i) for i in (1, 2, 3, 4, 5, 6, 7, 11, 12)}
    assert got == alone | {8: (2, 8), 9: (2, 8), 10: (2, 8), 13: (1, 13), 14: (1, 13), 15: (1, 15), 16: (1, 15)}
    assert lattice.vector_classes(docs.limit(0)).count() == 0
