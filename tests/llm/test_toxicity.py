import numpy as np
import pytest

from runledger.llm import toxicity
from runledger.llm.registered import LLM_QUERIES


def test_held_out(spark, sf):
    """Learned on half of the labels, right on the other half."""
    folder = sf.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels.filter("xxhash64(doc_id) % 2 = 0"))
    rows = toxicity.with_severity(docs, model).join(labels.filter("xxhash64(doc_id) % 2 <> 0"), "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.grade == 0 for r in clean) >= 0.97 * len(clean)
    assert sum(r.grade == 1 for r in toxic) >= 0.6 * len(toxic)
    got = LLM_QUERIES["op7_ordinal_toxicity"].run(spark, folder)
    assert got.count() == docs.count()
    assert all(0 <= r.severity <= 1 and r.toxic == (r.severity >= 0.5) for r in got.collect())


def test_grades_in_order():
    """Four grades by one weight per word: thresholds ascend, likelihood beats shuffled grades."""
    rng = np.random.default_rng(4)
    true = np.array([0.0, 0.5, 1.5, 3.0])
    rows = [np.flatnonzero(rng.random(4) < 0.4) for _ in range(4000)]
    latent = np.array([true[r].sum() for r in rows]) + rng.logistic(size=4000)
    level = np.searchsorted([1.0, 2.0, 3.5], latent)
    weights, thresholds = toxicity._fit(rows, level, 4, 4, decay=1e-5, steps=1500)
    assert thresholds == sorted(thresholds)
    np.testing.assert_allclose(thresholds, [1.0, 2.0, 3.5], atol=0.3)
    np.testing.assert_allclose(weights, true, atol=0.3)


def test_edges(spark, frame):
    docs = frame([(1, None, 0.5), (2, "", 0.5), (2, "bad word", 0.5)], "doc_id long, text string, Severity double")
    labels = spark.createDataFrame([(1, None), (2, 1), (7, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.with_severity(docs, model).collect()
    assert len(rows) == 3 and all(r.grade == 1 for r in rows)
    assert toxicity.train(docs, labels.limit(0)).grades == [0]
    both = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert {r.grade for r in toxicity.with_severity(docs, toxicity.train(docs, both)).collect()} == {0}
    assert toxicity.with_severity(docs.limit(0), model).count() == 0


def test_severity():
    model = toxicity.Model({"bad": 3.0, "worse": 6.0}, [2.0, 5.0], [0, 1, 3])
    assert model.severity("fine")[1] == 0 and model.severity("Bad!")[1] == 1 and model.severity("worse bad")[1] == 3
    assert model.severity("bad")[0] == pytest.approx(1 / (1 + np.exp(-1)) + 2 / (1 + np.exp(2)))


def test_both_ways_and_no_cap(spark):
    """Thousands of words tell the grades apart, some of them for the low one; all are learned."""
    names = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(200):
        grade = i % 2
        own = names[:2900] if grade else names[2900:]
        rows.append((i, " ".join([*own, f"rare{i}", "common"]), grade))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.drop("toxic"), frame.drop("text"))
    assert set(model.weights) == set(names)
    assert all((model.weights[w] > 0) == (i < 2900) for i, w in enumerate(names))


def test_equals_brute_force(spark, sf):
    """Severity and grade of every document by a plain sum, a text of a megabyte included."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/labels.parquet")
    whole = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(whole, labels)
    assert model.weights
    long = " ".join(sorted(model.weights)) + " filler" * 150_000
    docs = docs.union(spark.createDataFrame([(-1, long)], docs.schema))
    texts = dict(docs.collect())
    got = toxicity.with_severity(docs, model).collect()
    assert len(got) == len(texts)
    for row in got:
        held = {w for w in toxicity._WORD.findall((texts[row.doc_id] or "").lower())}
        total = sum(weight for word, weight in model.weights.items() if word in held)
        above = [1 / (1 + np.exp(t - total)) for t in model.thresholds]
        expected = model.grades[0] + sum(p * (b - a) for p, a, b in zip(above, model.grades, model.grades[1:]))
        assert row.severity == pytest.approx(expected)
        assert row.grade == model.grades[sum(p >= 0.5 for p in above)]
