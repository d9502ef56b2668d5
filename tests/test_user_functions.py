import datetime
import random

import numpy as np
import pytest

from runledger.operators.overlaps import overlapping
from runledger.operators.user_aggregate import SKEWNESS, aggregated
from runledger.plans.registry import REGISTRY
from runledger.plans.user_functions import register_functions


def skewness(values):
    values = np.array([v for v in values if v is not None])
    if not len(values) or values.std() == 0:
        return None
    return float(((values - values.mean()) ** 3).mean() / values.std() ** 3)


def test_aggregate_merges_states(spark):
    """A key with most rows over many tasks, null keys, null values, one value, none."""
    rng = random.Random(1)
    rows = [("hot", 1, rng.lognormvariate(0, 1)) for _ in range(5000)]
    rows += [(rng.choice(["a", None]), rng.choice([1, None]), rng.choice([None, rng.random() + 1e6])) for _ in range(900)]
    rows += [("one", 1, 2.0), ("none", 1, None), ("same", 1, 3.0), ("same", 1, 3.0)]
    df = spark.createDataFrame(rows, "k string, j int, v double").repartition(16)
    got = {(r.k, r.j): r.s for r in aggregated(df, ["k", "j"], "v", SKEWNESS, "s").collect()}
    want = {key: skewness([v for k, j, v in rows if (k, j) == key]) for key in {r[:2] for r in rows}}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, abs=1e-6)), key
    assert aggregated(df.limit(0), ["k"], "v", SKEWNESS, "s").count() == 0


def test_aggregate_shuffles_states_only(spark, monkeypatch):
    import runledger.operators.user_aggregate as module

    monkeypatch.setattr(module, "MAX_HELD", 3)
    df = spark.range(0, 4000, 1, 8).selectExpr("id % 100 as k", "cast(id as double) as v")
    got = {r.k: r.s for r in aggregated(df, ["k"], "v", SKEWNESS, "s").collect()}
    assert len(got) == 100 and all(abs(s) < 1e-9 for s in got.values())


@pytest.mark.parametrize("slice_rows", [1_000_000, 50])
def test_overlaps(spark, slice_rows):
    """Against all pairs: spans that touch, spans of one instant, equal ones, and ones without time."""
    rng = random.Random(2)
    at = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=n)
    rows = []
    for i in range(400):
        begin = rng.randint(0, 300) if i % 3 else 150
        rows.append((i, i % 7, at(begin), at(begin + rng.choice([0, 0, 3, 40]))))
    rows += [(900, 0, None, at(3)), (901, 0, at(3), None), (902, 0, at(9), at(2))]
    df = spark.createDataFrame(rows, "id long, g int, begin timestamp_ntz, end timestamp_ntz")
    got = {r.id: r.n_overlapping for r in overlapping(df, ["id", "g"], slice_rows=slice_rows, max_slices=40).collect()}
    whole = [r for r in rows if r[2] is not None and r[3] is not None and r[2] <= r[3]]
    want = {r[0]: 0 for r in rows}
    for i, _, begin, end in whole:
        want[i] = sum(b <= end and e >= begin for _, _, b, e in whole) - 1
    assert got == want
    assert overlapping(df.limit(0), ["id", "g"]).count() == 0


def test_sessions(spark):
    register_functions(spark)
    at = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=n)
    rows = [("a", at(s)) for s in (5, 0, 16, 5, 26)] + [(None, at(1)), ("b", None), ("c", at(9))]
    spark.createDataFrame(rows, "name string, moment timestamp_ntz").createOrReplaceTempView("moments")
    got = spark.sql("select * from sessions(table(moments), 'name', 'moment', 10)").collect()
    assert [f.name for f in spark.sql("select * from sessions(table(moments), 'name', 'moment', 10)").schema] == [
        "name", "session", "begin", "end", "n_rows",
    ]
    want = {("a", 1, at(0), at(5), 3), ("a", 2, at(16), at(26), 2), (None, 1, at(1), at(1), 1), ("c", 1, at(9), at(9), 1)}
    assert {tuple(r) for r in got} == want and len(got) == 4
    with pytest.raises(Exception, match="sessions takes a table"):
        spark.sql("select * from sessions('moments', 'name', 'moment', 10)").collect()


def test_calls_per_row_are_dealt(spark, tmp_path):
    """One file, and every task of the table function has its share; repeated and null keys too."""
    rows = [(i % 300 or None, " ".join("abcd"[: i % 5]), i) for i in range(400)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = REGISTRY["udtf"].run(spark, str(tmp_path))
    want = sorted(((k or 0, w, len(w)) for k, name, _ in rows for w in name.split(" ")))
    assert sorted((r.p_partkey or 0, r.word, r.letters) for r in found.collect()) == want
    tasks = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(tasks) == 4 and min(tasks) > 0
    assert "BatchEvalPythonUDTF" in found._jdf.queryExecution().executedPlan().toString()
