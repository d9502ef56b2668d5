import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runledger.llm import quality_rules as q
from runledger.llm.registered import LLM_QUERIES


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_whole_table(spark, sf):
    folder = sf.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = LLM_QUERIES["op2_learned_decision_lists"].run(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.rule is None)
    quality = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect())
    good = [r for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if quality.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n ", "one", "a b c d e", "a b c d e a b c d e", "x " * 11, "l\nl\n\nl\r\n l",
     "é ü # $ <a> |", "a\x0bb\x0cc d", "q w e r t y q w e r t y q w e r t z" * 3, "\U0001f600 b"],
)
def test_statistics(spark, text):
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, N_words int")
    row = q.judge(docs, []).first()
    assert tuple(row[c] for c in (*q.COUNTS, "base_failed")) == brute(text)


def test_long_text(spark):
    text = " ".join(f"w{i % 9973}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert q.with_statistics(docs).first()["n_repeat_words"] == brute(text)[4]


def test_learns_a_list(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        # The bad ones pass the base rule: their words differ, but hold signs or digits.
        F.expr("case when id % 4 = 0 then concat_ws(' ', transform(sequence(1, 40), i -> concat('AB!#', lpad(i * (1 + id % 97), 4, '0')))) "
               "when id % 4 = 1 then concat_ws(' ', transform(sequence(1, 40), i -> cast(1000000 + i * (1 + id % 89) as string))) "
               "else concat_ws(' ', transform(sequence(1, 40), i -> concat('word', i * (id % 97)))) end").alias("text"),
    )
    labels = rows.select("doc_id", F.expr("if(id_ % 4 < 2, 0, 1)".replace("id_", "doc_id")).alias("quality"))
    rules = q.learn_rules(rows, labels)
    assert rules and all(1 <= len(rule) <= 4 for rule in rules)
    judged = q.judge(rows, rules)
    wrong = judged.filter((F.col("rule").isNull()) == (F.col("doc_id") % 4 < 2)).count()
    assert wrong == 0
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(spark, frame):
    docs = frame([(1, None, 1), (2, "a " * 20, 2), (None, "b c", 3), (2, "a " * 20, 2)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, None), (2, 0), (2, 1), (9, 1)], "doc_id long, quality int")
    assert q.learn_rules(docs, labels) == []
    assert q.kept_documents(docs, labels).columns == docs.columns
    assert q.kept_documents(docs, labels.limit(0)).count() == 0
    assert q.kept_documents(docs.limit(0), labels).count() == 0
