"""The pipeline, stage by stage, against what the stage's own operator should leave."""

from collections import Counter

import corpus_pipeline as pipeline

from test_mixing import brute_targets
from test_near_dedup import brute_classes
from test_pii import brute as brute_pii
from test_quality_rules import brute as brute_quality


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, tables = docs.columns, [docs.collect()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        tables.append(docs.collect())
        assert k == 4 or docs.columns == columns
    read, good, distinct, redacted, mixed, packed = tables
    assert set(good) <= {d for d in read if not brute_quality(d.text)[5]}
    clean = [d for d in read if not brute_quality(d.text)[5]]
    assert len(good) > 0.8 * len(clean)
    classes = brute_classes({d.doc_id: d.text for d in good})
    assert {d.doc_id for d in distinct} == set(classes.values())
    before = {d.doc_id: d.text for d in distinct}
    assert {d.doc_id for d in redacted} == set(before)
    for d in redacted:
        assert not brute_pii(d.text) and d.n_chars == len(d.text)
        assert d.text == before[d.doc_id] or any(f"<{k}>" in d.text for k in ("EMAIL", "IP", "CARD", "PHONE"))
    copies = Counter(d.doc_id for d in mixed)
    size = {d.doc_id: len(d.text.encode().split()) for d in redacted}
    sizes, taken = Counter(), Counter()
    for d in redacted:
        sizes[d.source] += size[d.doc_id]
        taken[d.source] += copies[d.doc_id] * size[d.doc_id]
    for source, target in brute_targets(sizes).items():
        shortest = min(size[d.doc_id] for d in redacted if d.source == source)
        assert abs(taken[source] - target) <= max(0.02 * target, shortest)
    assert max(copies.values()) <= 3
    once = {d.doc_id: d.text for d in redacted}
    firsts = Counter(p.doc_id for p in packed if p.piece == 0)
    assert firsts == copies
    assert len({(p.sequence_id, p.offset) for p in packed}) == len(packed)
    single = [p for p in packed if copies[p.doc_id] == 1]
    lengths = Counter()
    for p in packed:
        lengths[p.sequence_id] += p.length
    assert max(lengths.values()) <= 2048
    assert {p.doc_id for p in single} <= set(once)


def test_run(spark, sf):
    assert pipeline.run(spark, sf).count() > 0


def test_edges(spark, sf, tmp_path):
    """Null and empty texts, a null id and source, a repeated row, columns of other names; then nothing at all."""
    good = " ".join(f"word{i * i % 89} of" for i in range(60))
    rows = [
        (1, None, "en", "a", None, "x"), (2, "", "en", None, 0, "y"), (3, good, "en", "a", 9, None), (3, good, "en", "a", 9, None),
        (None, good + " more", None, "b", 9, "z"), (4, "mail a.b@c.de " + " ".join(f"other{i}" for i in range(40)), "en", "b", 9, "w"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `Base_spans` string"
    frame = spark.createDataFrame(rows, schema)
    for name, docs in (("rows", frame), ("none", frame.limit(0))):
        columns = docs.columns
        for k, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, sf)
            assert k == 4 or out.columns == columns
            out.write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
            if k == 0:
                kept = sorted((r.doc_id or 0, r.text is None) for r in docs.collect())
                assert kept == ([(0, False), (3, False), (3, False), (4, False)] if name == "rows" else [])
            if k == 1 and name == "rows":
                left = docs.collect()
                assert len(left) == 2 and any("other7" in r.text for r in left)
            if k == 2 and name == "rows":
                assert any("<EMAIL>" in r.text and r.n_chars == len(r.text) for r in docs.collect())
        assert (docs.count() > 0) == (name == "rows")
