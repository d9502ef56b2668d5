from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runledger.operators import run_log
from runledger.operators.batch import _RunLog, batch_outcomes, run_batch
from runledger.operators.run_log import LOG_COLUMNS, compact, read_run_log, stream_run_log
from runledger.operators.run_status import final_outcome
from runledger.sources.shared import fresh_folder
from runledger.streaming.sinks import append_available, read_updates, update_available


def n_files(path):
    return [len(list(Path(path, folder).glob("*.parquet"))) for folder in ("", "closed-1", "closed-2")]


def write_entries(spark, path, first, last, batch="a"):
    """Entries of seqs ``first`` to ``last``, each a file: SUBMITTED and FINISHED in turn."""
    known = {
        "seq": F.col("id"),
        "run_id": F.expr("(id - 1) div 2"),
        "ts": F.timestamp_seconds("id"),
        "state": F.expr("if(id % 2 = 1, 'SUBMITTED', 'FINISHED')"),
        "batch_id": F.lit(batch),
    }
    rows = spark.range(first, last + 1, 1, 1)
    rows = rows.select(*[known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in LOG_COLUMNS.items()])
    rows.write.option("maxRecordsPerFile", 1).mode("append").parquet(path)


def seqs(rows):
    return sorted(r.seq for r in rows.select("seq").collect())


def test_files_stay_few(spark):
    """After every round all readers agree: a new one, one from before the round, a stream."""
    log, out, marks = (fresh_folder(spark, name) for name in ("log", "out", "marks"))
    ended, ended_marks = fresh_folder(spark, "ended"), fresh_folder(spark, "ended-marks")
    last = 0
    for round_ in range(9):
        write_entries(spark, log, last + 1, last + 4)
        last += 4
        before = read_run_log(spark, log)
        compact(spark, log, every=4)
        assert seqs(before) == seqs(read_run_log(spark, log)) == list(range(1, last + 1))
        if round_ % 4 == 2:
            append_available(stream_run_log(spark, log), out, marks).awaitTermination()
            assert seqs(spark.read.parquet(out)) == list(range(1, last + 1))
    entries, closed, full = n_files(log)
    assert entries <= 8 and closed <= 8 and full == 9 // 4
    stream = update_available(final_outcome(stream_run_log(spark, log)), ended, ended_marks)
    stream.awaitTermination()
    assert read_updates(spark, ended).count() == final_outcome(read_run_log(spark, log)).count() == 18


def test_stream_that_fell_behind(spark):
    """Entries whose files went before the stream saw them come from their copies, once."""
    log, out, marks = (fresh_folder(spark, name) for name in ("log", "out", "marks"))
    write_entries(spark, log, 1, 3)
    append_available(stream_run_log(spark, log), out, marks).awaitTermination()
    for first in range(4, 20, 4):
        write_entries(spark, log, first, first + 3)
        compact(spark, log, every=4)
    append_available(stream_run_log(spark, log), out, marks).awaitTermination()
    assert seqs(spark.read.parquet(out)) == list(range(1, 20))


@pytest.mark.parametrize("lost", ["before copying", "before deleting"])
def test_round_that_ended_half_way(spark, monkeypatch, lost):
    log = fresh_folder(spark, "log")
    write_entries(spark, log, 1, 4)
    compact(spark, log, every=4)
    write_entries(spark, log, 5, 8)
    write_entries(spark, log, 1, 2, batch="b")

    def stop(spark, files):
        if lost == "before copying":
            delete(spark, files)
        raise RuntimeError("lost")

    delete = run_log._delete
    monkeypatch.setattr(run_log, "_delete", stop)
    with pytest.raises(RuntimeError):
        compact(spark, log, every=4)
    monkeypatch.undo()
    every = sorted([*range(1, 9), 1, 2])
    assert seqs(read_run_log(spark, log)) == every
    for _ in range(2):
        compact(spark, log, every=4)
        assert seqs(read_run_log(spark, log)) == every
    assert n_files(log)[0] == 0


def test_two_rounds_at_once(spark, monkeypatch):
    """Both copy the same entries, as neither sees the other's copy."""
    log = fresh_folder(spark, "log")
    write_entries(spark, log, 1, 4)
    exists = run_log.log_exists
    for _ in range(2):
        monkeypatch.setattr(run_log, "log_exists", lambda s, p: not p.endswith("closed-1") and exists(s, p))
        compact(spark, log, every=4)
    monkeypatch.undo()
    assert n_files(log)[:2] == [4, 2] and seqs(read_run_log(spark, log)) == [1, 2, 3, 4]
    compact(spark, log, every=4)
    assert n_files(log)[0] == 0 and seqs(read_run_log(spark, log)) == [1, 2, 3, 4]


def test_batch_compacts(spark, tmp_path):
    """A batch left and begun again over a compacted log runs nothing twice."""
    statements = spark.range(6).selectExpr("id as stmt_id", "concat('select ', id, ' as a') as sql")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    begun = batch_outcomes(spark, statements, log, out, compact_every=2)
    for _ in range(4):
        next(begun)
    begun.close()
    later = run_batch(spark, statements, log, out, resume=True, compact_every=2)
    assert [o.run_id for o in later] == [4, 5]
    assert seqs(read_run_log(spark, log)) == list(range(1, 13))
    assert final_outcome(read_run_log(spark, log)).filter("outcome = 'FINISHED'").count() == 6
    entries, closed, full = n_files(log)
    assert entries <= 4 and closed <= 4 and full >= 1


def test_edges(spark):
    log = fresh_folder(spark, "log")
    compact(spark, log)
    assert not run_log.log_exists(spark, log)
    write_entries(spark, log, 1, 1)
    compact(spark, log)
    assert n_files(log) == [1, 0, 0] and seqs(read_run_log(spark, log)) == [1]
    assert _RunLog(spark, log).compact_every == run_log.COMPACT_EVERY
