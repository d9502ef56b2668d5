"""Running a table of statements, each recorded in a run log.

The log is all that a batch knows of itself. One that ended half-way is begun again with
``resume``: statements whose outcome is logged are left alone, one that was only SUBMITTED runs
again over what it may have written, and the rest follow, so the log ends as if nothing had
happened. With a deadline, a statement that runs longer has its Spark jobs cancelled by their tag
and is logged as KILLED.
"""

from __future__ import annotations

import socket
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from runledger.functions.states import is_finished, known_state
from runledger.operators.run_log import COMPACT_EVERY, LOG_COLUMNS, compact, log_exists, read_run_log
from runledger.operators.statements import (
    classify_statement,
    run_sql,
    stamp_run,
    unique_out_path,
    write_result_text,
)

@dataclass
class Outcome:
    """What became of a statement; ``result`` holds the rows of a command."""

    run_id: int
    state: str
    reason: str | None = None
    error_class: str | None = None
    out_path: str | None = None
    schema: StructType | None = None
    result: DataFrame | None = None


def run_batch(
    spark: SparkSession,
    statements: DataFrame,
    log_path: str,
    out_base: str | None = None,
    deadline_seconds: float | None = None,
    resume: bool = False,
    compact_every: int = COMPACT_EVERY,
) -> list[Outcome]:
    """The outcomes of ``batch_outcomes``, all of them at once."""
    return list(batch_outcomes(spark, statements, log_path, out_base, deadline_seconds, resume, compact_every))


def batch_outcomes(
    spark: SparkSession,
    statements: DataFrame,
    log_path: str,
    out_base: str | None = None,
    deadline_seconds: float | None = None,
    resume: bool = False,
    compact_every: int = COMPACT_EVERY,
) -> Iterator[Outcome]:
    """Run ``(stmt_id, sql)`` in order of id; a failure does not stop the others.

    ``stmt_id`` becomes the ``run_id`` of the log and must be unique in it. Result
    queries are written below ``out_base``; without one they run to the end and
    are returned as DataFrames. Each run is logged as SUBMITTED before it starts
    and with its outcome once its output is complete. Outcomes come one by one, as
    statements are run, and are not held. After every ``compact_every`` entries
    the files of the log are compacted.
    """
    todo, last_seq = classify_statement(statements).select("stmt_id", "sql", "is_result_query"), 0
    todo = todo.withColumn("was_submitted", F.lit(False))
    if resume and log_exists(spark, log_path):
        logged = read_run_log(spark, log_path)
        last_seq = logged.agg(F.max("seq")).first()[0] or 0
        runs = logged.groupBy(F.col("run_id").alias("stmt_id")).agg(F.max(is_finished(F.col("state"))).alias("ended"))
        todo = todo.drop("was_submitted").join(runs, "stmt_id", "left").where(~F.coalesce("ended", F.lit(False)))
        todo = todo.select("stmt_id", "sql", "is_result_query", F.col("ended").isNotNull().alias("was_submitted"))
    log = _RunLog(spark, log_path, last_seq, compact_every)
    # The texts come to the driver one partition at a time: each is a driver step with
    # Spark jobs of its own.
    for row in todo.orderBy("stmt_id").toLocalIterator():
        path = None
        if row.is_result_query and out_base is not None:
            path = unique_out_path(out_base, row.stmt_id)
        if not row.was_submitted:
            log.append(row, "SUBMITTED", Outcome(row.stmt_id, "SUBMITTED"), progress=0.0)
        with _deadline(spark, deadline_seconds) as passed:
            outcome = _run_statement(spark, row, path)
        if passed.is_set() and outcome.state != "FINISHED":
            reason = f"Job {row.stmt_id} KILLED. It ran longer than {deadline_seconds:g} seconds."
            outcome = Outcome(row.stmt_id, "KILLED", reason=reason)
        ended = 100.0 if outcome.state == "FINISHED" else None
        log.append(row, outcome.state, outcome, progress=ended)
        yield outcome


@contextmanager
def _deadline(spark: SparkSession, seconds: float | None) -> Iterator[threading.Event]:
    """Cancel the Spark jobs started inside once ``seconds`` have passed; tells whether they have."""
    passed, over = threading.Event(), threading.Event()
    if seconds is None:
        yield passed
        return
    tag = f"statement-{uuid.uuid4().hex}"

    def watch() -> None:
        # A statement may start further jobs: they are cancelled as well.
        if not over.wait(seconds):
            passed.set()
            while not over.is_set():
                spark.sparkContext.cancelJobsWithTag(tag)
                over.wait(0.2)

    watcher = threading.Thread(target=watch, daemon=True)
    spark.sparkContext.addJobTag(tag)
    watcher.start()
    try:
        yield passed
    finally:
        over.set()
        watcher.join()
        spark.sparkContext.removeJobTag(tag)


def _run_statement(spark: SparkSession, row, path: str | None) -> Outcome:
    try:
        result = run_sql(spark, row.sql)
    except ParseException as error:
        return _failure(row.stmt_id, "PARSEFAILED", error)
    except AnalysisException as error:
        state = "PLANFAILED"
        # A command has already run when this returns: one that can be planned
        # failed in its run.
        if not row.is_result_query and _can_be_planned(spark, row.sql):
            state = "FAILED"
        return _failure(row.stmt_id, state, error)
    except Exception as error:
        return _failure(row.stmt_id, "FAILED", error)
    try:
        if path is not None:
            write_result_text(result, path, overwrite=row.was_submitted)
        elif row.is_result_query:
            result.write.format("noop").mode("overwrite").save()
    except Exception as error:
        return _failure(row.stmt_id, "FAILED", error)
    return Outcome(
        row.stmt_id,
        "FINISHED",
        out_path=path,
        schema=result.schema,
        result=None if path is not None else result,
    )


def _can_be_planned(spark: SparkSession, sql: str) -> bool:
    """``EXPLAIN`` plans without running; it reports a failure as its text."""
    try:
        plan = spark.sql(f"EXPLAIN {sql}").first()[0]
    except Exception:
        return False
    return "Error occurred during query planning" not in plan


def _failure(run_id: int, state: str, error: Exception) -> Outcome:
    error_class = None
    if isinstance(error, PySparkException):
        error_class = error.getCondition()
    return Outcome(
        run_id, state, reason=str(error), error_class=error_class or type(error).__name__
    )


class _RunLog:
    """Appends to a parquet folder that other sessions may read or stream."""

    def __init__(
        self, spark: SparkSession, path: str, last_seq: int = 0, compact_every: int = COMPACT_EVERY
    ):
        self.spark = spark
        self.path = path
        self.compact_every = compact_every
        self.batch_id = uuid.uuid4().hex
        self.host = socket.gethostname()
        self.seq = last_seq

    def append(self, row, state: str, outcome: Outcome, progress: float | None) -> None:
        self.seq += 1
        entry = {
            "seq": self.seq,
            "run_id": row.stmt_id,
            "src": "query",
            "state": state,
            "progress": progress,
            "reason": outcome.reason,
            "error_class": outcome.error_class,
            "sql": row.sql,
            "is_result_query": row.is_result_query,
            "out_path": outcome.out_path,
            "schema_json": outcome.schema.json() if outcome.schema is not None else None,
            "batch_id": self.batch_id,
        }
        one = self.spark.range(1, numPartitions=1).select(
            *(F.lit(entry.get(c)).cast(kind).alias(c) for c, kind in LOG_COLUMNS.items())
        )
        one = one.withColumns({"ts": F.current_timestamp(), "state": known_state(F.col("state"))})
        if state == "SUBMITTED":
            one = stamp_run(one, self.host)
        one.write.mode("append").parquet(self.path)
        if self.seq % self.compact_every == 0:
            compact(self.spark, self.path, self.compact_every)
