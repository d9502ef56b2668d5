"""Run one SQL statement: ``spark-submit submit.py [--hive] <base path> "<sql>"``.

The result of a query is written as text below the base path, the rows of a
command are printed; either way the run is recorded in ``<base path>/run-log``.
"""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.operators.batch import run_batch
from runledger.operators.statements import collect_rows
from runledger.session import session_builder


def submit(spark: SparkSession, base: str, sql: str) -> bool:
    run_id = uuid.uuid4().int >> 65
    statement = spark.range(1).select(
        F.lit(run_id).alias("stmt_id"), F.lit(sql).alias("sql")
    )
    outcome = run_batch(spark, statement, f"{base.rstrip('/')}/run-log", base)[0]
    if outcome.state != "FINISHED":
        print(f"{outcome.state} {outcome.error_class}: {outcome.reason}")
        return False
    for field in outcome.schema:
        print(f"column: {field.name} {field.dataType.simpleString()}")
    if outcome.out_path is not None:
        print(f"results: {outcome.out_path}")
    else:
        for row in collect_rows(outcome.result).toLocalIterator():
            print(row.value)
    return True


def arguments(given: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one SQL statement and record the run.")
    parser.add_argument("--hive", action="store_true", help="see the tables of the Hive catalog")
    parser.add_argument("base", help="folder of results and of the run log")
    parser.add_argument("sql", help="the statement")
    return parser.parse_args(given)


if __name__ == "__main__":
    asked = arguments(sys.argv[1:])
    session = session_builder("runledger-submit", hive=asked.hive).getOrCreate()
    finished = submit(session, asked.base, asked.sql)
    session.stop()
    sys.exit(not finished)
