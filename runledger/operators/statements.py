"""SQL statements: run one, write or return its rows, report its schema."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.row_text import row_text
from runledger.functions.sql_text import is_result_query


def run_sql(
    spark: SparkSession, sql: str, args: dict[str, Any] | list[Any] | None = None
) -> DataFrame:
    """Result of a statement. Queries stay lazy; commands have run on return."""
    return spark.sql(sql, args=args)


def classify_statement(statements: DataFrame, sql: str = "sql") -> DataFrame:
    """Statements with ``is_result_query``: rows to write, or a command."""
    return statements.withColumn("is_result_query", is_result_query(F.col(sql)))


def write_result_text(result: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write one text line per row; fails if ``path`` exists, unless it is to be replaced."""
    row_text(result).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def collect_rows(result: DataFrame) -> DataFrame:
    """Rows as strings, for the caller to collect or to go on with."""
    return row_text(result)


def result_schema(result: DataFrame) -> DataFrame:
    """``(ordinal, name, type, nullable)``, one row per result column."""
    fields = result.schema.fields
    columns = pa.table(
        {
            "ordinal": pa.array(range(len(fields)), pa.int32()),
            "name": pa.array([f.name for f in fields], pa.string()),
            "type": pa.array([f.dataType.simpleString() for f in fields], pa.string()),
            "nullable": pa.array([f.nullable for f in fields], pa.bool_()),
        }
    )
    return result.sparkSession.createDataFrame(columns)


def unique_out_path(base: str, run_id: Any) -> str:
    """Output folder of a run. Two runs never share an id, so nor a folder."""
    return f"{base.rstrip('/')}/run-{run_id}"


def stamp_run(runs: DataFrame, submit_host: str) -> DataFrame:
    """Runs with the host they were submitted from and the time of submission."""
    return runs.withColumns(
        {"submit_host": F.lit(submit_host), "submitted_at": F.current_timestamp()}
    )
