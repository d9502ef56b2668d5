"""All registered queries by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runledger.operators.statements import run_sql
from runledger.plans.acceptance import ACCEPTANCE, Acceptance
from runledger.plans.hot_window_queries import HOT_WINDOW_QUERIES
from runledger.plans.registered import Registered
from runledger.plans.run_status_queries import RUN_STATUS_QUERIES
from runledger.plans.statement_queries import STATEMENT_QUERIES
from runledger.sources.tables import register_views


def _accepted(case: Acceptance) -> Registered:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        register_views(spark, folder, case.tables)
        return run_sql(spark, case.spark)

    return Registered(run, case.oracle)


REGISTRY: dict[str, Registered] = {
    **STATEMENT_QUERIES,
    **RUN_STATUS_QUERIES,
    **HOT_WINDOW_QUERIES,
    **{name: _accepted(case) for name, case in ACCEPTANCE.items()},
}
