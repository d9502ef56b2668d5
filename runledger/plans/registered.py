"""A query by name: what Spark runs, and the same for an independent engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Registered:
    """``run(spark, folder)`` over the tables in ``folder``.

    Without an ``oracle`` the result is not the same twice.
    """

    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None
