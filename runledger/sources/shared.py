"""Where results that outlive one job are put."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach.

    ``spark.checkpoint.dir`` names it; where that is unset, it lies in the
    warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/runledger-shared"
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
