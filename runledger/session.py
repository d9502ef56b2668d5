"""Session construction."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session_builder(
    app_name: str = "runledger",
    hive: bool = False,
    conf: Mapping[str, str] | None = None,
) -> SparkSession.Builder:
    """Builder with the library's defaults; ``conf`` wins over them.

    ``hive`` decides which catalog SQL text sees. Master, memory and shuffle
    partitions are left to ``spark-submit`` or ``conf``: they belong to the
    cluster and the data size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.enableHiveSupport() if hive else builder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once.

    Not needed where it is installed on the cluster or given by ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="runledger-py-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
