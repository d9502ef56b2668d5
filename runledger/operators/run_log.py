"""The run log's files: read whole, streamed, and kept few while others do either.

An entry is written as a file of its own, directly in the folder of the log. When ``every`` of
them have gathered, ``compact`` copies them into one file of the folder ``closed-1`` below, and
``every`` of those into one of ``closed-2``, whose files stay.

A copy is complete before anything goes, and a file goes only in a later round than the one that
copied it. A batch reader leaves out files that have a copy when it begins, so none that it reads
goes in the next round; slower than that, it ends with a missing file, not with fewer rows. A
stream reads all and skips missing files, whose copies are still to come. Both take an entry once,
by ``(batch_id, seq)``: a round that ended half-way, or two at once, leave it twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_COLUMNS = {
    "seq": "bigint",
    "run_id": "bigint",
    "ts": "timestamp",
    "src": "string",
    "state": "string",
    "progress": "double",
    "reason": "string",
    "error_class": "string",
    "sql": "string",
    "is_result_query": "boolean",
    "out_path": "string",
    "schema_json": "string",
    "batch_id": "string",
    "submit_host": "string",
    "submitted_at": "timestamp",
}
LOG_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in LOG_COLUMNS.items())

#: What tells an entry from all others.
ENTRY = ["batch_id", "seq"]

#: Files of one level that are copied into one of the next, and the levels above single entries.
COMPACT_EVERY, LEVELS = 64, 2


def log_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a log: Spark itself looks, as only it may reach the path."""
    try:
        spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException:
        return False
    return True


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as a run-status feed."""
    paths = [path]
    if log_exists(spark, _folder(path, 1)):
        # Level by level: what is copied meanwhile is found in the next.
        paths = [file for level in range(LEVELS) for file in _files(spark, path, level)[False]]
        paths += [folder for folder in [_folder(path, LEVELS)] if log_exists(spark, folder)]
    return spark.read.schema(LOG_SCHEMA).parquet(*paths).dropDuplicates(ENTRY)


def stream_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as a streaming run-status feed; its state holds the key of each entry."""
    files = spark.readStream.schema(LOG_SCHEMA).option("recursiveFileLookup", True)
    return files.option("ignoreMissingFiles", True).parquet(path).dropDuplicates(ENTRY)


def compact(spark: SparkSession, path: str, every: int = COMPACT_EVERY) -> None:
    """One round: files with copies go, and of each level that has ``every`` others a copy is made."""
    for level in range(LEVELS):
        if not log_exists(spark, _folder(path, level)):
            return
        files = _files(spark, path, level)
        _delete(spark, files[True])
        if len(files[False]) >= every:
            rows = spark.read.schema(LOG_SCHEMA).parquet(*files[False]).dropDuplicates(ENTRY)
            rows.coalesce(1).sortWithinPartitions(*ENTRY).write.mode("append").parquet(_folder(path, level + 1))


def _files(spark: SparkSession, path: str, level: int) -> dict[bool, list[str]]:
    """The files of a level by whether the next one holds all their entries.

    They number some twice what a round copies: those of the last round and those since.
    """
    files = spark.read.schema(LOG_SCHEMA).option("ignoreMissingFiles", True)
    folder, above = _folder(path, level), _folder(path, level + 1)
    entries = files.parquet(folder).select(*ENTRY, F.col("_metadata.file_name").alias("file"))
    copied = F.lit(False)
    if log_exists(spark, above):
        there = files.parquet(above).select(*ENTRY, F.lit(True).alias("there")).distinct()
        entries, copied = entries.join(there, ENTRY, "left"), F.coalesce("there", F.lit(False))
    found: dict[bool, list[str]] = {True: [], False: []}
    for row in entries.groupBy("file").agg(F.every(copied).alias("copied")).collect():
        found[row.copied].append(f"{folder}/{row.file}")
    return found


def _folder(path: str, level: int) -> str:
    return f"{path}/closed-{level}" if level else path


def _delete(spark: SparkSession, files: list[str]) -> None:
    """Spark's readers and writers delete folders only; the file system they use deletes files."""
    for name in files:
        file = spark._jvm.org.apache.hadoop.fs.Path(name)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
