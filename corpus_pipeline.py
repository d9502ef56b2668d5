"""A corpus made ready for training: filtered, deduplicated, cleaned, mixed and packed.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns
the columns of ``documents``, but for the last, which returns a row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runledger.llm.common import stored
from runledger.llm.mixing import mixed_documents
from runledger.llm.near_dedup import distinct_documents
from runledger.llm.packing import pack_documents
from runledger.llm.pii import redacted_documents
from runledger.llm.quality_rules import kept_documents
from runledger.session import ship_package
from runledger.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list accept."""
    return kept_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship_package(spark)
    return distinct_documents(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by the name of its kind."""
    ship_package(spark)
    return redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship_package(spark)
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    ship_package(spark)
    return pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_copies),
    ("personal data", redact),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned rules, alignment and tokenization are beyond SQL; tests follow each stage instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
