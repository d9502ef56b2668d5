"""Severity of toxic text by cumulative-link ordinal regression.

A document's severity is one of ordered grades. Its words, as a sparse vector of those in a
learned vocabulary, are weighed by one set of weights that all grades share; ordered
thresholds on the sum give P(grade > k) for each k, and these give the expected grade.

Learning reads at most ``max_labelled`` labelled documents, chosen by hash of their id. Spark
counts, for each word, the documents of each grade that hold it; all words whose grades differ
from the others' (by z-score of the mean grade), upwards or downwards, become the vocabulary, which
the labelled documents bound. Scoring covers all documents and all their words.

Defined cases: a null or empty text has no words and the severity of the thresholds alone; an
id labelled twice has its highest grade; a null label is none; with fewer than two grades, or no
word that tells them apart, every document has the lowest grade. Columns of the input stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm.common import slices, stored

#: Labelled documents that learning uses at most.
MAX_LABELLED = 20_000

#: A word counts if its documents' mean grade is this many standard errors off the rest's.
LEAST_Z, LEAST_DOCUMENTS = 5.0, 5

ADDED = ("severity", "grade")

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]  # ascending; P(grade > k) = sigmoid(sum of weights - thresholds[k])
    grades: list[int]

    def severity(self, text: str | None) -> tuple[float, int]:
        """The expected grade, and the grade that half the probability lies at or above."""
        total = sum(self.weights[w] for w in words_of(text) if w in self.weights)
        value, grade = float(self.grades[0]), self.grades[0]
        for k, threshold in enumerate(self.thresholds):
            above = 1 / (1 + np.exp(min(500.0, threshold - total)))
            value += float(above) * (self.grades[k + 1] - self.grades[k])
            if above >= 0.5:
                grade = self.grades[k + 1]
        return value, grade


def _fit(rows: list[np.ndarray], level: np.ndarray, words: int, levels: int, decay: float = 1e-3, steps: int = 600):
    """Weights and thresholds of the largest likelihood, by adaptive gradient steps.

    Thresholds are the first and positive distances (as exponentials), so they stay in order.
    """
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, int)]).astype(int)
    owner = np.repeat(np.arange(len(rows)), sizes)
    weights = np.zeros(words)
    share = np.array([np.mean(level > k) for k in range(levels - 1)])
    cuts = -np.log(share / (1 - share))
    raw = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    squares = [np.full(words, 1e-8), np.full(levels - 1, 1e-8)]
    for _ in range(steps):
        total = np.bincount(owner, weights[flat], len(rows))
        theta = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
        # P(grade <= k) at the borders below and above each document's own grade.
        border = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            up, low = (1 / (1 + np.exp(total - border[level + s])) for s in (1, 0))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        d_total = (d_up - d_low) / len(rows)  # of the negative log-likelihood
        d_theta = np.zeros(levels - 1)
        for k in range(levels - 1):
            d_theta[k] = (d_low[level == k + 1].sum() - d_up[level == k].sum()) / len(rows)
        d_raw = np.array([d_theta.sum(), *(np.exp(raw[k]) * d_theta[k:].sum() for k in range(1, levels - 1))])
        grads = [np.bincount(flat, d_total[owner], words) + decay * weights, d_raw]
        for value, grad, square in zip((weights, raw), grads, squares):
            square += grad**2
            value -= 0.3 * grad / np.sqrt(square)
    return weights, (raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])).tolist()


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> Model:
    sample = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("labelled_id"))
        .agg(F.max(label).cast("int").alias("grade"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(max_labelled)
    )
    # The limit bounds what is broadcast: an id and a grade per row.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("labelled_id")
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [sorted(words_of(t)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("grade"), pa.array(found, pa.list_(pa.string()))], ["grade", "words"]
                )

    held = stored(rows.select("grade", "text").mapInArrow(split, "grade int, words array<string>"), "words")
    counts = sorted(held.groupBy("grade").count().collect())
    grades = [r[0] for r in counts]
    if len(grades) < 2:
        return Model({}, [], grades or [0])
    n = sum(r[1] for r in counts)
    mean = sum(r[0] * r[1] for r in counts) / n
    spread = (sum((r[0] - mean) ** 2 * r[1] for r in counts) / n) ** 0.5
    z = (F.avg("grade") - mean) * F.sqrt(F.count("*")) / spread
    chosen = (
        held.select("grade", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(z.alias("z"), F.count("*").alias("n"))
        .filter((F.abs("z") >= LEAST_Z) & (F.col("n") >= LEAST_DOCUMENTS))
        .select("word")
        .collect()
    )
    place = {word: i for i, word in enumerate(sorted(r["word"] for r in chosen))}
    if not place:
        return Model({}, [50.0] * (len(grades) - 1), grades)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[place[w] for w in words if w in place] for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(found, pa.list_(pa.int32()))], ["grade", "places"])

    vectors = held.mapInArrow(placed, "grade int, places array<int>").collect()
    level = np.array([grades.index(r["grade"]) for r in vectors])
    inputs = [np.array(r["places"], int) for r in vectors]
    weights, thresholds = _fit(inputs, level, len(place), len(grades))
    return Model(dict(zip(place, weights.tolist())), thresholds, grades)


def with_severity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with severity (the expected grade) and grade."""
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    held = docs.select(row.alias("row"), F.col(text).alias("body"))
    schema = T.StructType(
        [held.schema["row"], T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                found = [model.severity(t) for t in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([f[0] for f in found], pa.float64()),
                        pa.array([f[1] for f in found], pa.int32()),
                    ],
                    schema.names,
                )

    scored = held.mapInArrow(score, schema)
    return scored.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *ADDED)
