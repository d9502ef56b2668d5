"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the least node it reaches.

    Each round a node takes the least label around it and then that label's own label, so
    the rounds grow with the logarithm of a component's width. Both are joins and minima with
    partial sums; a node of many links is one row of each. Each round is written down once.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = None
    while True:
        if labels is None:
            hop = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
            hop = hop.select("node", F.col("node").alias("was"), F.least("node", "near").alias("label"))
        else:
            around = (
                both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near"))
            )
            hop = labels.join(around, "node").select(
                "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
            )
        roots = hop.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = stored(hop.join(roots, "label").select("node", "was", F.col("root").alias("label")), "labels")
        first, labels = labels is None, jumped.select("node", "label")
        if not first and jumped.filter(F.col("was") != F.col("label")).isEmpty():
            return labels


def extended(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links, given as pairs (a, b) of nodes; of ``labels`` only roots meet again."""
    if labels is None:
        return components(links)
    of = labels.select("node", "label")
    roots = (
        links.join(of.toDF("a", "la"), "a", "left")
        .join(of.toDF("b", "lb"), "b", "left")
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    )
    joined = components(roots).toDF("root", "top")
    old = of.join(joined, F.col("label") == F.col("root"), "left").select(
        "node", F.coalesce("top", "label").alias("label")
    )
    new = joined.select(F.col("root").alias("node"), F.col("top").alias("label"))
    return stored(old.union(new.join(of, "node", "left_anti")), "labels")
