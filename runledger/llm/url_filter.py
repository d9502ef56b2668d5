"""URLs allowed or blocked by rules of a host and a path, the longest match first.

The rules become one trie: from the root along the labels of the host, last label first, then
along the segments of the path. A url walks down it as far as it goes; the deepest rule on the
way is the longest match. The trie is broadcast if there are at most ``MAX_RULES`` rules; more
of them are joined instead, on every host and path prefix that a url has and a rule has the
length of.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; a
rule both allowed and blocked blocks; repeated urls are judged alike; without rules every url
gets the default. Columns of the input stay, but for ones named like an added column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules that are broadcast at most: some 100 MB as a trie.
MAX_RULES = 200_000

ADDED = ("host", "path", "rule", "verdict")

_ENDS_HOST = re.compile(r"[/?#]")
_ENDS_PATH = re.compile(r"[?#]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = _ENDS_HOST.search(rest)
    host = rest[: end.start()] if end else rest
    return host.translate(_LOWER), _ENDS_PATH.split(rest[len(host) :], maxsplit=1)[0]


class Trie:
    """Nodes are (children by label, children by segment, rules by start of the next segment)."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: tuple[dict, dict, dict] = ({}, {}, {})
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(label, ({}, {}, {}))
            *whole, start = path.split("/")
            for segment in whole:
                node = node[1].setdefault(segment, ({}, {}, {}))
            if node[2].get(start, (0, "allow"))[1] == "allow":
                node[2][start] = (host + path, verdict)

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule of the longest host that fits, and of those the longest path."""
        node, nodes = self.root, []
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            nodes.append(node)
        segments = path.split("/")
        for node in reversed(nodes):
            found = None
            for segment in segments:
                # A rule may stop within a segment; the longer start is the longer rule.
                starts = [s for s in node[2] if segment.startswith(s)]
                if starts:
                    found = node[2][max(starts, key=len)]
                node = node[1].get(segment)
                if node is None:
                    break
            if found:
                return found
        return None


def judged_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", max_rules: int = MAX_RULES
) -> DataFrame:
    """``pages`` with host, path, rule (host and path in one, or null) and verdict.

    ``rules`` has columns host, path and verdict (``allow`` or ``block``).
    """
    rules = rules.select(
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    ).filter("host is not null and verdict is not null")
    listed = rules.limit(max_rules + 1).collect()
    if len(listed) > max_rules:
        return _joined(pages, rules, default, url)
    keep = [c for c in pages.columns if c.lower() not in ADDED]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    held = pages.select(row.alias("row"), F.col(url).alias("link"))
    schema = T.StructType([held.schema["row"], *[T.StructField(c, T.StringType()) for c in ADDED]])
    trie = pages.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in listed]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = trie.value.longest
        for batch in batches:
            places = [host_and_path(u) for u in batch.column("link").to_pylist()]
            found = [longest(*place) or (None, default) for place in places]
            columns = [[p[0] for p in places], [p[1] for p in places], [f[0] for f in found], [f[1] for f in found]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array(c, pa.string()) for c in columns]], ["row", *ADDED]
            )

    judged = held.mapInArrow(judge, schema)
    return judged.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *ADDED)


def _joined(pages: DataFrame, rules: DataFrame, default: str, url: str) -> DataFrame:
    """The same by joins: hosts a url's host ends in, then the paths that its path starts with."""
    keep = [c for c in pages.columns if c.lower() not in ADDED]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    urls = (
        pages.select(row.alias("row"), F.coalesce(F.col(url), F.lit("")).alias("link"))
        .withColumn("rest", F.regexp_extract("link", "(?s)^.*?://(.*)$", 1))
        .withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
        .withColumn("host", F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        .withColumn("path", F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), "^[^?#]*", 0))
        .select("row", "host", "path")
    )
    lengths = rules.groupBy(F.col("host").alias("r_host")).agg(F.collect_set(F.length("path")).alias("lengths"))
    best = (
        rules.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path"))
        .agg(F.max("verdict").alias("b_verdict"))
    )
    places = urls.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    tried = (
        places.withColumn("r_host", F.explode(suffixes))
        .join(lengths, "r_host")
        .withColumn("n", F.explode("lengths"))
        .filter("n <= length(path)")
        .withColumn("r_path", F.expr("substring(path, 1, n)"))
    )
    found = (
        tried.join(best, (F.col("r_host") == F.col("b_host")) & (F.col("r_path") == F.col("b_path")))
        .groupBy(F.col("host").alias("f_host"), F.col("path").alias("f_path"))
        .agg(F.max(F.struct(F.length("r_host"), F.length("r_path"), F.concat("r_host", "r_path").alias("rule"), F.col("b_verdict").alias("verdict"))).alias("top"))
    )
    return urls.join(found, (F.col("host") == F.col("f_host")) & (F.col("path") == F.col("f_path")), "left").select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
