"""The run-status feed: one row per status or progress message of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How event types stand in for messages of the two feeds.
QUERY_STATES = {
    "signup": "SUBMITTED",
    "view": "LAUNCHING",
    "click": "RUNNING",
    "purchase": "FINISHED",
    "error": "FAILED",
}
TWO_FEED_STATES = {
    "signup": "SUBMITTED",
    "purchase": "SUBMITTED",
    "view": "RUNNING",
    "click": "FINISHED",
    "error": "FAILED",
}
APP_EVENT_TYPES = ("view",)


def _mapped(column: Column, names: dict[str, str]) -> Column:
    result = None
    for key, state in names.items():
        result = (F if result is None else result).when(column == key, state)
    return result


def run_status(events: DataFrame, two_feeds: bool = False) -> DataFrame:
    """Status feed derived from an ``events`` table.

    With ``two_feeds`` part of the rows come from the cluster report
    (``src = 'app'``), otherwise all are status messages (``src = 'query'``).
    """
    kind = F.col("event_type")
    state = _mapped(kind, TWO_FEED_STATES if two_feeds else QUERY_STATES)
    src = F.lit("query")
    if two_feeds:
        src = F.when(kind.isin(*APP_EVENT_TYPES), "app").otherwise("query")
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("run_id"),
        "ts",
        src.alias("src"),
        state.alias("state"),
        F.col("value").alias("progress"),
        F.when(kind == "error", "boom").alias("reason"),
    )


def mixed_status(events: DataFrame) -> DataFrame:
    """Status messages, cluster reports and lost drivers in one feed, from an ``events`` table.

    The kind of an event says who speaks, its value what is said; most values say nothing final.
    """
    kind, value = F.col("event_type"), F.col("value")
    is_app = kind == "view"
    is_lost = (kind == "error") & (value < 1.5)
    state = (
        F.when(kind == "signup", "SUBMITTED")
        .when(kind == "click", F.when(value > 60, "LAUNCHING").otherwise("SUBMITTED"))
        .when(kind == "purchase", F.when(value < 1, "FINISHED").when(value < 1.5, "PARSEFAILED").otherwise("RUNNING"))
        .when((kind == "error") & (value < 3), "FAILED")
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("run_id"),
        "ts",
        F.when(is_app, "app").when(is_lost, "lost").otherwise("query").alias("src"),
        F.when(~is_app & ~is_lost, state).alias("state"),
        value.alias("progress"),
        F.when((state == "FAILED") & ~is_lost, F.concat(F.lit("boom "), "event_id")).alias("reason"),
        F.concat(F.lit("app_"), "user_id").alias("app_id"),
        F.when(is_app & (value < 0.5), "FAILED")
        .when(is_app & (value < 1), "KILLED")
        .when(is_app & (value < 1.5), "FINISHED")
        .when(is_app & (value < 60), "RUNNING")
        .when(is_app, "ACCEPTED")
        .alias("app_state"),
        F.when(is_app & (value > 250), "FAILED").when(is_app & (value > 220), "KILLED").when(is_app, "UNDEFINED").alias("final_status"),
        F.when(is_lost, F.concat(F.lit("node-"), F.col("user_id") % 7, F.lit(":7077"))).alias("address"),
    )
