"""All that is known of a run as one summary that merges in any order.

Three kinds of rows speak of a run: status messages of the query (``src = 'query'``), reports of
the cluster (``'app'``) and the loss of its driver (``'lost'``). Read one by one, in ``(ts, seq)``
order:

- a status message sets the state; a failed one also the reason, and a terminal one ends the run;
- a cluster report of FAILED, KILLED or FINISHED does the same, and is the last one read: its
  reporter stops there. One of RUNNING counts only while the state is SUBMITTED;
- a lost driver ends the run as failed. It leaves the state alone, and the reason if one is known;
- the first end is the outcome; once awaited, it is also the state.

None of this needs the order of all rows. Of each kind only the first or the last row can matter,
so a summary is six of them, each a minimum or maximum over ``(ts, seq, ...)``. Minima and maxima
merge: within a task before the shuffle, across slices of a run, across micro-batches and files in
whatever order they come, and a row that is read twice changes nothing.

A failed status without a reason leaves the reason that is known. Rows without a state, such as
progress messages, say nothing here; a run of which nothing else is known is UNKNOWN.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import states

#: How each part of a summary merges.
PARTS = {
    "first_query_end": F.min,
    "first_app_end": F.min,
    "first_lost": F.min,
    "last_query": F.max,
    "last_query_reason": F.max,
    "last_app_running": F.max,
}


def run_events(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(run_id, ts, seq, src, state, reason)`` of a feed of all three kinds of rows, and ``keep``.

    Cluster reports have ``app_id``, ``app_state`` and ``final_status``, lost drivers ``app_id``
    and ``address``; status messages their ``state`` and ``reason``.
    """
    src, app_id = F.col("src"), F.col("app_id")
    report = states.app_report(app_id, F.col("app_state"), F.col("final_status"))
    lost = states.disconnect_reason(F.lit(None).cast("string"), app_id, F.col("address"))
    own = ("run_id", "ts", "seq", "src")
    return feed.select(
        *own,
        F.when(src == "query", F.col("state")).when(src == "app", report["state"]).alias("state"),
        F.when(src == "query", F.col("reason")).when(src == "app", report["reason"]).when(src == "lost", lost).alias("reason"),
        *[c for c in keep if c not in own],
    )


def said() -> dict[str, Column]:
    """What one row of ``run_events`` adds to each part of a summary, or null."""
    state, reason, src = F.col("state"), F.col("reason"), F.col("src")
    of_query, of_app = (src == "query") & state.isNotNull(), (src == "app") & state.isNotNull()
    whole, place = F.struct("ts", "seq", "state", "reason"), F.struct("ts", "seq")
    return {
        "first_query_end": F.when(of_query & states.is_finished(state), whole),
        "first_app_end": F.when(of_app & (state != "RUNNING"), whole),
        "first_lost": F.when(src == "lost", F.struct("ts", "seq", "reason")),
        "last_query": F.when(of_query, F.struct("ts", "seq", "state")),
        "last_query_reason": F.when(of_query & states.is_failed(state) & reason.isNotNull(), F.struct("ts", "seq", "reason")),
        "last_app_running": F.when(of_app & (state == "RUNNING"), place),
    }


def summarised(events: DataFrame) -> DataFrame:
    """``(run_id, *PARTS)``; takes a stream as well, whose state is then one summary per run."""
    return events.groupBy("run_id").agg(*[PARTS[name](part).alias(name) for name, part in said().items()])


def merged(*summaries: DataFrame) -> DataFrame:
    """One summary per run of several tables of summaries, in any order and with any overlap."""
    every = reduce(DataFrame.unionByName, [s.select("run_id", *PARTS) for s in summaries])
    return every.groupBy("run_id").agg(*[merge(part).alias(part) for part, merge in PARTS.items()])


def told(summaries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the summaries tell, beside the columns to ``keep``.

    ``(run_id, state, settled_state, reason, outcome, outcome_reason, outcome_src, outcome_seq)``:
    the state by messages and the same once the outcome is awaited, the last reason, and the
    outcome with its own reason, null for a run that has not ended.
    """
    query, app, lost = F.col("first_query_end"), F.col("first_app_end"), F.col("first_lost")
    last, nothing = F.col("last_query"), F.lit(None).cast("string")

    def end(row: Column, src: str, state: Column, reason: Column) -> Column:
        fields = [row["ts"].alias("ts"), row["seq"].alias("seq"), state.alias("state"), reason.alias("reason"), F.lit(src).alias("src")]
        return F.when(row.isNotNull(), F.struct(*fields))

    first = F.least(
        end(query, "query", query["state"], query["reason"]),
        end(app, "app", app["state"], app["reason"]),
        end(lost, "lost", F.lit("FAILED"), lost["reason"]),
    )
    # The reporter's end sets the state once, so what comes later of the two is the state.
    by_app = F.struct(app["ts"].alias("ts"), app["seq"].alias("seq"), app["state"].alias("state"))
    base = F.greatest(last, F.when(app.isNotNull(), by_app))
    running = F.col("last_app_running")
    confirmed = (F.col("base.state") == "SUBMITTED") & app.isNull() & (running > F.struct("base.ts", "base.seq"))
    state = F.when(F.col("base").isNull(), "UNKNOWN").when(confirmed, "RUNNING").otherwise(F.col("base.state"))
    app_reason = F.struct(app["ts"].alias("ts"), app["seq"].alias("seq"), app["reason"].alias("reason"))
    known = F.greatest(F.col("last_query_reason"), F.when(app["reason"].isNotNull(), app_reason))
    succeeded = states.is_succeeded(F.col("first.state"))
    outcome = F.when(F.col("first").isNull(), nothing).when(succeeded, "FINISHED").otherwise("FAILED")
    return (
        summaries.select("run_id", *keep, *PARTS, first.alias("first"), base.alias("base"), known.alias("known"))
        .withColumns({"by_messages": state, "outcome": outcome})
        .select(
            "run_id",
            *keep,
            F.col("by_messages").alias("state"),
            F.coalesce("outcome", "by_messages").alias("settled_state"),
            F.coalesce("known.reason", lost["reason"]).alias("reason"),
            "outcome",
            F.when(~succeeded, F.col("first.reason")).alias("outcome_reason"),
            F.col("first.src").alias("outcome_src"),
            F.col("first.seq").alias("outcome_seq"),
        )
    )


def run_summary(feed: DataFrame) -> DataFrame:
    """What a feed of all three kinds of rows tells of each run."""
    return told(summarised(run_events(feed)))
