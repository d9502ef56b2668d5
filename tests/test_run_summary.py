"""Summaries of runs against a fold over their rows, whole and in parts."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from folds import START
from runledger.functions.states import FAILED_STATES, TERMINAL_STATES
from runledger.operators import run_summary as ops

SCHEMA = (
    "seq bigint, run_id bigint, ts timestamp, src string, state string, reason string,"
    " app_id string, app_state string, final_status string, address string"
)


def mixed_feed(seed, rows, runs, hot=0.0):
    rng = random.Random(seed)
    feed = []
    for seq in range(rows):
        run = 0 if rng.random() < hot else rng.randrange(runs)
        src = rng.choices(("query", "app", "lost"), (6, 4, 0.3))[0]
        row = dict(seq=seq, run_id=run, ts=START + timedelta(seconds=rng.randrange(rows)), src=src, app_id=f"app_{run}")
        if src == "query":
            row["state"] = rng.choices(("SUBMITTED", "LAUNCHING", "RUNNING", None, *TERMINAL_STATES), (9, 3, 3, 3, *[0.2] * 5))[0]
            if row["state"] in FAILED_STATES and rng.random() < 0.7:
                row["reason"] = f"why {seq}"
        elif src == "app":
            row["app_state"] = rng.choices(("ACCEPTED", "RUNNING", "FAILED", "KILLED", "FINISHED"), (5, 9, 0.3, 0.3, 0.3))[0]
            row["final_status"] = rng.choices(("UNDEFINED", "FAILED", "KILLED"), (20, 0.3, 0.3))[0]
        else:
            row["address"] = f"node:{seq}"
        feed.append({name.split()[0]: row.get(name.split()[0]) for name in SCHEMA.split(", ")})
    rng.shuffle(feed)
    return feed


def fold(rows):
    """state, reason and outcome as they are after one row after the other."""
    state, reason, over, outcome = "UNKNOWN", None, False, None
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        end = None
        if r["src"] == "query" and r["state"] is not None:
            state = r["state"]
            if state in FAILED_STATES:
                reason = r["reason"] or reason
                end = ("FAILED", r["reason"], "query", r["seq"])
            elif state in TERMINAL_STATES:
                end = ("FINISHED", None, "query", r["seq"])
        elif r["src"] == "app" and not over:
            for name in ("FAILED", "KILLED"):
                if name in (r["app_state"], r["final_status"]):
                    state, over, reason = "FAILED", True, f"Job {r['app_id']} {name}."
                    end = ("FAILED", reason, "app", r["seq"])
                    break
            else:
                if r["app_state"] == "FINISHED":
                    state, over, end = "FINISHED", True, ("FINISHED", None, "app", r["seq"])
                elif r["app_state"] == "RUNNING" and state == "SUBMITTED":
                    state = "RUNNING"
        elif r["src"] == "lost":
            gone = f"{r['app_id']} Driver {r['address']} disassociated!"
            end = ("FAILED", gone, "lost", r["seq"])
            reason = reason or gone
        outcome = outcome or end
    return (state, outcome[0] if outcome else state, reason, *(outcome or (None,) * 4))


def expected(feed):
    runs = {}
    for row in feed:
        runs.setdefault(row["run_id"], []).append(row)
    return {run: fold(rows) for run, rows in runs.items()}


def rows_of(told):
    return {r.run_id: tuple(r)[1:] for r in told.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_whole_and_in_parts(spark, seed):
    feed = mixed_feed(seed, 2000, 60, hot=0.33 * (seed % 2))
    df = spark.createDataFrame([tuple(r.values()) for r in feed], SCHEMA)
    assert rows_of(ops.run_summary(df)) == expected(feed)
    parts = [ops.summarised(ops.run_events(df.filter(F.col("seq") % 5 == i))) for i in range(5)]
    some = ops.merged(parts[3], parts[1])
    assert rows_of(ops.told(ops.merged(parts[4], some, parts[0], some, parts[2], parts[1]))) == expected(feed)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ops.run_summary(empty).count() == 0
    silent = spark.createDataFrame([(1, 7, START, "query", *[None] * 6), (2, None, START, "app", None, None, "a", "ACCEPTED", None, None)], SCHEMA)
    assert rows_of(ops.run_summary(silent)) == {run: ("UNKNOWN", "UNKNOWN", *[None] * 5) for run in (7, None)}


def test_combined_before_the_shuffle(spark, sf):
    feed = spark.createDataFrame([tuple(r.values()) for r in mixed_feed(0, 10, 3)], SCHEMA)
    plan = ops.run_summary(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "partial_min" in plan and "partial_max" in plan and "Window" not in plan
