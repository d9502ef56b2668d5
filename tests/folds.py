"""Row-by-row folds over one run, in ``(ts, seq)`` order, to compare with."""

import random
from datetime import datetime, timedelta

from runledger.functions.states import FAILED_STATES, TERMINAL_STATES

FEED_SCHEMA = (
    "seq bigint, run_id bigint, ts timestamp, src string, state string,"
    " progress double, reason string"
)
START = datetime(2024, 1, 1)
STATES = ("SUBMITTED", "LAUNCHING", "RUNNING", "FINISHED", "FAILED", "KILLED")


def random_feed(seed, rows, runs=6, step=5, hot=0.0, states=STATES, weights=None):
    """Rows in random arrival order, with ties on ts and runs that never end."""
    rng = random.Random(seed)
    feed = []
    for seq in range(rows):
        run = 0 if rng.random() < hot else rng.randrange(runs)
        state = rng.choices(states, weights)[0]
        if run == 1 and state in TERMINAL_STATES:
            state = "RUNNING"
        feed.append(
            dict(
                seq=seq,
                run_id=run,
                ts=START + timedelta(seconds=rng.randrange(rows * step)),
                src=rng.choice(("query", "app")),
                state=state,
                progress=rng.choice((None, float("nan"), rng.uniform(-5, 100))),
                reason=f"why {seq}" if state in FAILED_STATES else None,
            )
        )
    rng.shuffle(feed)
    return feed


def by_run(feed):
    runs = {}
    for row in sorted(feed, key=lambda r: (r["ts"], r["seq"])):
        runs.setdefault(row["run_id"], []).append(row)
    return runs


def reconcile(rows):
    state = "UNKNOWN"
    for row in rows:
        if row["src"] == "app" and row["state"] == "RUNNING":
            if state == "SUBMITTED":
                state = "RUNNING"
        elif row["state"] is not None:
            state = row["state"]
    return state


def outcome(rows):
    for row in rows:
        if row["state"] in TERMINAL_STATES:
            if row["state"] == "FINISHED":
                return ("FINISHED", "FINISHED", None, row["seq"])
            return ("FAILED", row["state"], row["reason"], row["seq"])
    return None


def progress(rows):
    best, seen = 0.0, {}
    for row in rows:
        if row["progress"] is not None and best < row["progress"]:
            best = row["progress"]
        seen[row["seq"]] = best
    return seen


def throttled(rows, heartbeat, compare="state"):
    kept, last = [], None
    for row in rows:
        if (
            last is None
            or row[compare] != last[compare]
            or row["ts"] > last["ts"] + timedelta(seconds=heartbeat)
        ):
            kept.append(row["seq"])
            last = row
    return kept
