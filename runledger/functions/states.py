"""Run states and the column rules that read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eleven run states and the sets over them.
STATES = (
    "SUBMITTED",
    "PARSEFAILED",
    "PLANFAILED",
    "WAITING",
    "LAUNCHING",
    "RUNNING",
    "FINISHED",
    "STAGE_SUCCESSED",
    "FAILED",
    "KILLED",
    "UNKNOWN",
)
FAILED_STATES = ("PARSEFAILED", "PLANFAILED", "FAILED", "KILLED")
SUCCEEDED_STATES = ("FINISHED",)
TERMINAL_STATES = ("PARSEFAILED", "PLANFAILED", "FAILED", "KILLED", "FINISHED")
STAGE_SUCCEEDED_STATES = ("STAGE_SUCCESSED",)


def known_state(state: Column) -> Column:
    """The state itself; the query fails on a name outside ``STATES``."""
    unknown = F.raise_error(F.concat(F.lit("not a run state: "), state))
    return F.when(state.isNull() | state.isin(*STATES), state).otherwise(unknown)


def is_failed(state: Column) -> Column:
    return state.isin(*FAILED_STATES)


def is_succeeded(state: Column) -> Column:
    return state.isin(*SUCCEEDED_STATES)


def is_finished(state: Column) -> Column:
    return state.isin(*TERMINAL_STATES)


def is_stage_succeeded(state: Column) -> Column:
    return state.isin(*STAGE_SUCCEEDED_STATES)


def is_app_running(src: Column, state: Column) -> Column:
    """Rows of the cluster report that only count while a run is SUBMITTED."""
    return (src == "app") & (state == "RUNNING")


def report_line(app_id: Column, state: Column, reason: Column) -> Column:
    """``"<app>: <state> <reason>"``, leaving out the parts that are null."""
    return F.concat_ws(": ", app_id, F.concat_ws(" ", state, reason))


def app_report(app_id: Column, app_state: Column, final_status: Column) -> Column:
    """Cluster report as ``struct(state, reason)``; first match wins.

    A killed application is reported as FAILED with its own reason. RUNNING is
    returned as such: whether it counts is decided by ``reconcile_state``.
    Reports that say nothing about the run give a null state.
    """
    failed = (app_state == "FAILED") | (final_status == "FAILED")
    killed = (app_state == "KILLED") | (final_status == "KILLED")
    state = (
        F.when(failed, "FAILED")
        .when(killed, "FAILED")
        .when(app_state == "FINISHED", "FINISHED")
        .when(app_state == "RUNNING", "RUNNING")
    )
    job = F.concat(F.lit("Job "), app_id)
    reason = F.when(failed, F.concat(job, F.lit(" FAILED."))).when(
        killed, F.concat(job, F.lit(" KILLED."))
    )
    return F.struct(state.alias("state"), reason.alias("reason"))


def disconnect_reason(reason: Column, app_id: Column, address: Column) -> Column:
    """Why a run whose driver was lost failed: the known reason, else the loss."""
    lost = F.concat(app_id, F.lit(" Driver "), address, F.lit(" disassociated!"))
    return F.coalesce(reason, lost)


def progress_ratio(
    started: Column, active: Column, completed: Column, total: Column, skipped: Column
) -> Column:
    """0.0 before the start, 100.0 with nothing active, else a plain fraction.

    The mixed scale is the reported value's own; ``progress_pct`` is the one to
    show to people. Null where nothing is left to divide by.
    """
    return (
        F.when(~started, F.lit(0.0))
        .when(~active, F.lit(100.0))
        .otherwise(F.try_divide(completed.cast("double"), (total - skipped).cast("double")))
    )


def progress_pct(completed: Column, total: Column, skipped_tasks: Column) -> Column:
    """Finished share of the tasks that have to run, 0 to 100."""
    return F.try_divide(completed * F.lit(100.0), (total - skipped_tasks).cast("double"))
