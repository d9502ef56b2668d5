"""Run-status operators over the feed derived from ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import states
from runledger.operators import run_status as ops
from runledger.operators.throttle import throttled_report
from runledger.plans.registered import Registered
from runledger.operators.run_summary import run_events, run_summary, summarised, told
from runledger.operators.running_summary import report_lines, throttled_lines
from runledger.sources.run_status import mixed_status, run_status
from runledger.sources.shared import fresh_folder
from runledger.sources.tables import read_table, table_path
from runledger.streaming import late_rows, resume
from runledger.streaming import run_status as streams
from runledger.streaming.sinks import (
    append_available,
    read_summaries,
    read_updates,
    summaries_available,
    update_available,
)

DAY = 86400
# Small enough to cut every run of the test tables, to check the cut forms too.
TEST_SLICE_ROWS = 20


def _feed(spark: SparkSession, folder: str, two_feeds: bool = False) -> DataFrame:
    return run_status(read_table(spark, folder, "events"), two_feeds)


def _stream(spark: SparkSession, folder: str, two_feeds: bool = False) -> DataFrame:
    # The whole table is one micro-batch, whatever its size: over several, order of arrival counts.
    reader = spark.readStream.schema(read_table(spark, folder, "events").schema)
    # As a pattern, the path may name a single file as well as a folder of files.
    return run_status(reader.parquet(table_path(folder, "event[s]")), two_feeds)


def _updated(spark: SparkSession, rows: DataFrame) -> DataFrame:
    out = fresh_folder(spark, "updates")
    update_available(rows, out, fresh_folder(spark, "progress")).awaitTermination()
    return read_updates(spark, out)


def _appended(spark: SparkSession, rows: DataFrame) -> DataFrame:
    out = fresh_folder(spark, "appended")
    append_available(rows, out, fresh_folder(spark, "progress")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def _batch(
    operator: Callable[[DataFrame], DataFrame], *columns: str, two_feeds: bool = False
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(_feed(spark, folder, two_feeds)).selectExpr(*columns)


def _by_update(
    operator: Callable[[DataFrame], DataFrame], *columns: str, two_feeds: bool = False
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _updated(
        spark, operator(_stream(spark, folder, two_feeds))
    ).selectExpr(*columns)


def _by_append(
    operator: Callable[[DataFrame], DataFrame], *columns: str
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _appended(
        spark, operator(_stream(spark, folder)).selectExpr(*columns)
    )


def _progress_resumed(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_folder(spark, "resumed")
    feed = _stream(spark, folder).select("run_id", "seq", "ts", "progress")
    checkpoint = fresh_folder(spark, "progress")
    resume.running_progress_available(feed, out, checkpoint).awaitTermination()
    return resume.read_resumed(spark, out).select("run_id", "seq", "progress")


def _throttled_resumed(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_folder(spark, "resumed")
    feed = _stream(spark, folder).select("run_id", "seq", "ts", "state")
    checkpoint = fresh_folder(spark, "progress")
    resume.throttled_report_available(
        feed, out, checkpoint, heartbeat_seconds=DAY
    ).awaitTermination()
    return resume.read_resumed(spark, out).select("run_id", "seq", "state")


def _current_state_mixed(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("seq") % 3 != 0, F.col("state"))
    mixed = _feed(spark, folder).withColumn("state", state)
    return ops.current_state(mixed).select("run_id", "state", "seq")


def _progress_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of an order stand in for the tasks of a run."""
    counts = (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("l_linestatus") == "F").alias("completed"),
            F.count_if(F.col("l_returnflag") == "N").alias("skipped"),
        )
    )
    total, completed, skipped = F.col("total"), F.col("completed"), F.col("skipped")
    ratio = states.progress_ratio(completed > 0, completed < total, completed, total, skipped)
    pct = states.progress_pct(completed, total, skipped)
    return counts.select(
        "l_orderkey",
        F.round(F.coalesce(ratio, F.lit(-1.0)), 6).alias("progress"),
        F.round(F.coalesce(pct, F.lit(-1.0)), 6).alias("progress_pct"),
    )


def _report_line(spark: SparkSession, folder: str) -> DataFrame:
    app_id = F.when(F.col("state") != "SUBMITTED", F.concat(F.lit("app_"), "run_id"))
    line = states.report_line(app_id, F.col("state"), F.col("reason"))
    return _feed(spark, folder).select("run_id", "seq", line.alias("report"))


def _app_report_state(spark: SparkSession, folder: str) -> DataFrame:
    """Events as cluster reports; the final status follows from the value."""
    kind, value = F.col("event_type"), F.col("value")
    app_state = (
        F.when(kind == "error", "FAILED")
        .when(kind == "purchase", "KILLED")
        .when(kind == "click", "FINISHED")
        .when(kind == "view", "RUNNING")
        .otherwise("ACCEPTED")
    )
    final_status = (
        F.when(value < 5, "FAILED").when(value < 10, "KILLED").otherwise("UNDEFINED")
    )
    app_id = F.concat(F.lit("app_"), F.col("user_id"))
    report = states.app_report(app_id, app_state, final_status)
    return (
        read_table(spark, folder, "events")
        .select("event_id", report.alias("report"))
        .select("event_id", "report.state", "report.reason")
    )


def _disconnect_reason(spark: SparkSession, folder: str) -> DataFrame:
    reason = states.disconnect_reason(
        F.col("reason"),
        F.concat(F.lit("app_"), "run_id"),
        F.concat(F.lit("node-"), "run_id", F.lit(":7077")),
    )
    return _feed(spark, folder).select("run_id", "seq", reason.alias("reason"))


def _throttled(feed: DataFrame) -> DataFrame:
    return throttled_report(feed.select("run_id", "seq", "ts", "state"), "state", DAY)


def _throttled_cut(feed: DataFrame) -> DataFrame:
    rows = feed.select("run_id", "seq", "ts", "state")
    return throttled_report(rows, "state", DAY, TEST_SLICE_ROWS)


def _progress_cut(feed: DataFrame) -> DataFrame:
    return ops.running_progress(feed, TEST_SLICE_ROWS)


def _throttled_stream(feed: DataFrame) -> DataFrame:
    rows = feed.select("run_id", "seq", "ts", "state")
    return streams.throttled_report_stream(rows, "state", DAY)


def _unordered(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of four files, each with rows from all times, one per micro-batch."""
    events, copy = read_table(spark, folder, "events"), fresh_folder(spark, "unordered")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4)).cast("int")
    for i in range(4):
        events.filter(part == i).coalesce(1).write.mode("append").parquet(copy)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(copy)


def _run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return run_summary(mixed_status(read_table(spark, folder, "events")))


def _lines(operator: Callable[..., DataFrame], **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(
        mixed_status(read_table(spark, folder, "events")), **options
    ).select("run_id", "seq", "line")


def _run_summary_updated(spark: SparkSession, folder: str) -> DataFrame:
    events = run_events(mixed_status(_unordered(spark, folder)))
    return told(_updated(spark, summarised(events)))


def _run_summary_merged(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_folder(spark, "summaries")
    events = run_events(mixed_status(_unordered(spark, folder)))
    summaries_available(events, out, fresh_folder(spark, "progress")).awaitTermination()
    return told(read_summaries(spark, out))


def _progress_late(spark: SparkSession, folder: str) -> DataFrame:
    out, feed = fresh_folder(spark, "late"), run_status(_unordered(spark, folder))
    late_rows.running_progress_changes(feed, out, fresh_folder(spark, "progress")).awaitTermination()
    return late_rows.read_changes(spark, out).select("run_id", "seq", "progress")


def _throttled_late(spark: SparkSession, folder: str) -> DataFrame:
    out, feed = fresh_folder(spark, "late"), run_status(_unordered(spark, folder))
    late_rows.throttled_report_changes(
        feed, out, fresh_folder(spark, "progress"), heartbeat_seconds=DAY
    ).awaitTermination()
    return late_rows.read_changes(spark, out).select("run_id", "seq", "state")


FEED = """
with run_status as (
  select event_id as seq, user_id as run_id, ts, value as progress,
         case event_type when 'signup' then 'SUBMITTED' when 'view' then 'LAUNCHING'
              when 'click' then 'RUNNING' when 'purchase' then 'FINISHED'
              when 'error' then 'FAILED' end as state,
         case when event_type = 'error' then 'boom' end as reason
  from events)
"""

STATE_FLAGS = FEED + """
select run_id, seq, state,
       state in ('PARSEFAILED', 'PLANFAILED', 'FAILED', 'KILLED') as is_failed,
       state = 'FINISHED' as is_succeeded,
       state in ('PARSEFAILED', 'PLANFAILED', 'FAILED', 'KILLED', 'FINISHED') as is_finished,
       state = 'STAGE_SUCCESSED' as is_stage_succeeded
from run_status
"""

CURRENT_STATE = FEED + """
select run_id, arg_max(state, (ts, seq)) as state, arg_max(seq, (ts, seq)) as seq
from run_status group by run_id
"""

# Every third row sends progress only.
CURRENT_STATE_MIXED = FEED.rstrip() + """,
mixed as (
  select run_id, ts, seq, case when seq % 3 <> 0 then state end as state from run_status)
select run_id,
       coalesce(arg_max(state, (ts, seq)) filter (where state is not null), 'UNKNOWN') as state,
       arg_max(seq, (ts, seq)) filter (where state is not null) as seq
from mixed group by run_id
"""

RECONCILE_STATE = """
with feed as (
  select event_id as seq, user_id as run_id, ts, event_type = 'view' as app_running,
         case event_type when 'signup' then 'SUBMITTED' when 'purchase' then 'SUBMITTED'
              when 'view' then 'RUNNING' when 'click' then 'FINISHED'
              when 'error' then 'FAILED' end as state
  from events),
seen as (
  select *, last_value(case when not app_running then state end ignore nulls) over (
           partition by run_id order by ts, seq
           rows between unbounded preceding and 1 preceding) as state_before
  from feed),
counted as (
  select run_id, arg_max(state, (ts, seq)) as state
  from seen where not app_running or state_before = 'SUBMITTED' group by run_id)
select r.run_id, coalesce(c.state, 'UNKNOWN') as state
from (select distinct run_id from feed) r left join counted c on c.run_id = r.run_id
"""

FINAL_OUTCOME = FEED + """
, ended as (
  select *, row_number() over (partition by run_id order by ts, seq) as nth
  from run_status
  where state in ('PARSEFAILED', 'PLANFAILED', 'FAILED', 'KILLED', 'FINISHED'))
select run_id, case when state = 'FINISHED' then 'FINISHED' else 'FAILED' end as outcome,
       case when state <> 'FINISHED' then reason end as reason, seq
from ended where nth = 1
"""

ENDED_RUNS = FEED + """
select distinct run_id from run_status
where state in ('PARSEFAILED', 'PLANFAILED', 'FAILED', 'KILLED', 'FINISHED')
"""

FAILURE_REASON = FEED + """
, failed as (
  select *, row_number() over (partition by run_id order by ts desc, seq desc) as nth
  from run_status where state in ('PARSEFAILED', 'PLANFAILED', 'FAILED', 'KILLED'))
select r.run_id, f.reason, coalesce(f.seq, -1) as seq
from (select distinct run_id from run_status) r
left join failed f on f.run_id = r.run_id and f.nth = 1
"""

RUNNING_PROGRESS = FEED + """
select run_id, seq,
       max(greatest(progress, 0)) over (
         partition by run_id order by ts, seq
         rows between unbounded preceding and current row) as progress
from run_status
"""

PROGRESS_RATIO = """
with counts as (
  select l_orderkey, count(*) as total,
         count(*) filter (where l_linestatus = 'F') as completed,
         count(*) filter (where l_returnflag = 'N') as skipped
  from lineitem group by l_orderkey)
select l_orderkey,
       round(coalesce(case when completed = 0 then 0 when completed = total then 100
             else cast(completed as double) / nullif(total - skipped, 0) end, -1), 6)
         as progress,
       round(coalesce(completed * 100.0 / nullif(total - skipped, 0), -1), 6)
         as progress_pct
from counts
"""

THROTTLED_REPORT = FEED.replace("with run_status", "with recursive run_status") + f"""
, numbered as (
  select run_id, seq, ts, state,
         row_number() over (partition by run_id order by ts, seq) as nth
  from run_status),
walk as (
  select run_id, nth, seq, state, true as kept, state as kept_state, ts as kept_ts
  from numbered where nth = 1
  union all
  select n.run_id, n.nth, n.seq, n.state,
         n.state <> w.kept_state or n.ts > w.kept_ts + interval {DAY} second,
         case when n.state <> w.kept_state or n.ts > w.kept_ts + interval {DAY} second
              then n.state else w.kept_state end,
         case when n.state <> w.kept_state or n.ts > w.kept_ts + interval {DAY} second
              then n.ts else w.kept_ts end
  from walk w join numbered n on n.run_id = w.run_id and n.nth = w.nth + 1)
select run_id, seq, state from walk where kept
"""

REPORT_LINE = FEED + """
select run_id, seq,
       concat(case when state <> 'SUBMITTED' then concat('app_', run_id, ': ') else '' end,
              state, case when reason is not null then concat(' ', reason) else '' end)
         as report
from run_status
"""

APP_REPORT_STATE = """
with reports as (
  select event_id, concat('app_', user_id) as app_id,
         case event_type when 'error' then 'FAILED' when 'purchase' then 'KILLED'
              when 'click' then 'FINISHED' when 'view' then 'RUNNING'
              else 'ACCEPTED' end as app_state,
         case when value < 5 then 'FAILED' when value < 10 then 'KILLED'
              else 'UNDEFINED' end as final_status
  from events)
select event_id,
       case when 'FAILED' in (app_state, final_status) then 'FAILED'
            when 'KILLED' in (app_state, final_status) then 'FAILED'
            when app_state in ('FINISHED', 'RUNNING') then app_state end as state,
       case when 'FAILED' in (app_state, final_status) then concat('Job ', app_id, ' FAILED.')
            when 'KILLED' in (app_state, final_status) then concat('Job ', app_id, ' KILLED.')
       end as reason
from reports
"""

DISCONNECT_REASON = FEED + """
select run_id, seq,
       coalesce(reason, concat('app_', run_id, ' Driver node-', run_id,
                               ':7077 disassociated!')) as reason
from run_status
"""

# The feed read row by row: a message, a report or a loss after the other changes what is known.
RUN_SUMMARY = """
with recursive feed as (
  select event_id as seq, user_id as run_id, value as v, event_type as e, concat('app_', user_id) as app,
         row_number() over (partition by user_id order by ts, event_id) as nth
  from events),
said as (
  select run_id, nth, seq,
         case when e = 'view' then 'app' when e = 'error' and v < 1.5 then 'lost' else 'query' end as src,
         case when e = 'view' and (v < 0.5 or v > 250) then 'FAILED'
              when e = 'view' and (v < 1 or v > 220) then 'KILLED'
              when e = 'view' and v < 1.5 then 'FINISHED' when e = 'view' and v < 60 then 'RUNNING'
              when e = 'signup' or e = 'click' and v <= 60 then 'SUBMITTED' when e = 'click' then 'LAUNCHING'
              when e = 'purchase' and v < 1 then 'FINISHED' when e = 'purchase' and v < 1.5 then 'PARSEFAILED'
              when e = 'purchase' then 'RUNNING' when e = 'error' and v between 1.5 and 2.9999999 then 'FAILED' end as said,
         app, concat('boom ', seq) as boom,
         concat(app, ' Driver node-', run_id % 7, ':7077 disassociated!') as gone
  from feed),
steps as (
  select run_id, nth, seq, src, said, gone, app,
         case when src = 'app' and said in ('FAILED', 'KILLED') then concat('Job ', app, ' ', said, '.')
              when src = 'query' and said = 'FAILED' then boom end as why,
         src = 'lost' or said in ('FAILED', 'KILLED', 'FINISHED', 'PARSEFAILED') as ends
  from said),
walk as (
  select run_id, cast(0 as bigint) as nth, 'UNKNOWN' as state, cast(null as varchar) as reason, false as app_over,
         cast(null as varchar) as outcome, cast(null as varchar) as outcome_reason,
         cast(null as varchar) as outcome_src, cast(null as bigint) as outcome_seq
  from feed group by run_id
  union all
  select w.run_id, s.nth,
         case when s.src = 'query' and s.said is not null then s.said
              when s.src = 'app' and not w.app_over and s.said in ('FAILED', 'KILLED') then 'FAILED'
              when s.src = 'app' and not w.app_over and s.said = 'FINISHED' then 'FINISHED'
              when s.src = 'app' and not w.app_over and s.said = 'RUNNING' and w.state = 'SUBMITTED' then 'RUNNING'
              else w.state end,
         case when s.src = 'lost' then coalesce(w.reason, s.gone)
              when s.src = 'query' or not w.app_over then coalesce(s.why, w.reason) else w.reason end,
         w.app_over or (s.src = 'app' and coalesce(s.ends, false)),
         case when w.outcome is not null or not coalesce(s.ends, false) or (s.src = 'app' and w.app_over) then w.outcome
              when s.src <> 'lost' and s.said = 'FINISHED' then 'FINISHED' else 'FAILED' end,
         case when w.outcome is not null or not coalesce(s.ends, false) or (s.src = 'app' and w.app_over) then w.outcome_reason
              when s.src = 'lost' then coalesce(w.reason, s.gone) else s.why end,
         case when w.outcome is not null or not coalesce(s.ends, false) or (s.src = 'app' and w.app_over) then w.outcome_src
              else s.src end,
         case when w.outcome is not null or not coalesce(s.ends, false) or (s.src = 'app' and w.app_over) then w.outcome_seq
              else s.seq end
  from walk w join steps s on s.run_id = w.run_id and s.nth = w.nth + 1),
ended as (select *, row_number() over (partition by run_id order by nth desc) as back from walk)
select run_id, state, coalesce(outcome, state) as settled_state, reason, outcome, outcome_reason, outcome_src, outcome_seq
from ended where back = 1
"""

_WALKED = RUN_SUMMARY[: RUN_SUMMARY.index("ended as (")]

# The line at each row, and which of them are said: changed, or a heartbeat after the last one said.
REPORT_LINES = _WALKED + """
lines as (
  select w.run_id, w.nth, s.seq, f.ts,
         concat(s.app, ': ', w.state, case when w.reason is not null then concat(' ', w.reason) else '' end) as line
  from walk w join steps s on s.run_id = w.run_id and s.nth = w.nth
  join (select event_id, ts from events) f on f.event_id = s.seq)
"""

THROTTLED_LINES = REPORT_LINES + f""",
says as (
  select run_id, nth, seq, line, true as kept, line as kept_line, ts as kept_ts from lines where nth = 1
  union all
  select n.run_id, n.nth, n.seq, n.line,
         n.line <> w.kept_line or n.ts > w.kept_ts + interval {DAY} second,
         case when n.line <> w.kept_line or n.ts > w.kept_ts + interval {DAY} second then n.line else w.kept_line end,
         case when n.line <> w.kept_line or n.ts > w.kept_ts + interval {DAY} second then n.ts else w.kept_ts end
  from says w join lines n on n.run_id = w.run_id and n.nth = w.nth + 1)
select run_id, seq, line from says where kept
"""

_flags = ("is_failed", "is_succeeded", "is_finished", "is_stage_succeeded")
_outcome = ("run_id", "outcome", "reason", "seq")
_reason = ("run_id", "reason", "coalesce(seq, -1) as seq")
_progress = ("run_id", "seq", "progress")
_report = ("run_id", "seq", "state")

RUN_STATUS_QUERIES = {
    "state_flags": Registered(_batch(ops.state_flags, *_report, *_flags), STATE_FLAGS),
    "current_state_mixed_feed": Registered(_current_state_mixed, CURRENT_STATE_MIXED),
    "current_state": Registered(_batch(ops.current_state, *_report), CURRENT_STATE),
    "reconcile_state": Registered(
        _batch(ops.reconcile_state, "run_id", "state", two_feeds=True), RECONCILE_STATE
    ),
    "final_outcome": Registered(_batch(ops.final_outcome, *_outcome), FINAL_OUTCOME),
    "running_progress": Registered(
        _batch(ops.running_progress, *_progress), RUNNING_PROGRESS
    ),
    "running_progress_cut": Registered(_batch(_progress_cut, *_progress), RUNNING_PROGRESS),
    "progress_ratio": Registered(_progress_ratio, PROGRESS_RATIO),
    "throttled_report": Registered(_batch(_throttled, *_report), THROTTLED_REPORT),
    "throttled_report_cut": Registered(_batch(_throttled_cut, *_report), THROTTLED_REPORT),
    "report_line": Registered(_report_line, REPORT_LINE),
    "app_report_state": Registered(_app_report_state, APP_REPORT_STATE),
    "disconnect_reason": Registered(_disconnect_reason, DISCONNECT_REASON),
    "failure_reason": Registered(_batch(ops.failure_reason, *_reason), FAILURE_REASON),
    "state_flags_stream": Registered(
        _by_append(ops.state_flags, *_report, *_flags), STATE_FLAGS
    ),
    "current_state_stream": Registered(
        _by_update(ops.current_state, *_report), CURRENT_STATE
    ),
    "reconcile_state_stream": Registered(
        _by_update(ops.reconcile_state, "run_id", "state", two_feeds=True), RECONCILE_STATE
    ),
    "final_outcome_stream": Registered(
        _by_update(ops.final_outcome, *_outcome), FINAL_OUTCOME
    ),
    "first_arrived_outcome_stream": Registered(
        _by_append(streams.first_arrived_outcome, "run_id"), ENDED_RUNS
    ),
    "failure_reason_stream": Registered(
        _by_update(ops.failure_reason, *_reason), FAILURE_REASON
    ),
    "run_summary": Registered(_run_summary, RUN_SUMMARY),
    "report_lines": Registered(_lines(report_lines), REPORT_LINES + "select run_id, seq, line from lines"),
    "report_lines_cut": Registered(
        _lines(report_lines, slice_rows=TEST_SLICE_ROWS), REPORT_LINES + "select run_id, seq, line from lines"
    ),
    "throttled_lines": Registered(_lines(throttled_lines, heartbeat_seconds=DAY), THROTTLED_LINES),
    "throttled_lines_cut": Registered(
        _lines(throttled_lines, heartbeat_seconds=DAY, slice_rows=TEST_SLICE_ROWS), THROTTLED_LINES
    ),
    "run_summary_stream": Registered(_run_summary_updated, RUN_SUMMARY),
    "run_summary_merged_stream": Registered(_run_summary_merged, RUN_SUMMARY),
    "running_progress_late_stream": Registered(_progress_late, RUNNING_PROGRESS),
    "throttled_report_late_stream": Registered(_throttled_late, THROTTLED_REPORT),
    "running_progress_stream": Registered(_progress_resumed, RUNNING_PROGRESS),
    "running_progress_keyed_stream": Registered(
        _by_append(streams.running_progress_stream, *_progress),
        RUNNING_PROGRESS,
    ),
    "throttled_report_stream": Registered(_throttled_resumed, THROTTLED_REPORT),
    "throttled_report_keyed_stream": Registered(
        _by_append(_throttled_stream, *_report), THROTTLED_REPORT
    ),
}
