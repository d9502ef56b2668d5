"""Statement operators, commands and user functions over the tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.row_text import row_json, row_text
from runledger.operators.batch import batch_outcomes, run_batch
from runledger.operators.run_log import read_run_log
from runledger.operators.overlaps import overlapping
from runledger.operators.run_status import final_outcome
from runledger.operators.statements import (
    classify_statement,
    collect_rows,
    result_schema,
    run_sql,
    stamp_run,
    unique_out_path,
    write_result_text,
)
from runledger.operators.user_aggregate import SKEWNESS, aggregated
from runledger.plans.registered import Registered
from runledger.plans.user_functions import register_functions
from runledger.sources.run_status import run_status
from runledger.sources.shared import fresh_folder
from runledger.sources.tables import read_table, register_views, table_path

# Revenue by nation of customers served by suppliers of their own nation.
LOCAL_REVENUE = """
select n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) as revenue,
       count(*) as n_lines
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join supplier on l_suppkey = s_suppkey and c_nationkey = s_nationkey
join nation on s_nationkey = n_nationkey
group by n_name
"""


def local_revenue(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("lineitem", "orders", "customer", "supplier", "nation"))
    return run_sql(spark, LOCAL_REVENUE)


def _statements(spark: SparkSession, folder: str) -> DataFrame:
    """One SQL text per order, in the forms that are told apart."""
    key = F.col("o_orderkey").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    where = F.concat(F.lit(" from orders where o_orderkey = "), key)
    query = (
        F.when(status == "F", F.concat(F.lit("SELECT o_custkey"), where))
        .when(status == "O", F.concat(F.lit("(select 'insert into' as word"), where, F.lit(")")))
        .otherwise(F.concat(F.lit("with x as (select 1"), where, F.lit(") select * from x")))
    )
    other = (
        F.when(status == "F", F.concat(F.lit("insert into kept select *"), where))
        .when(status == "O", F.concat(F.lit("with x as (select *"), where,
                                      F.lit(") INSERT  OVERWRITE kept select * from x")))
        .otherwise(F.concat(F.lit("selected "), key))
    )
    sql = (
        F.when(priority == "1-URGENT", query)
        .when(priority == "2-HIGH", F.concat(F.lit("/* not 'this' */ "), query))
        .when(priority == "3-MEDIUM", F.concat(F.lit("-- insert into\n  "), query))
        .when(priority == "5-LOW", F.concat(F.lit("  "), other))
        .otherwise(F.concat(F.lit("create view v as "), query))
    )
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("stmt_id"), sql.alias("sql")
    )


def _classify_statement(spark: SparkSession, folder: str) -> DataFrame:
    return classify_statement(_statements(spark, folder))


def _row_text(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("customer",))
    return row_text(run_sql(spark, ROW_TEXT_SQL))


def _row_json(spark: SparkSession, folder: str) -> DataFrame:
    """The lossless form, written and read back as the columns that it was made of."""
    register_views(spark, folder, ("customer",))
    result = run_sql(spark, ROW_TEXT_SQL)
    out = fresh_folder(spark, "json")
    row_json(result).write.text(out)
    read = F.from_json("value", result.schema).alias("row")
    return spark.read.text(out).select(read).select("row.*")


def _write_result_text(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("orders", "customer"))
    out = unique_out_path(fresh_folder(spark, "text"), 1)
    write_result_text(run_sql(spark, TEXT_SQL), out)
    return spark.read.text(out)


def _collect_rows(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("orders",))
    return collect_rows(run_sql(spark, COLLECT_SQL))


def _result_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Schema of a pivot, whose columns are the values found in the table."""
    customers = read_table(spark, folder, "customer")
    wide = customers.groupBy("c_nationkey").pivot("c_mktsegment").count()
    return result_schema(wide)


def _unique_out_path(spark: SparkSession, folder: str) -> DataFrame:
    runs = run_status(read_table(spark, folder, "events")).select("run_id").distinct()
    path = F.concat(F.lit(unique_out_path("/out", "")), "run_id").alias("path")
    return runs.select("run_id", path)


def _region_statements(spark: SparkSession, folder: str) -> DataFrame:
    """One statement per region, the last of them not SQL."""
    register_views(spark, folder, ("region", "nation", "customer"))
    sql = F.concat(
        F.when(F.col("r_name") == "MIDDLE EAST", "selec").otherwise("select"),
        F.lit(" c_custkey, n_name from customer join nation on c_nationkey = n_nationkey"),
        F.lit(" where n_regionkey = "),
        F.col("r_regionkey"),
    )
    return read_table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("stmt_id"), sql.alias("sql")
    )


def _logged(spark: SparkSession, log: str, out: str) -> DataFrame:
    """Outcome and lines written of each statement, and its rows in the log."""
    feed = read_run_log(spark, log)
    run_id = F.regexp_extract(F.col("_metadata.file_path"), r"/run-(\d+)/", 1)
    lines = (
        spark.read.text(f"{out}/run-*")
        .groupBy(run_id.cast("bigint").alias("run_id"))
        .agg(F.count("*").alias("n_lines"))
    )
    rows = feed.groupBy("run_id").agg(F.count("*").alias("n_logged"))
    return final_outcome(feed).join(lines, "run_id", "left").join(rows, "run_id").select(
        "run_id",
        F.col("first_state").alias("state"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        "n_logged",
    )


def _run_batch(spark: SparkSession, folder: str) -> DataFrame:
    statements = _region_statements(spark, folder)
    log, out = fresh_folder(spark, "log"), fresh_folder(spark, "results")
    run_batch(spark, statements, log, out)
    return _logged(spark, log, out).drop("n_logged")


def _run_batch_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """The same batch, left after three statements and begun again, its log compacted on the way."""
    statements = _region_statements(spark, folder)
    log, out = fresh_folder(spark, "log"), fresh_folder(spark, "results")
    outcomes = batch_outcomes(spark, statements, log, out, compact_every=2)
    for _ in range(3):
        next(outcomes)
    outcomes.close()
    for _ in batch_outcomes(spark, statements, log, out, deadline_seconds=3600, resume=True, compact_every=2):
        pass
    return _logged(spark, log, out)


def _stamp_run(spark: SparkSession, folder: str) -> DataFrame:
    """Of the time, only whether it lies after one noted before and not in the future."""
    runs = run_status(read_table(spark, folder, "events")).select("run_id").distinct()
    noted = F.lit(datetime.now(timezone.utc))
    timely = F.col("submitted_at").between(noted, F.current_timestamp())
    return stamp_run(runs, "localhost").select("run_id", "submit_host", timely.alias("timely"))


def _scan_direct(spark: SparkSession, folder: str) -> DataFrame:
    path = table_path(folder, "orders")
    return run_sql(spark, f"select o_orderkey, o_custkey from parquet.`{path}`")


def _scan_view(spark: SparkSession, folder: str) -> DataFrame:
    name = _fresh_name("orders")
    path = table_path(folder, "orders")
    run_sql(spark, f"create temporary view {name} using parquet options (path '{path}')")
    return run_sql(spark, f"select o_orderkey, o_custkey from {name}")


def _fresh_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def _ctas(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("orders",))
    name, location = _fresh_name("kept"), fresh_folder(spark, "ctas")
    run_sql(
        spark,
        f"create table {name} using parquet location '{location}' as"
        " select o_custkey, count(*) as n from orders group by o_custkey",
    )
    return _and_drop(spark, name)


def _and_drop(spark: SparkSession, name: str) -> DataFrame:
    """The rows of an external table whose name is not needed any more."""
    rows = spark.table(name)
    run_sql(spark, f"drop table {name}")
    return rows


def _insert(spark: SparkSession, folder: str, second: str) -> DataFrame:
    register_views(spark, folder, ("customer", "supplier"))
    name, location = _fresh_name("parties"), fresh_folder(spark, "insert")
    run_sql(
        spark,
        f"create table {name} (id bigint, name string) using parquet location '{location}'",
    )
    run_sql(spark, f"insert into {name} select c_custkey, c_name from customer")
    run_sql(spark, f"{second} {name} select s_suppkey, s_name from supplier")
    return _and_drop(spark, name)


def _insert_into(spark: SparkSession, folder: str) -> DataFrame:
    return _insert(spark, folder, "insert into")


def _insert_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return _insert(spark, folder, "insert overwrite")


def _insert_dir(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("part",))
    out = fresh_folder(spark, "dir")
    run_sql(
        spark,
        f"insert overwrite directory '{out}' using parquet"
        " select p_partkey, p_brand from part",
    )
    return spark.read.parquet(out)


def _cache_table(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ("orders",))
    name = _fresh_name("totals")
    run_sql(
        spark,
        f"cache table {name} options ('storageLevel' 'DISK_ONLY') as"
        " select o_orderpriority, count(*) as n from orders group by o_orderpriority",
    )
    # Written down, so that the cached table can be released again.
    out = fresh_folder(spark, "cached")
    cached = run_sql(spark, f"select o_orderpriority, n from {name}")
    cached.write.parquet(out)
    run_sql(spark, f"uncache table {name}")
    return spark.read.schema(cached.schema).parquet(out)


def _udf_scalar(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark)
    register_views(spark, folder, ("customer",))
    return run_sql(spark, "select c_custkey, plain_number(c_name) as number from customer")


def _udaf(spark: SparkSession, folder: str) -> DataFrame:
    """A Python aggregate sees whole groups: give it blocks, then add those up."""
    register_functions(spark)
    register_views(spark, folder, ("events",))
    return run_sql(
        spark,
        """
        select event_type, round(sum(part), 4) as squares
        from (select event_type, sum_squares(value) as part
              from events group by event_type, event_id div 100000) blocks
        group by event_type
        """,
    )


def _udtf(spark: SparkSession, folder: str) -> DataFrame:
    """A call of Python per row, so the rows of a table of few files are dealt over all tasks."""
    register_functions(spark)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read_table(spark, folder, "part").repartition(width).createOrReplaceTempView("part")
    return run_sql(
        spark, "select p_partkey, word, letters from part, lateral word_lengths(p_name)"
    )


def _udtf_batches(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark)
    register_views(spark, folder, ("part",))
    return run_sql(spark, "select * from words_of_table(table(select p_partkey, p_name from part))")


def _udtf_table(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark)
    register_views(spark, folder, ("events",))
    rows = "table(select user_id, ts from events)"
    found = run_sql(spark, f"select * from sessions({rows}, 'user_id', 'ts', {SESSION_GAP})")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("begin", "end")})


def _udaf_merged(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    skewness = aggregated(events, ["event_type"], "value", SKEWNESS, "skewness")
    return skewness.select("event_type", F.round("skewness", 6).alias("skewness"))


def _overlapping_visits(spark: SparkSession, folder: str) -> DataFrame:
    """A visit is what a user does in a day: how many other visits go on during each."""
    events = read_table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    visits = events.groupBy("user_id", "day").agg(F.min("ts").alias("begin"), F.max("ts").alias("end"))
    return overlapping(visits, ["user_id", "day"])


#: Seconds without a row after which a session has ended.
SESSION_GAP = 4 * 3600

SESSIONS_ORACLE = f"""
with steps as (
  select user_id, ts, case when ts - lag(ts) over w <= interval {SESSION_GAP} seconds then 0 else 1 end as new
  from events where ts is not null window w as (partition by user_id order by ts)
), numbered as (
  select *, cast(sum(new) over (partition by user_id order by ts rows unbounded preceding) as bigint) as session
  from steps
)
select user_id, session, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as begin,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as "end", count(*) as n_rows
from numbered group by 1, 2
"""

OVERLAPPING_ORACLE = """
with visits as (
  select user_id, strftime(ts, '%Y-%m-%d') as day, min(ts) as b, max(ts) as e from events group by 1, 2
)
select v.user_id, v.day, count(*) - 1 as n_overlapping
from visits v join visits o on o.b <= v.e and o.e >= v.b
group by 1, 2
"""

ROW_TEXT_SQL = "select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as s from customer"

TEXT_SQL = """
select o_orderkey, c_name, o_orderpriority
from orders join customer on o_custkey = c_custkey
"""

COLLECT_SQL = """
WITH totals AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT o_custkey, n FROM totals
"""

# The same noise and heads, in the regular expressions of the other engine.
CLASSIFY_ORACLE = r"""
with parts as (
  select o_orderkey, o_orderstatus as s, o_orderpriority as p,
         concat(' from orders where o_orderkey = ', o_orderkey) as w
  from orders),
texts as (
  select o_orderkey as stmt_id, p,
         case s when 'F' then concat('SELECT o_custkey', w)
                when 'O' then concat('(select ''insert into'' as word', w, ')')
                else concat('with x as (select 1', w, ') select * from x') end as query,
         case s when 'F' then concat('insert into kept select *', w)
                when 'O' then concat('with x as (select *', w,
                                     ') INSERT  OVERWRITE kept select * from x')
                else concat('selected ', o_orderkey) end as other
  from parts)
select stmt_id,
       case p when '1-URGENT' then query
              when '2-HIGH' then concat('/* not ''this'' */ ', query)
              when '3-MEDIUM' then concat('-- insert into', chr(10), '  ', query)
              when '5-LOW' then concat('  ', other)
              else concat('create view v as ', query) end as sql,
       p in ('1-URGENT', '2-HIGH', '3-MEDIUM') as is_result_query
from texts
"""

RESULT_SCHEMA_ORACLE = """
select cast(0 as int) as ordinal, 'c_nationkey' as name, 'int' as type, true as nullable
union all
select cast(row_number() over (order by c_mktsegment) as int), c_mktsegment, 'bigint', true
from (select distinct c_mktsegment from customer)
"""

RUN_BATCH_ORACLE = """
select cast(r_regionkey as bigint) as run_id,
       case when r_name = 'MIDDLE EAST' then 'PARSEFAILED' else 'FINISHED' end as state,
       count(c_custkey) filter (where r_name <> 'MIDDLE EAST') as n_lines
from region
left join nation on n_regionkey = r_regionkey
left join customer on c_nationkey = n_nationkey
group by r_regionkey, r_name
"""

STATEMENT_QUERIES = {
    "run_sql": Registered(local_revenue, LOCAL_REVENUE),
    "classify_statement": Registered(_classify_statement, CLASSIFY_ORACLE),
    "row_text": Registered(
        _row_text,
        """
        select concat('[', c_custkey, ',', c_name, ',',
                      coalesce(nullif(c_mktsegment, 'BUILDING'), 'null'), ']') as value
        from customer
        """,
    ),
    "write_result_text": Registered(
        _write_result_text,
        f"""
        select concat('[', o_orderkey, ',', c_name, ',', o_orderpriority, ']') as value
        from ({TEXT_SQL}) r
        """,
    ),
    "row_json": Registered(
        _row_json,
        "select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as s from customer",
    ),
    "collect_rows": Registered(
        _collect_rows,
        f"select concat('[', o_custkey, ',', n, ']') as value from ({COLLECT_SQL}) r",
    ),
    "result_schema": Registered(_result_schema, RESULT_SCHEMA_ORACLE),
    "unique_out_path": Registered(
        _unique_out_path,
        "select distinct user_id as run_id, concat('/out/run-', user_id) as path from events",
    ),
    "run_batch": Registered(_run_batch, RUN_BATCH_ORACLE),
    "run_batch_resumed": Registered(
        _run_batch_resumed, RUN_BATCH_ORACLE.replace(" as n_lines", " as n_lines, cast(2 as bigint) as n_logged")
    ),
    "stamp_run": Registered(
        _stamp_run,
        "select distinct user_id as run_id, 'localhost' as submit_host, true as timely from events",
    ),
    "scan_direct": Registered(_scan_direct, "select o_orderkey, o_custkey from orders"),
    "scan_view": Registered(_scan_view, "select o_orderkey, o_custkey from orders"),
    "ctas": Registered(
        _ctas, "select o_custkey, count(*) as n from orders group by o_custkey"
    ),
    "insert_into": Registered(
        _insert_into,
        """
        select c_custkey as id, c_name as name from customer
        union all select s_suppkey, s_name from supplier
        """,
    ),
    "insert_overwrite": Registered(
        _insert_overwrite, "select s_suppkey as id, s_name as name from supplier"
    ),
    "insert_dir": Registered(
        _insert_dir, "select p_partkey, p_brand from part"
    ),
    "cache_table": Registered(
        _cache_table,
        "select o_orderpriority, count(*) as n from orders group by o_orderpriority",
    ),
    "udf_scalar": Registered(
        _udf_scalar,
        "select c_custkey, cast(cast(substr(c_name, 10) as bigint) as varchar) as number"
        " from customer",
    ),
    "udaf": Registered(
        _udaf,
        "select event_type, round(sum(value * value), 4) as squares"
        " from events group by event_type",
    ),
    "udtf": Registered(
        _udtf,
        """
        select p_partkey, word, cast(length(word) as int) as letters
        from (select p_partkey, unnest(string_split(p_name, ' ')) as word from part) w
        """,
    ),
    "udtf_batches": Registered(
        _udtf_batches,
        """
        select p_partkey, word, cast(length(word) as int) as letters
        from (select p_partkey, unnest(string_split(p_name, ' ')) as word from part) w
        """,
    ),
    "udtf_table": Registered(_udtf_table, SESSIONS_ORACLE),
    "udaf_merged": Registered(
        _udaf_merged,
        """
        with means as (select event_type, avg(value) as mean from events group by event_type)
        select event_type,
               round(avg((value - mean) ** 3) / avg((value - mean) ** 2) ** 1.5, 6) as skewness
        from events join means using (event_type)
        group by event_type
        """,
    ),
    "overlapping_visits": Registered(_overlapping_visits, OVERLAPPING_ORACLE),
}
