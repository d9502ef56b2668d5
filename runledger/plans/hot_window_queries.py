"""Window queries over raw rows, one key of which holds two fifths of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import hot_windows as hot
from runledger.plans.registered import Registered
from runledger.sources.tables import read_table

# Small enough to cut the keys of the test tables.
SLICE_ROWS = 500


def _win_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a priority, the two highest taken as one, by hundreds of their price, downwards."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(urgent, "high").otherwise(F.col("o_orderpriority")).alias("priority"),
        (-F.floor(F.col("o_totalprice") / 100)).alias("by_price"),
    )
    ranked = hot.ranked(orders, ["priority"], ["by_price"], ["by_price", "o_orderkey"], SLICE_ROWS)
    return ranked.select(
        "o_orderkey", "priority", F.col("row_no"), F.col("rank").alias("rnk"), F.col("dense_rank").alias("dense"),
        hot.tile(F.col("row_no"), F.col("n_rows"), 4).alias("quarter"),
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("view", "click"), "seen").otherwise(F.col("event_type"))
    events = read_table(spark, folder, "events").select(kind.alias("kind"), "ts", "event_id", "value")
    return hot.numbered(events, ["kind"], ["ts", "event_id"], SLICE_ROWS)


def _win_analytic(spark: SparkSession, folder: str) -> DataFrame:
    window = hot.block_window(["kind"])
    columns = {
        "id_before": F.lag("event_id").over(window),
        "id_after": F.lead("event_id").over(window),
    }
    near = hot.over_blocks(_events(spark, folder), ["kind"], columns, before=1, after=1, block_rows=SLICE_ROWS)
    whole = hot.with_first(near, ["kind"], "event_id", "id_first", block_rows=SLICE_ROWS)
    return whole.select("event_id", "kind", "id_before", "id_after", "id_first")


def _win_rows(spark: SparkSession, folder: str) -> DataFrame:
    frame = hot.block_window(["kind"]).rowsBetween(-2, 0)
    columns = {"sum_3": F.sum("value").over(frame)}
    rows = hot.over_blocks(_events(spark, folder), ["kind"], columns, before=2, block_rows=SLICE_ROWS)
    return rows.select("event_id", "kind", F.round("sum_3", 4).alias("sum_3"))


_KIND = "case when event_type in ('view', 'click') then 'seen' else event_type end"

HOT_WINDOW_QUERIES = {
    "win_rank_raw": Registered(
        _win_rank,
        """
        with orders_ as (
          select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'high'
                 else o_orderpriority end as priority, floor(o_totalprice / 100) as price
          from orders)
        select o_orderkey, priority,
               row_number() over (partition by priority order by price desc, o_orderkey) as row_no,
               rank() over (partition by priority order by price desc) as rnk,
               dense_rank() over (partition by priority order by price desc) as dense,
               ntile(4) over (partition by priority order by price desc, o_orderkey) as quarter
        from orders_
        """,
    ),
    "win_analytic_raw": Registered(
        _win_analytic,
        f"""
        with events_ as (select *, {_KIND} as kind from events)
        select event_id, kind,
               lag(event_id) over (partition by kind order by ts, event_id) as id_before,
               lead(event_id) over (partition by kind order by ts, event_id) as id_after,
               first_value(event_id) over (partition by kind order by ts, event_id) as id_first
        from events_
        """,
    ),
    "win_rows_raw": Registered(
        _win_rows,
        f"""
        with events_ as (select *, {_KIND} as kind from events)
        select event_id, kind,
               round(sum(value) over (partition by kind order by ts, event_id
                                      rows between 2 preceding and current row), 4) as sum_3
        from events_
        """,
    ),
}
