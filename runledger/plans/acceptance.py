"""SQL a user may say, as texts for ``run_sql``.

Nothing here is an operator of this library: each text shows that a feature of
the delegated dialect arrives at Spark unharmed. ``duckdb`` is the same query for
an independent engine and left out where the text is the same. Window queries
number or compare rows of pre-aggregated groups (days, brands), so the largest
window partition is bounded by the calendar or the catalogue, not by the rows.
Missing numbers are shown as -1 or 0, which both engines hand over alike.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Acceptance:
    tables: tuple[str, ...]
    spark: str
    duckdb: str | None = None

    @property
    def oracle(self) -> str:
        return self.duckdb or self.spark


ACCEPTANCE = {
    # projection, filter, predicates
    "literal": Acceptance(
        ("orders",),
        "select o_orderkey, 1+2 as three from orders",
    ),
    "project": Acceptance(
        ("customer",),
        """
        select c_custkey, c_custkey * 2 + 1 as next_odd, c_acctbal / 2 as half_balance,
               upper(c_mktsegment) as segment, c_nationkey as nation
        from customer
        """,
    ),
    "filter": Acceptance(
        ("part",),
        """
        select p_partkey, p_name, p_brand, p_size
        from part
        where p_size between 5 and 30 and p_name like '%ring%'
          and p_type in ('ECONOMY', 'STANDARD', 'PROMO')
        """,
    ),
    "case_null": Acceptance(
        ("customer",),
        """
        select c_custkey,
               case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'low'
                    else 'high' end as band,
               coalesce(nullif(c_mktsegment, 'MACHINERY'), 'none') as segment,
               coalesce(nullif(c_nationkey, 0), -1) as nation
        from customer
        """,
    ),
    # joins
    "join_inner": Acceptance(
        ("orders", "customer"),
        """
        select o.o_orderkey, o.o_orderpriority, c.c_name, c.c_mktsegment
        from orders o join customer c on o.o_custkey = c.c_custkey
        """,
    ),
    # Whole tables on both sides: the keys themselves leave some rows without a match.
    "join_left": Acceptance(
        ("orders", "customer"),
        """
        select c.c_custkey, c.c_name, coalesce(o.o_orderkey, -1) as o_orderkey
        from customer c left join orders o on c.c_custkey = o.o_orderkey
        """,
    ),
    "join_right": Acceptance(
        ("orders", "customer"),
        """
        select coalesce(c.c_custkey, -1) as c_custkey, o.o_orderkey, o.o_orderstatus
        from customer c right join orders o on c.c_custkey = o.o_orderkey
        """,
    ),
    "join_full": Acceptance(
        ("supplier", "part"),
        """
        select coalesce(s.s_suppkey, -1) as s_suppkey, coalesce(p.p_partkey, -1) as p_partkey,
               p.p_brand
        from supplier s full join part p on s.s_suppkey * 3 = p.p_partkey
        """,
    ),
    "join_semi": Acceptance(
        ("orders", "customer"),
        """
        select c.c_custkey, c.c_name from customer c
        left semi join orders o on c.c_custkey = o.o_custkey
        """,
        """
        select c.c_custkey, c.c_name from customer c
        semi join orders o on c.c_custkey = o.o_custkey
        """,
    ),
    # The customers without an order of a priority, for every priority there is.
    "join_anti": Acceptance(
        ("orders", "customer"),
        """
        with asked as (
          select c_custkey, c_name, o_orderpriority
          from customer lateral view inline_outer(
            (select collect_set(struct(o_orderpriority)) from orders)) p as o_orderpriority)
        select a.c_custkey, a.c_name, a.o_orderpriority
        from asked a left join orders o
          on a.c_custkey = o.o_custkey
             and a.o_orderpriority is not distinct from o.o_orderpriority
        where o.o_custkey is null
        """,
        """
        with asked as (
          select c_custkey, c_name, o_orderpriority
          from customer left join (select distinct o_orderpriority from orders) p on true)
        select a.c_custkey, a.c_name, a.o_orderpriority
        from asked a left join orders o
          on a.c_custkey = o.o_custkey
             and a.o_orderpriority is not distinct from o.o_orderpriority
        where o.o_custkey is null
        """,
    ),
    "join_theta": Acceptance(
        ("orders", "lineitem"),
        """
        select o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity
        from orders o join lineitem l
          on l.l_orderkey = o.o_orderkey and l.l_shipdate < o.o_orderdate
        """,
    ),
    # aggregation
    "agg_group": Acceptance(
        ("lineitem",),
        """
        select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty,
               round(sum(l_extendedprice * (1 - l_discount)), 4) as revenue,
               round(avg(l_extendedprice), 4) as avg_price,
               min(l_discount) as min_discount, max(l_tax) as max_tax,
               count(*) as n
        from lineitem
        group by l_returnflag, l_linestatus
        """,
    ),
    "agg_having": Acceptance(
        ("orders",),
        """
        select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total
        from orders group by o_custkey
        having count(*) > 3 and sum(o_totalprice) > 500000
        """,
    ),
    "agg_count_distinct": Acceptance(
        ("events",),
        """
        select event_type, count(distinct user_id) as users, count(*) as n
        from events group by event_type
        """,
    ),
    "select_distinct": Acceptance(
        ("customer",),
        "select distinct c_nationkey, c_mktsegment from customer",
    ),
    "grouping_sets": Acceptance(
        ("customer",),
        """
        select c_mktsegment, coalesce(c_nationkey, -1) as nation, count(*) as n,
               cast(grouping(c_mktsegment) as int) as all_segments,
               cast(grouping(c_nationkey) as int) as all_nations
        from customer
        group by grouping sets ((c_mktsegment), (c_nationkey), ())
        """,
    ),
    "rollup": Acceptance(
        ("lineitem",),
        """
        select l_returnflag, l_linestatus, count(*) as n,
               round(sum(l_quantity), 2) as sum_qty
        from lineitem group by rollup (l_returnflag, l_linestatus)
        """,
    ),
    "cube": Acceptance(
        ("lineitem",),
        """
        select l_returnflag, l_linestatus, count(*) as n,
               round(sum(l_quantity), 2) as sum_qty
        from lineitem group by cube (l_returnflag, l_linestatus)
        """,
    ),
    "agg_stats": Acceptance(
        ("lineitem",),
        """
        select l_returnflag, round(stddev_samp(l_quantity), 6) as sd_qty,
               round(var_pop(l_discount), 6) as var_discount,
               round(corr(l_quantity, l_extendedprice), 6) as qty_price
        from lineitem group by l_returnflag
        """,
    ),
    # windows over pre-aggregated rows
    "win_rank": Acceptance(
        ("orders",),
        """
        with days as (
          select o_orderpriority, cast(o_orderdate as date) as day, count(*) as n
          from orders group by o_orderpriority, cast(o_orderdate as date))
        select o_orderpriority, cast(day as string) as day, n,
               cast(row_number() over (partition by o_orderpriority
                                       order by n desc, day) as bigint) as row_no,
               cast(rank() over (partition by o_orderpriority
                                 order by n desc) as bigint) as rnk,
               cast(dense_rank() over (partition by o_orderpriority
                                       order by n desc) as bigint) as dense,
               cast(ntile(4) over (partition by o_orderpriority
                                   order by n desc, day) as bigint) as quarter
        from days
        """,
    ),
    "win_analytic": Acceptance(
        ("events",),
        """
        with hours as (
          select event_type, date_trunc('HOUR', ts) as hr, count(*) as n,
                 max(event_id) as last_event
          from events group by event_type, date_trunc('HOUR', ts))
        select event_type, last_event, n,
               coalesce(lag(n) over (partition by event_type order by hr), 0) as n_before,
               coalesce(lead(n) over (partition by event_type order by hr), 0) as n_after,
               first_value(n) over (partition by event_type order by hr) as n_first
        from hours
        """,
    ),
    "win_rows": Acceptance(
        ("events",),
        """
        with hours as (
          select event_type, date_trunc('HOUR', ts) as hr, count(*) as n,
                 max(event_id) as last_event
          from events group by event_type, date_trunc('HOUR', ts))
        select event_type, last_event,
               cast(sum(n) over (partition by event_type order by hr
                    rows between 2 preceding and current row) as bigint) as n_3
        from hours
        """,
    ),
    # sort and top-k: the limit is the feature
    "topk": Acceptance(
        ("lineitem",),
        """
        select l_orderkey, l_linenumber, l_partkey, l_extendedprice
        from lineitem
        order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey
        limit 10
        """,
    ),
    # set operations
    "union": Acceptance(
        ("customer", "supplier"),
        "select c_nationkey as nation from customer union select s_nationkey from supplier",
    ),
    "union_all": Acceptance(
        ("customer", "supplier"),
        """
        select 'customer' as kind, c_custkey as id, c_acctbal as balance from customer
        union all
        select 'supplier' as kind, s_suppkey as id, s_acctbal as balance from supplier
        """,
    ),
    "intersect": Acceptance(
        ("customer", "orders"),
        "select c_custkey as id from customer intersect select o_custkey from orders",
    ),
    "except": Acceptance(
        ("part", "supplier"),
        "select p_partkey as id from part except select s_suppkey from supplier",
    ),
    # query forms
    "cte": Acceptance(
        ("orders", "customer"),
        """
        with spending as (
          select o_custkey, round(sum(o_totalprice), 2) as total
          from orders group by o_custkey)
        select c.c_custkey, c.c_mktsegment, s.total
        from customer c join spending s on c.c_custkey = s.o_custkey
        """,
    ),
    "from_subquery": Acceptance(
        ("orders",),
        """
        select n_orders, count(*) as customers
        from (select o_custkey, count(*) as n_orders from orders group by o_custkey) per_customer
        group by n_orders
        """,
    ),
    # scalar functions
    "f_string": Acceptance(
        ("part",),
        """
        select p_partkey, substring(p_name, 2, 4) as piece,
               cast(length(p_name) as int) as name_length,
               replace(p_brand, 'Brand#', 'B') as brand,
               concat(p_type, '/', p_name) as label
        from part
        """,
    ),
    "f_date": Acceptance(
        ("orders",),
        """
        select o_orderkey, cast(year(o_orderdate) as int) as y,
               cast(month(o_orderdate) as int) as m,
               cast(cast(date_trunc('MONTH', o_orderdate) as date) as string) as month_start,
               cast(datediff(o_orderdate, date '1995-01-01') as bigint) as days
        from orders
        """,
        """
        select o_orderkey, cast(year(o_orderdate) as int) as y,
               cast(month(o_orderdate) as int) as m,
               cast(cast(date_trunc('MONTH', o_orderdate) as date) as varchar) as month_start,
               cast(datediff('day', date '1995-01-01', o_orderdate) as bigint) as days
        from orders
        """,
    ),
    "f_math": Acceptance(
        ("lineitem",),
        """
        select l_orderkey, l_linenumber, l_partkey,
               cast(floor(l_extendedprice) as bigint) as whole,
               round(sqrt(l_quantity), 6) as root, abs(l_discount - 0.5) as off_half,
               pow(l_quantity, 2) as squared
        from lineitem
        """,
        """
        select l_orderkey, l_linenumber, l_partkey,
               cast(floor(l_extendedprice) as bigint) as whole,
               round(sqrt(l_quantity), 6) as root,
               abs(l_discount - cast(0.5 as double)) as off_half,
               pow(l_quantity, 2) as squared
        from lineitem
        """,
    ),
    "f_json": Acceptance(
        ("events",),
        "select event_id, cast(get_json_object(props, '$.k') as int) as k from events",
        "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    ),
    "f_array": Acceptance(
        ("part",),
        """
        select p_partkey, size(split(p_name, ' ')) as words,
               array_contains(split(p_name, ' '), 'red') as is_red
        from part
        """,
        """
        select p_partkey, cast(len(string_split(p_name, ' ')) as int) as words,
               list_contains(string_split(p_name, ' '), 'red') as is_red
        from part
        """,
    ),
    "f_map": Acceptance(
        ("customer",),
        """
        select c_custkey, map('name', c_name, 'segment', c_mktsegment)['segment'] as segment
        from customer
        """,
        """
        select c_custkey,
               map {'name': c_name, 'segment': c_mktsegment}['segment'] as segment
        from customer
        """,
    ),
    "f_cast": Acceptance(
        ("orders",),
        """
        select o_orderkey, cast(cast(o_totalprice as decimal(12,2)) as string) as price,
               cast(o_custkey as string) as customer
        from orders
        """,
    ),
    # generator
    "explode": Acceptance(
        ("part",),
        """
        select p_partkey, pos, word
        from part lateral view posexplode(split(p_name, ' ')) w as pos, word
        """,
        """
        select p_partkey,
               cast(generate_subscripts(string_split(p_name, ' '), 1) - 1 as int) as pos,
               unnest(string_split(p_name, ' ')) as word
        from part
        """,
    ),
}
