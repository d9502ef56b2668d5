"""What the plans look like: pushed, pruned, combined before the shuffle."""

import pytest

from runledger.functions import states
from runledger.operators import run_status as ops
from runledger.operators.statements import run_sql
from runledger.operators.throttle import throttled_report
from runledger.plans.registry import REGISTRY
from runledger.sources.run_status import run_status
from runledger.sources.tables import read_table, register_views

from pyspark.sql import functions as F

import folds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def feed(spark, sf):
    return run_status(read_table(spark, sf, "events"))


def test_filter_reaches_the_scan(spark, sf):
    text = plan(REGISTRY["filter"].run(spark, sf))
    assert "GreaterThanOrEqual(p_size,5)" in text
    assert "StringContains(p_name,ring)" in text
    assert "Batched: true" in text


def test_columns_are_pruned(spark, sf):
    text = plan(REGISTRY["agg_count_distinct"].run(spark, sf))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_constants_are_folded(spark, sf):
    register_views(spark, sf, ("orders",))
    text = plan(run_sql(spark, "select o_orderkey from orders where 1 + 1 = 2"))
    assert "Filter (" not in text


def test_small_side_is_broadcast_by_size(spark, sf):
    assert "BroadcastHashJoin" in plan(REGISTRY["join_inner"].run(spark, sf))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(REGISTRY["join_inner"].run(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


@pytest.mark.parametrize(
    "operator", [ops.current_state, ops.reconcile_state, ops.final_outcome, ops.failure_reason]
)
def test_one_row_per_run_combines_before_its_only_shuffle(feed, operator):
    df = operator(feed)
    assert exchanges(df) == 1
    assert "partial_" in plan(df)
    assert "Window" not in plan(df)
    assert "Python" not in plan(df) and "InArrow" not in plan(df)


def test_state_filter_reaches_a_stored_feed(spark, tmp_path):
    rows = spark.createDataFrame(folds.random_feed(1, 50), folds.FEED_SCHEMA)
    rows.write.parquet(f"{tmp_path}/feed")
    text = plan(ops.final_outcome(spark.read.parquet(f"{tmp_path}/feed")))
    assert "In(state, [" in text
    assert "progress" not in text


def test_stateless_rules_do_not_shuffle(feed):
    state = F.col("state")
    line = states.report_line(F.col("run_id").cast("string"), state, F.col("reason"))
    df = ops.state_flags(feed).select(line, states.known_state(state), "is_failed")
    assert "Exchange" not in plan(df)


def test_unknown_states_are_refused(spark):
    df = spark.createDataFrame([("FINISHED",), ("DONE",)], "state string")
    with pytest.raises(Exception, match="not a run state: DONE"):
        df.select(states.known_state(F.col("state"))).collect()


@pytest.mark.parametrize("slice_rows", [10, 1_000_000])
def test_rows_are_shuffled_once(feed, slice_rows):
    """Once for the rows; what the slices of a run tell each other is aggregated."""
    df = ops.running_progress(feed, slice_rows)
    if slice_rows == 1_000_000:
        assert exchanges(df) == 1
    else:
        assert exchanges(df) == 3
        assert "partial_max" in plan(df)
    # The step tables of slices are composed in jobs of their own, before this plan.
    rows = feed.select("run_id", "seq", "ts", "state")
    assert exchanges(throttled_report(rows, slice_rows=slice_rows)) == 1


def test_no_query_crosses_tables(spark, sf):
    for name, case in REGISTRY.items():
        if "stream" in name or name in ("run_batch", "run_batch_resumed", "write_result_text"):
            continue
        text = plan(case.run(spark, sf))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def anti_join_tables(spark, folder, orders):
    customers = [(7, "a"), (8, "b"), (9, "c"), (1, "d"), (1, "d"), (None, "e"), (6, None)]
    spark.createDataFrame(customers, "c_custkey long, c_name string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    register_views(spark, str(folder), ("customer", "orders"))
    return customers


def test_anti_join_takes_whole_tables(spark, tmp_path):
    """Both tables whole, nothing filtered before the join; keys that repeat or are null.

    For every priority the rows are those of the form that asked for one of them only.
    """
    orders = [(1, 7, "5-LOW"), (2, 7, "1-URGENT"), (3, 8, "5-LOW"), (4, None, None), (None, 9, "2-HIGH"), (5, 1, "5-LOW"), (5, 1, "5-LOW"), (6, 8, None)]
    anti_join_tables(spark, tmp_path, orders)
    found = REGISTRY["join_anti"].run(spark, str(tmp_path))
    assert "EqualTo" not in plan(found)
    for priority in {o[2] for o in orders}:
        one = "is null" if priority is None else f"= '{priority}'"
        first_form = spark.sql(f"""
            select c.c_custkey, c.c_name
            from customer c left join (select o_custkey from orders where o_orderpriority {one}) o
              on c.c_custkey = o.o_custkey
            where o.o_custkey is null""")
        got = found.where(f"o_orderpriority {one}").select("c_custkey", "c_name")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, first_form.collect()))
    low = found.where("o_orderpriority = '5-LOW'").collect()
    assert sorted((r.c_custkey or 0, r.c_name or "") for r in low) == [(0, "e"), (6, ""), (9, "c")]
    assert {r.o_orderpriority for r in found.collect()} == {o[2] for o in orders}


def test_anti_join_without_orders(spark, tmp_path):
    customers = anti_join_tables(spark, tmp_path, [])
    found = REGISTRY["join_anti"].run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((*c, None)) for c in customers)
