"""Plan-shape guarantees: pruning, pushdown, partial aggregation, one shuffle."""

import re

import pytest

import __spark_entry__ as E

from conftest import SMOKE_DIR


def plan_of(spark, name):
    return E.queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tumbling_avg_1m", "tumbling_hla_5m", "tumbling_hla_1d"])
def test_tumbling_is_partial_aggregate_with_one_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_sum" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "Expand" not in plan  # tumbling windows need no Expand


def test_panel_pushes_coin_and_time_range(spark):
    plan = plan_of(spark, "panel_high_low_5m")
    assert "EqualTo(event_type,purchase)" in plan
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan and "LessThan(ts,2024-01-22T00:05)" in plan


def test_stored_panel_prunes_partitions(spark):
    plan = plan_of(spark, "stored_panel_price_1m")
    assert re.search(r"PartitionFilters: \[isnotnull\(window_date#\d+\), \(window_date#\d+ >= 2024-01-08\)", plan)


def test_membership_is_pushed_in_list(spark):
    assert "In(event_type, [click,purchase,view]" in plan_of(spark, "symbol_filter")


def test_json_parse_runs_once_per_row(spark):
    plan = plan_of(spark, "quote_quarantine_counts")
    assert plan.count("from_json(") == 1


def test_no_cross_products_anywhere(spark):
    for name in E.queries():
        if name.startswith("stream_"):
            continue
        plan = plan_of(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
