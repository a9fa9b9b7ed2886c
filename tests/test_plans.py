"""Physical-plan guards for every SQL-checked query: no Cartesian products,
no nested-loop joins, no row-at-a-time Python UDFs; and scans are pruned."""

import pytest

import __spark_entry__ as E

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_plan_shape(spark, sf001, name):
    df = E.queries()[name](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_scan_reads_only_needed_columns(spark, sf001):
    df = E.queries()["count_two_keys"](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan


def test_filter_reaches_scan(spark, sf001):
    df = E.queries()["bbox"](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), IsNotNull(user_id), GreaterThanOrEqual(value,10.0)" in plan
