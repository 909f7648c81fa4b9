"""Physical-plan properties of every registered query: no cross or
nested-loop joins, no Python evaluation, and the scan-level pushdowns the
design relies on."""

import pytest

import __spark_entry__ as E
from tidemark.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
SKIP = {"train_churn", "score_customers"}   # Spark ML stages; checked in test_ml
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # untruncated scan details
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SKIP))
def test_no_cross_join_no_python(spark, name):
    plan = _plan(spark, name)
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_staging_filters_reach_the_scan(spark):
    plan = _plan(spark, "stg_orders")
    assert "GreaterThan(o_totalprice,0.0)" in plan and "IsNotNull(o_orderkey)" in plan


def test_clicks_filter_and_pruning_reach_the_scan(spark):
    plan = _plan(spark, "last_click")
    assert "In(event_type, [click,purchase])" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_per_customer_aggregates_combine_before_the_shuffle(spark):
    for name in ("order_stats", "last_click", "latest_per_key"):
        plan = _plan(spark, name)
        assert "partial_" in plan, name
