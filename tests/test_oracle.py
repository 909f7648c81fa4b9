"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, TYPE_MAP, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    sc, sr = rows_of(sdf.toPandas(), 0.0)
    dc, dr = rows_of(rel.to_arrow_table().to_pandas(date_as_object=True), 0.0)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
    stypes = dict(sdf.dtypes)
    assert {c: TYPE_MAP.get(stypes[c], stypes[c]) for c in sc} == {c: dtypes[c] for c in sc}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert "net_ltv" in df.columns


def test_every_survey_id_is_registered():
    # Operators with an O check in SURVEY §2 need both a query and an oracle.
    oracle_ops = {
        "scan_count", "scan_features", "scan_scoring",
        "stg_customers", "stg_orders", "stg_events", "stg_churn_labels", "completed_orders", "clicked_events",
        "campaign_not_null", "labelled_only", "purchase_events",
        "ltv_join_orders", "ltv_join_churn", "attribute_orders", "campaign_join_revenue", "label_all_customers",
        "attribute_orders_asof",
        "order_stats", "mart_customer_ltv", "event_stats", "revenue_stats", "mart_campaign_performance",
        "mart_churn_summary", "count_if", "count_distinct_users", "conditional_sum", "group_ratio_pct",
        "latest_per_key", "value_counts", "table_summary", "scoring_summary", "target_rate", "null_census",
        "last_click", "top_campaigns", "top_churn_segments",
        "expect_row_count_between", "expect_not_null", "expect_unique", "expect_in_set", "expect_between",
        "run_suite", "raw_suites", "mart_suites", "schema_test_not_null", "schema_test_unique",
        "schema_test_accepted_values",
        "feature_columns", "fit_encoder", "apply_encoder", "stratified_split", "class_weight", "roc_auc",
        "classification_report",
        "clicked_flag", "orders_from_purchases", "churn_labels",
        "map_metric_names", "counter_increase", "counter_rate", "sum_over_series", "last_value",
        "threshold_band", "gauge_range", "label_filter", "success_vs_failure", "sla_miss",
    }
    assert oracle_ops <= set(E.queries())
    assert oracle_ops <= set(E.oracle_sql())


def test_reports_come_in_order(spark, duck):
    """The comparison above sorts rows; these two promise an order."""
    for name in ("top_campaigns", "top_churn_segments"):
        got = [tuple(r) for r in E.queries()[name](spark, SF).collect()]
        assert got == duck.sql(E.oracle_sql()[name]).fetchall()
