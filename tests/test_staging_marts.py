"""Inline edge rows the driver data does not contain."""

from pyspark.sql import functions as F

from helpers import T, churn, customer, event, order, raw
from tidemark.operators import attribution, marts, staging


def test_staging_drops_null_keys_and_bad_amounts(spark):
    c = raw(spark, "customers", [customer(1), (None, "x", "e", 1, "smb", "US", 1.0, None)])
    assert staging.stg_customers(c).count() == 1
    o = raw(spark, "orders", [order(1, 1, "2024-01-01 00:00:00", 10.0), order(2, 1, "2024-01-01 00:00:00", 0.0),
                              order(3, 1, "2024-01-01 00:00:00", -5.0), order(4, 1, "2024-01-01 00:00:00", None),
                              order(None, 1, "2024-01-01 00:00:00", 3.0), order(6, None, "2024-01-01 00:00:00", 3.0)])
    assert [r.order_id for r in staging.stg_orders(o).collect()] == ["1"]
    e = raw(spark, "events", [event("e1", 1, "click", "2024-01-01 00:00:00"), event(None, 1, "click", "2024-01-01 00:00:00"),
                              event("e3", None, "click", "2024-01-01 00:00:00")])
    assert staging.stg_events(e).count() == 1
    ch = raw(spark, "churn_labels", [churn(1, True), (None, False, 0.1, None, 1)])
    assert staging.stg_churn_labels(ch).count() == 1


def test_clean_text_trims_whitespace_and_lowercases(spark):
    c = raw(spark, "customers", [customer(1, segment="  SMB \t", region="US\n", name=" Ann  Lee\r"),
                                 customer(2, segment=None)])
    rows = {r.customer_id: r for r in staging.stg_customers(c).collect()}
    assert rows["1"].segment == "smb" and rows["1"].region == "us" and rows["1"].name == "ann  lee"
    assert rows["2"].segment is None


def _ltv(spark, customers, orders, labels):
    s = staging.stage_all({"customers": raw(spark, "customers", customers), "orders": raw(spark, "orders", orders),
                           "events": raw(spark, "events", []), "churn_labels": raw(spark, "churn_labels", labels)})
    return marts.mart_customer_ltv(s["stg_customers"], s["stg_orders"], s["stg_churn_labels"], with_updated_at=False)


def test_ltv_customer_without_orders_or_label(spark):
    ltv = _ltv(spark, [customer(1, cost=50.0), customer(2, cost=20.0)],
               [order(1, 1, "2024-01-01 10:00:00", 10.10), order(2, 1, "2024-01-05 09:00:00", 20.20),
                order(3, 1, "2024-01-06 09:00:00", 99.0, status="pending")],
               [churn(1, False, 0.9)])
    r = {x.customer_id: x for x in ltv.collect()}
    assert r["1"].total_orders == 2 and r["1"].total_revenue == 30.3 and r["1"].avg_order_value == 15.15
    assert r["1"].customer_lifespan_days == 4 and r["1"].net_ltv == 30.3 - 50.0
    assert r["2"].total_orders == 0 and r["2"].total_revenue == 0.0 and r["2"].customer_lifespan_days == 0
    assert r["2"].first_order_date is None and r["2"].is_churned is None and r["2"].net_ltv == -20.0


def test_churn_summary_null_label_counts_active_but_adds_no_revenue(spark):
    ltv = _ltv(spark, [customer(1), customer(2), customer(3)],
               [order(1, 1, "2024-01-01 00:00:00", 100.0), order(2, 2, "2024-01-01 00:00:00", 50.0),
                order(3, 3, "2024-01-01 00:00:00", 7.0)],
               [churn(1, False, 0.8), churn(2, True, 0.9)])
    r = marts.mart_churn_summary(ltv, with_updated_at=False).collect()[0]
    assert r.total_customers == 3 and r.churned_customers == 1 and r.active_customers == 2
    assert r.churn_rate_pct == 33.33
    assert r.high_risk_customers == 1 and r.revenue_at_risk == 100.0
    assert r.active_revenue == 100.0  # customer 3 has no label: not counted (D8)
    assert r.avg_churn_probability == 0.85


def _events_orders(spark, events, orders):
    s = staging.stage_all({"customers": raw(spark, "customers", []), "orders": raw(spark, "orders", orders),
                           "events": raw(spark, "events", events), "churn_labels": raw(spark, "churn_labels", [])})
    return s["stg_events"], s["stg_orders"]


def test_last_click_tie_goes_to_larger_event_id(spark):
    e, _ = _events_orders(spark, [event("evt_00000001", 1, "click", "2024-01-01 10:00:00", campaign="camp_a"),
                                  event("evt_00000002", 1, "click", "2024-01-01 10:00:00", campaign="camp_b"),
                                  event("evt_00000003", 1, "click", "2024-01-01 09:00:00", campaign="camp_c")], [])
    assert attribution.last_click(e).collect()[0].campaign_id == "camp_b"


def test_click_after_order_credited_by_last_click_not_by_asof(spark):
    e, o = _events_orders(spark, [event("e1", 1, "click", "2024-01-02 00:00:00", campaign="camp_a")],
                          [order(1, 1, "2024-01-01 00:00:00", 10.0), order(2, 2, "2024-01-03 00:00:00", 5.0)])
    j3 = {r.order_id: r.campaign_id for r in attribution.attribute_orders(o, e).collect()}
    assert j3 == {"1": "camp_a", "2": None}
    orders = o.select("order_id", "customer_id", "ordered_at")
    clicks = e.select("event_id", "customer_id", "event_at", "campaign_id")
    j6 = {r.order_id: r.campaign_id for r in attribution.attribute_orders_asof(orders, clicks).collect()}
    assert j6 == {"1": None, "2": None}


def test_asof_carries_clicks_across_buckets_and_counts_equal_time(spark):
    e, o = _events_orders(spark, [event("e1", 1, "click", "2024-01-01 00:00:00", campaign="camp_a"),
                                  event("e2", 1, "click", "2024-01-05 12:00:00", campaign="camp_b"),
                                  event("e3", 1, "click", "2024-01-07 00:00:00", campaign="camp_c")],
                          [order(1, 1, "2024-01-03 00:00:00", 1.0), order(2, 1, "2024-01-05 12:00:00", 1.0),
                           order(3, 1, "2024-01-06 23:59:59", 1.0), order(4, 1, "2023-12-31 00:00:00", 1.0)])
    orders = o.select("order_id", "customer_id", "ordered_at")
    clicks = e.select("event_id", "customer_id", "event_at", "campaign_id")
    got = {r.order_id: r.campaign_id for r in attribution.attribute_orders_asof(orders, clicks, segment_rows=1).collect()}
    assert got == {"1": "camp_a", "2": "camp_b", "3": "camp_b", "4": None}


def test_campaign_mart_zero_clicks_and_no_orders(spark):
    e, o = _events_orders(spark, [event("e1", 1, "page_view", "2024-01-01 00:00:00", campaign="camp_z", clicked=False),
                                  event("e2", 2, "click", "2024-01-01 00:00:00", campaign="camp_y", channel="social"),
                                  event("e3", 2, "click", "2024-01-01 01:00:00", campaign="camp_y", channel="email")],
                          [order(1, 2, "2024-01-02 00:00:00", 10.0), order(2, 2, "2024-01-03 00:00:00", 20.0),
                           order(3, 3, "2024-01-03 00:00:00", 20.0)])
    m = {(r.campaign_id, r.channel): r for r in marts.mart_campaign_performance(e, o, with_updated_at=False).collect()}
    z = m[("camp_z", "email")]
    assert z.total_clicks == 0 and z.conversion_rate_pct is None and z.attributed_orders == 0
    assert z.attributed_revenue == 0.0 and z.ctr_pct == 0.0
    # per-campaign revenue repeats on each channel row
    for ch in ("social", "email"):
        r = m[("camp_y", ch)]
        assert r.attributed_orders == 2 and r.attributed_revenue == 30.0 and r.avg_order_value == 15.0
        assert r.conversion_rate_pct == 200.0
    # both revenue formulations agree
    by_order = marts.revenue_stats_by_order(attribution.attribute_orders(o, e)).collect()
    assert {(r.campaign_id, r.attributed_orders, r.attributed_revenue) for r in by_order} == {("camp_y", 2, 30.0)}


def test_empty_inputs_give_empty_marts(spark):
    e, o = _events_orders(spark, [], [])
    assert marts.mart_campaign_performance(e, o).count() == 0
    assert _ltv(spark, [], [], []).count() == 0
