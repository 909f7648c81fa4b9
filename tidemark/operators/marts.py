"""Mart models: customer LTV (A1, A2, J1, J2), campaign performance
(A3-A5, J4) and churn summary (A6), plus read-time ordering (O1, O2).

Shuffle plan at scale
---------------------
* ``order_stats`` and ``last_click`` are both keyed by customer and both
  aggregate partially before their shuffle; the LTV joins are one row per
  key on every side, so a hot customer cannot skew them.
* Campaign revenue pre-aggregates completed orders per customer before
  meeting the one-row-per-customer last click (``revenue_stats``).  That is
  exact because each customer maps to at most one campaign, and it replaces
  an order-level join (skewed by hot customers) with a key-to-key join.
* ``event_stats`` uses ``count(distinct customer_id)``: Spark expands it into
  an aggregate on (campaign, channel, customer) followed by a partial merge
  on (campaign, channel), so a hot campaign still combines map-side.
* The per-campaign revenue side of J4 has one row per campaign; AQE turns
  the join into a broadcast from its measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (cond_money_sum, exact_avg, from_units, mean_from_units, money_avg, money_sum, money_units,
                                 ratio_pct, round_half_up, safe_divide, unit_sum)
from .attribution import attribute_orders, last_click
from .staging import completed_orders

HIGH_RISK_PROBABILITY = 0.7


def order_stats(stg_orders_df: DataFrame) -> DataFrame:
    """A1: per customer over completed orders."""
    o = completed_orders(stg_orders_df)
    return o.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        money_sum("order_amount").alias("total_revenue"),
        money_avg("order_amount").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.datediff(F.max("order_date"), F.min("order_date")).cast("long").alias("customer_lifespan_days"),
    )


def mart_customer_ltv(stg_customers_df: DataFrame, stg_orders_df: DataFrame,
                      stg_churn_df: DataFrame, with_updated_at: bool = True) -> DataFrame:
    """A2 = A1 + J1 + J2."""
    o = order_stats(stg_orders_df)
    ch = stg_churn_df.select("customer_id", "churn_probability", "is_churned")
    revenue = F.coalesce(F.col("total_revenue"), F.lit(0.0))
    cols = [
        "customer_id", "name", "email", "segment", "region", "age", "acquisition_cost", "signup_date",
        F.coalesce(F.col("total_orders"), F.lit(0).cast("long")).alias("total_orders"),
        revenue.alias("total_revenue"),
        F.coalesce(F.col("avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.coalesce(F.col("customer_lifespan_days"), F.lit(0).cast("long")).alias("customer_lifespan_days"),
        (revenue - F.col("acquisition_cost")).alias("net_ltv"),
        "churn_probability", "is_churned",
    ]
    if with_updated_at:
        cols.append(F.current_timestamp().alias("updated_at"))
    return (stg_customers_df
            .join(o, "customer_id", "left")   # J1
            .join(ch, "customer_id", "left")  # J2
            .select(*cols))


def event_stats(stg_events_df: DataFrame) -> DataFrame:
    """A3: per (campaign, channel) over events that name a campaign."""
    e = stg_events_df.where(F.col("campaign_id").isNotNull())
    clicks = F.count_if(F.col("clicked_ad"))
    return e.groupBy("campaign_id", "channel").agg(
        F.count("event_id").alias("total_impressions"),
        clicks.alias("total_clicks"),
        ratio_pct(clicks, F.count("event_id")).alias("ctr_pct"),
        F.count_distinct("customer_id").alias("unique_users_reached"),
    )


def revenue_stats(stg_orders_df: DataFrame, stg_events_df: DataFrame) -> DataFrame:
    """A4 over J3's attribution, pre-aggregated per customer (see module doc)."""
    per_customer = completed_orders(stg_orders_df).groupBy("customer_id").agg(
        F.count("order_id").alias("n"), unit_sum(money_units("order_amount")).alias("units"))
    lc = last_click(stg_events_df).select("customer_id", "campaign_id")
    attributed = per_customer.join(lc, "customer_id", "inner")
    n = F.sum("n")
    return attributed.groupBy("campaign_id").agg(
        n.alias("attributed_orders"),
        round_half_up(from_units(F.sum("units")), 2).alias("attributed_revenue"),
        round_half_up(mean_from_units(F.sum("units"), n), 2).alias("avg_order_value"),
    )


def revenue_stats_by_order(attributed_orders_df: DataFrame) -> DataFrame:
    """A4 literally: group J3's order rows by campaign."""
    a = attributed_orders_df.where(F.col("campaign_id").isNotNull())
    return a.groupBy("campaign_id").agg(
        F.count("order_id").alias("attributed_orders"),
        round_half_up(money_sum("order_amount"), 2).alias("attributed_revenue"),
        round_half_up(money_avg("order_amount"), 2).alias("avg_order_value"),
    )


def mart_campaign_performance(stg_events_df: DataFrame, stg_orders_df: DataFrame,
                              with_updated_at: bool = True) -> DataFrame:
    """A5 = A3 LEFT JOIN A4 USING (campaign_id) (J4); revenue repeats per channel."""
    es = event_stats(stg_events_df)
    rs = revenue_stats(stg_orders_df, stg_events_df)
    orders = F.coalesce(F.col("attributed_orders"), F.lit(0).cast("long"))
    cols = [
        "campaign_id", "channel", "total_impressions", "total_clicks", "ctr_pct", "unique_users_reached",
        orders.alias("attributed_orders"),
        F.coalesce(F.col("attributed_revenue"), F.lit(0.0)).alias("attributed_revenue"),
        F.coalesce(F.col("avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
        round_half_up(safe_divide(orders, F.col("total_clicks")) * F.lit(100.0), 2).alias("conversion_rate_pct"),
    ]
    if with_updated_at:
        cols.append(F.current_timestamp().alias("updated_at"))
    return es.join(rs, "campaign_id", "left").select(*cols)


def mart_churn_summary(ltv: DataFrame, with_updated_at: bool = True) -> DataFrame:
    """Per (segment, region); three-valued ``not is_churned`` kept."""
    churned = F.col("is_churned")
    active = ~churned
    high_risk = (F.col("churn_probability") > F.lit(HIGH_RISK_PROBABILITY)) & active
    total = F.count("customer_id")
    n_churned = F.count_if(churned)
    aggs = [
        total.alias("total_customers"),
        n_churned.alias("churned_customers"),
        (total - n_churned).alias("active_customers"),
        ratio_pct(n_churned, total).alias("churn_rate_pct"),
        round_half_up(exact_avg("churn_probability"), 4).alias("avg_churn_probability"),
        F.count_if(high_risk).alias("high_risk_customers"),
        round_half_up(cond_money_sum(active, "total_revenue"), 2).alias("active_revenue"),
        round_half_up(cond_money_sum(high_risk, "total_revenue"), 2).alias("revenue_at_risk"),
    ]
    if with_updated_at:
        aggs.append(F.current_timestamp().alias("updated_at"))
    return ltv.groupBy("segment", "region").agg(*aggs)


def top_campaigns(campaign_mart: DataFrame) -> DataFrame:
    """O1: sort at read time (a stored table keeps no order, D9)."""
    return campaign_mart.orderBy(F.col("attributed_revenue").desc(), "campaign_id", "channel")


def top_churn_segments(churn_summary: DataFrame) -> DataFrame:
    """O2."""
    return churn_summary.orderBy(F.col("churn_rate_pct").desc(), "segment", "region")


__all__ = [
    "order_stats", "mart_customer_ltv", "event_stats", "revenue_stats", "revenue_stats_by_order",
    "mart_campaign_performance", "mart_churn_summary", "top_campaigns", "top_churn_segments",
]
