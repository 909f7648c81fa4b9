"""Derived source tables (D-1 to D-3, A11, J5).

These are the three pieces of data work inside the reference's generator:
the click flag, one order per purchase event, and churn labels from the
latest purchase.  All are per-row projections or one aggregate keyed by
customer (partial aggregation before the shuffle, so a customer holding a
large share of the events sends one row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import elapsed_days, ts_literal

CLICK_TYPES = ["click", "purchase"]


def clicked_flag(events: DataFrame, type_col: str = "event_type",
                 campaign: F.Column | None = None) -> DataFrame:
    """D-1: ``clicked_ad = event_type in (click, purchase)``; campaign only when clicked."""
    clicked = F.col(type_col).isin(*CLICK_TYPES)
    out = events.withColumn("clicked_ad", clicked)
    if campaign is not None:
        out = out.withColumn("campaign_id", F.when(clicked, campaign))
    return out


def orders_from_purchases(events: DataFrame, id_col: str = "event_id",
                          customer_col: str = "customer_id", ts_col: str = "event_timestamp",
                          amount_col: str | None = None, number: bool = False) -> DataFrame:
    """D-2: one order per purchase event; customer and time copied.

    ``number=True`` numbers the orders 1..n in (time, event id) order, as the
    reference does, inside ranges of bounded size instead of one global window.
    """
    cols = [F.col(customer_col).alias("customer_id"), F.col(ts_col).alias("order_date")]
    if amount_col:
        cols.append(F.col(amount_col).cast("double").alias("order_amount"))
    purchases = events.where(F.col("event_type") == "purchase")
    if not number:
        return purchases.select(F.col(id_col).alias("order_id"), *cols)
    from ..functions.windows import numbered
    return numbered(purchases, [ts_col, id_col], name="order_id").select("order_id", *cols)


def latest_purchase(events: DataFrame, customer_col: str = "customer_id",
                    ts_col: str = "event_timestamp") -> DataFrame:
    """Latest purchase time per customer."""
    return (events.where(F.col("event_type") == "purchase")
            .groupBy(F.col(customer_col).alias("customer_id"))
            .agg(F.max(ts_col).alias("last_purchase_at")))


def churn_labels_from_purchases(customers: DataFrame, events: DataFrame, as_of: str,
                                cutoff_days: int = 30) -> DataFrame:
    """D-3 with J5.

    Every customer is looked up in the latest-purchase table (left join, one
    row per key on both sides).  Churned when the last purchase is older than
    ``as_of - cutoff_days``, or when there is none.  Without a purchase the
    activity date and day count stay null.  Extra customer columns pass
    through.
    """
    latest = latest_purchase(events)
    as_of_ts = ts_literal(as_of)
    cutoff = as_of_ts - F.make_dt_interval(F.lit(cutoff_days))
    last = F.col("last_purchase_at")
    return (customers.join(latest, "customer_id", "left")
            .withColumn("is_churned", last.isNull() | (last < cutoff))
            .withColumn("last_activity_date", F.to_date(last))
            .withColumn("days_since_last_order", elapsed_days(last, as_of_ts))
            .drop("last_purchase_at"))


def label_all_customers(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Each customer with its latest purchase time (null when none)."""
    return customers.select("customer_id").join(latest_purchase(events), "customer_id", "left")
