"""Declared schemas of the four raw tables and their column lists.

Raw files are read with these schemas (no inference); staging then applies
the same casts the models declare.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("segment", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("acquisition_cost", T.DoubleType()),
        T.StructField("signup_date", T.DateType()),
    ]),
    "events": T.StructType([
        T.StructField("event_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("channel", T.StringType()),
        T.StructField("session_duration_seconds", T.LongType()),
        T.StructField("pages_viewed", T.LongType()),
        T.StructField("clicked_ad", T.BooleanType()),
        T.StructField("campaign_id", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("order_amount", T.DoubleType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("status", T.StringType()),
    ]),
    "churn_labels": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("is_churned", T.BooleanType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("last_activity_date", T.DateType()),
        T.StructField("days_since_last_order", T.LongType()),
    ]),
}

# File name -> raw table name.
RAW_FILES = {
    "customers.csv": "customers",
    "events.csv": "events",
    "orders.csv": "orders",
    "churn_labels.csv": "churn_labels",
}

# Model features (fixed values of the churn model).
NUMERIC_FEATURES = [
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "customer_lifespan_days",
    "net_ltv",
    "age",
    "acquisition_cost",
]
CATEGORICAL_FEATURES = ["segment", "region"]
ALL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TARGET = "is_churned"
