"""Staging models P1-P4 and the shared row filters P5-P9.

Each function is a single projection + filter over its raw table, so
Catalyst pushes the null / range predicates into the parquet or CSV scan and
prunes every column a later step does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _clean(column: str) -> str:
    """``clean_text`` in SQL."""
    return f"lower(btrim({column}, ' \\t\\n\\r'))"


#: The staging models: raw table, condition on its rows, columns as (SQL expression, name).  Read by the DataFrame
#: functions and by the catalog views alike.
MODELS: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "stg_customers": ("customers", "customer_id IS NOT NULL", [
        ("CAST(customer_id AS STRING)", "customer_id"),
        (_clean("email"), "email"),
        (_clean("name"), "name"),
        (_clean("segment"), "segment"),
        (_clean("region"), "region"),
        ("CAST(age AS BIGINT)", "age"),
        ("CAST(acquisition_cost AS DOUBLE)", "acquisition_cost"),
        ("to_date(signup_date)", "signup_date"),
    ]),
    "stg_orders": ("orders", "order_id IS NOT NULL AND customer_id IS NOT NULL AND CAST(order_amount AS DOUBLE) > 0D "
                             "AND NOT isnan(CAST(order_amount AS DOUBLE))", [
        ("CAST(order_id AS STRING)", "order_id"),
        ("CAST(customer_id AS STRING)", "customer_id"),
        ("CAST(order_amount AS DOUBLE)", "order_amount"),
        (_clean("status"), "status"),
        (_clean("product_category"), "product_category"),
        ("CAST(order_date AS TIMESTAMP_NTZ)", "ordered_at"),
        ("to_date(order_date)", "order_date"),
    ]),
    "stg_events": ("events", "event_id IS NOT NULL AND customer_id IS NOT NULL", [
        ("CAST(event_id AS STRING)", "event_id"),
        ("CAST(customer_id AS STRING)", "customer_id"),
        (_clean("event_type"), "event_type"),
        (_clean("channel"), "channel"),
        ("CAST(event_timestamp AS TIMESTAMP_NTZ)", "event_at"),
        ("to_date(event_timestamp)", "event_date"),
        ("CAST(session_duration_seconds AS BIGINT)", "session_duration_seconds"),
        ("CAST(pages_viewed AS BIGINT)", "pages_viewed"),
        ("CAST(clicked_ad AS BOOLEAN)", "clicked_ad"),
        (_clean("campaign_id"), "campaign_id"),
    ]),
    "stg_churn_labels": ("churn_labels", "customer_id IS NOT NULL", [
        ("CAST(customer_id AS STRING)", "customer_id"),
        ("CAST(is_churned AS BOOLEAN)", "is_churned"),
        ("CAST(churn_probability AS DOUBLE)", "churn_probability"),
        ("to_date(last_activity_date)", "last_activity_date"),
        ("CAST(days_since_last_order AS BIGINT)", "days_since_last_order"),
    ]),
}


def _staged(raw: DataFrame, model: str) -> DataFrame:
    _, condition, columns = MODELS[model]
    return raw.where(condition).selectExpr(*[f"{e} AS {name}" for e, name in columns])


def view_sql(model: str, layer: str = "raw") -> str:
    """The model as a query over the catalog's raw table."""
    table, condition, columns = MODELS[model]
    return f"SELECT {', '.join(f'{e} AS {name}' for e, name in columns)} FROM `{layer}`.`{table}` WHERE {condition}"


def stg_customers(raw: DataFrame) -> DataFrame:
    """P1."""
    return _staged(raw, "stg_customers")


def stg_orders(raw: DataFrame) -> DataFrame:
    """Amount must be positive; a null or NaN amount is dropped too."""
    return _staged(raw, "stg_orders")


def stg_events(raw: DataFrame) -> DataFrame:
    """P3."""
    return _staged(raw, "stg_events")


def stg_churn_labels(raw: DataFrame) -> DataFrame:
    """P4."""
    return _staged(raw, "stg_churn_labels")


# --- shared predicates -------------------------------------------------------

def is_completed() -> Column:
    """P5 (after cleaning)."""
    return F.col("status") == F.lit("completed")


def is_attributable_click() -> Column:
    """A click that names a campaign."""
    return (F.col("clicked_ad") == F.lit(True)) & F.col("campaign_id").isNotNull()


def completed_orders(stg_orders_df: DataFrame) -> DataFrame:
    return stg_orders_df.where(is_completed())


def clicked_events(stg_events_df: DataFrame) -> DataFrame:
    return stg_events_df.where(is_attributable_click())


def campaign_not_null(df: DataFrame) -> DataFrame:
    """P7."""
    return df.where(F.col("campaign_id").isNotNull())


def labelled_only(df: DataFrame, target: str = "is_churned") -> DataFrame:
    """P8."""
    return df.where(F.col(target).isNotNull())


def purchase_events(df: DataFrame, type_col: str = "event_type") -> DataFrame:
    """P9."""
    return df.where(F.col(type_col) == F.lit("purchase"))


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_customers": stg_customers(raw["customers"]),
        "stg_orders": stg_orders(raw["orders"]),
        "stg_events": stg_events(raw["events"]),
        "stg_churn_labels": stg_churn_labels(raw["churn_labels"]),
    }
