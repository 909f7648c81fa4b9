"""Raw-table stand-ins derived from the driver's TPC-H-shaped parquet tables.

The driver tables have no marketing schema, so each raw table is a pure
column mapping of one driver table (plus the small nation/region lookup for
customers).  Every stand-in grows with its source table; nothing is
synthesised.  The DuckDB oracle applies the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ts_literal
from ..functions.joins import join_small_dimension
from ..functions.memo import plan_memo
from ..operators.derive import churn_labels_from_purchases

# Fixed values of the stand-in mapping.
CHANNELS = ["organic", "paid_search", "social", "email", "referral"]
FIXTURE_AS_OF = "2024-01-31 00:00:00"
FIXTURE_CUTOFF_DAYS = 7
FIXTURE_SEGMENTS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD", "FURNITURE"]
FIXTURE_SIGNUP_BASE = "2024-01-01"


@plan_memo
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@plan_memo
def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = join_small_dimension(n, r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "r_name")
    c = join_small_dimension(c, geo, c.c_nationkey == geo.n_nationkey, how="left")
    k = F.col("c_custkey")
    return c.select(
        k.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("customer_"), k.cast("string"), F.lit("@example.com")).alias("email"),
        (F.lit(18) + k % 52).cast("long").alias("age"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        ((F.lit(1000) + (k * 7919) % 49001) / F.lit(100.0)).cast("double").alias("acquisition_cost"),
        F.date_sub(F.lit(FIXTURE_SIGNUP_BASE).cast("date"), (k % 730).cast("int")).alias("signup_date"),
    )


@plan_memo
def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    status = (F.when(st == "F", "completed")
              .when(st == "O", "pending")
              .when(st == "P", F.when(F.col("o_orderkey") % 2 == 0, "cancelled").otherwise("refunded")))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderpriority").alias("product_category"),
        status.alias("status"),
    )


def channel_of(event_id) -> F.Column:
    b = F.floor(event_id / F.lit(50)) % 5
    expr = F.lit(CHANNELS[-1])
    for i in range(len(CHANNELS) - 2, -1, -1):
        expr = F.when(b == i, CHANNELS[i]).otherwise(expr)
    return expr


@plan_memo
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    clicked = F.col("event_type").isin("click", "purchase")
    return e.select(
        eid.alias("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type"),
        F.col("ts").alias("event_timestamp"),
        channel_of(eid).alias("channel"),
        (F.lit(5) + (eid * 31) % 1795).cast("long").alias("session_duration_seconds"),
        (F.lit(1) + eid % 19).cast("long").alias("pages_viewed"),
        clicked.alias("clicked_ad"),
        F.when(clicked, F.concat(F.lit("camp_"), F.lpad((eid % 50 + 1).cast("string"), 4, "0"))).alias("campaign_id"),
    )


def fixture_churn_probability(custkey) -> F.Column:
    return ((custkey * 7919) % 10001 / F.lit(10000.0)).cast("double")


@plan_memo
def raw_churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-3 applied to the driver events: purchases decide churn at ``as_of``."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        fixture_churn_probability(F.col("c_custkey")).alias("churn_probability"))
    purchases = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), F.col("event_type"), F.col("ts").alias("event_timestamp"))
    labels = churn_labels_from_purchases(customers, purchases,
                                         as_of=FIXTURE_AS_OF, cutoff_days=FIXTURE_CUTOFF_DAYS)
    return labels.select(
        "customer_id", "is_churned", "churn_probability", "last_activity_date", "days_since_last_order")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "events": raw_events(spark, sf_dir),
        "churn_labels": raw_churn_labels(spark, sf_dir),
    }


def as_of_literal():
    return ts_literal(FIXTURE_AS_OF)


# --- metric samples (FIXTURES §2) ----------------------------------------------------

# Gauge names by event_id % 3 and dotted-name prefixes by event_id % 10 (fixed values).
GAUGES = ["airflow_pool_open_slots", "airflow_pool_used_slots", "airflow_pool_starving_tasks"]
DOTTED_PREFIXES = [
    "airflow.dagrun.duration.success.",
    "airflow.dagrun.duration.failed.",
    "airflow.dagrun.schedule_delay.",
    "airflow.operator_successes_",
    "airflow.operator_failures_",
    "airflow.pool.open_slots.",
    "airflow.pool.used_slots.",
    "airflow.pool.starving_tasks.",
    "airflow.dag_processing.last_runtime.",
    "airflow.",
]
COUNTER_WRAP = 200


@plan_memo
def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters ``events_<type>_total``: running count per type, wrapping at 200 (resets)."""
    from ..functions.windows import running_count
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    # Minute buckets: a busy event type is numbered in many small slices.
    e = running_count(e, ["event_type"], ["ts", "event_id"], F.date_trunc("minute", F.col("ts")))
    return e.select(
        F.concat(F.lit("events_"), F.col("event_type"), F.lit("_total")).alias("metric"),
        F.create_map().cast("map<string,string>").alias("labels"),
        F.col("ts"), F.col("event_id").alias("seq"),
        (F.col("rn") % COUNTER_WRAP).cast("double").alias("value"))


@plan_memo
def gauge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 3
    metric = F.when(k == 0, GAUGES[0]).when(k == 1, GAUGES[1]).otherwise(GAUGES[2])
    pool = F.when(F.col("user_id") % 2 == 0, "default_pool").otherwise("other_pool")
    return e.select(metric.alias("metric"), F.create_map(F.lit("pool"), pool).alias("labels"),
                    F.col("ts"), F.col("event_id").alias("seq"), F.col("value").cast("double").alias("value"))


@plan_memo
def dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    k = F.col("event_id") % len(DOTTED_PREFIXES)
    prefix = F.lit(DOTTED_PREFIXES[-1])
    for i in range(len(DOTTED_PREFIXES) - 2, -1, -1):
        prefix = F.when(k == i, DOTTED_PREFIXES[i]).otherwise(prefix)
    return e.select("event_id", F.concat(prefix, F.col("event_type")).alias("name"))


@plan_memo
def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("run_id"), F.col("event_type").alias("task"),
                    F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("scheduled_at"),
                    F.col("ts").alias("finished_at"))


#: Instant of the late-task queries; orders and their lines run on after it.
RUNS_AS_OF = "2000-06-15 00:00:00"


@plan_memo
def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of the daily tasks: a DAG per order priority, a run per order date, an attempt per order line.

    The line number names the task (1 to 7), the ship date is the attempt's end."""
    from ..operators.runs import DAILY_TASKS
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    names = F.array(*[F.lit(t) for t in DAILY_TASKS])
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("orders_"), F.col("o_orderpriority")).alias("dag_id"), F.col("o_orderdate").alias("scheduled_at"),
        F.try_element_at(names, F.col("l_linenumber")).alias("task"), F.col("l_shipdate").alias("finished_at"))
