"""Registry of queries over the driver tables: name -> fn(spark, sf_dir).

Each entry composes library operators on the stand-in raw tables
(``sources.fixtures``).  Output columns match the DuckDB oracle in
``plans.oracle_queries`` by name; clock columns (``updated_at``) are left out
of compared output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution, derive, marts, metrics, ml, quality, runs, staging
from ..functions.memo import plan_memo
from ..sources import fixtures as fx
from ..session import ensure_checkpoint_dir
from ..schemas import ALL_FEATURES, RAW_FILES
from ..sources import raw as raw_io
from ..sources import store

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# --- shared building blocks ---------------------------------------------------

@plan_memo
def staged(spark, d) -> dict[str, DataFrame]:
    return staging.stage_all(fx.raw_tables(spark, d))


@plan_memo
def ltv(spark, d) -> DataFrame:
    s = staged(spark, d)
    return marts.mart_customer_ltv(s["stg_customers"], s["stg_orders"], s["stg_churn_labels"],
                                   with_updated_at=False)


# --- P: staging ---------------------------------------------------------------

@query("stg_customers")
def q_stg_customers(spark, d):
    return staging.stg_customers(fx.raw_customers(spark, d))


@query("stg_orders")
def q_stg_orders(spark, d):
    return staging.stg_orders(fx.raw_orders(spark, d))


@query("stg_events")
def q_stg_events(spark, d):
    return staging.stg_events(fx.raw_events(spark, d))


@query("stg_churn_labels")
def q_stg_churn_labels(spark, d):
    return staging.stg_churn_labels(fx.raw_churn_labels(spark, d))


@query("completed_orders")
def q_completed_orders(spark, d):
    return staging.completed_orders(q_stg_orders(spark, d))


@query("clicked_events")
def q_clicked_events(spark, d):
    return staging.clicked_events(q_stg_events(spark, d))


@query("campaign_not_null")
def q_campaign_not_null(spark, d):
    return staging.campaign_not_null(q_stg_events(spark, d)).select(
        "event_id", "customer_id", "campaign_id", "channel", "clicked_ad")


@query("labelled_only")
def q_labelled_only(spark, d):
    return staging.labelled_only(ltv(spark, d)).select("customer_id", "is_churned")


@query("purchase_events")
def q_purchase_events(spark, d):
    return staging.purchase_events(q_stg_events(spark, d)).select(
        "event_id", "customer_id", "event_at", "event_date")


# --- A / J / W: marts -----------------------------------------------------------

@query("order_stats")
def q_order_stats(spark, d):
    return marts.order_stats(q_stg_orders(spark, d))


@query("ltv_join_orders")
def q_ltv_join_orders(spark, d):
    s = staged(spark, d)
    o = marts.order_stats(s["stg_orders"])
    return s["stg_customers"].join(o, "customer_id", "left").select(
        "customer_id", F.coalesce("total_orders", F.lit(0).cast("long")).alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"))


@query("ltv_join_churn")
def q_ltv_join_churn(spark, d):
    s = staged(spark, d)
    return s["stg_customers"].join(s["stg_churn_labels"], "customer_id", "left").select(
        "customer_id", "churn_probability", "is_churned")


@query("mart_customer_ltv")
def q_mart_customer_ltv(spark, d):
    return ltv(spark, d)


@query("last_click")
def q_last_click(spark, d):
    return attribution.last_click(q_stg_events(spark, d))


@query("attribute_orders")
def q_attribute_orders(spark, d):
    s = staged(spark, d)
    return attribution.attribute_orders(s["stg_orders"], s["stg_events"])


@query("event_stats")
def q_event_stats(spark, d):
    return marts.event_stats(q_stg_events(spark, d))


@query("revenue_stats")
def q_revenue_stats(spark, d):
    s = staged(spark, d)
    return marts.revenue_stats(s["stg_orders"], s["stg_events"])


@query("campaign_join_revenue")
def q_campaign_join_revenue(spark, d):
    s = staged(spark, d)
    es = marts.event_stats(s["stg_events"])
    rs = marts.revenue_stats_by_order(attribution.attribute_orders(s["stg_orders"], s["stg_events"]))
    return es.join(rs, "campaign_id", "left").select(
        "campaign_id", "channel", "total_clicks", "attributed_orders", "attributed_revenue")


@query("mart_campaign_performance")
def q_mart_campaign_performance(spark, d):
    s = staged(spark, d)
    return marts.mart_campaign_performance(s["stg_events"], s["stg_orders"], with_updated_at=False)


@query("mart_churn_summary")
def q_mart_churn_summary(spark, d):
    return marts.mart_churn_summary(ltv(spark, d), with_updated_at=False)


@query("top_campaigns")
def q_top_campaigns(spark, d):
    return marts.top_campaigns(q_mart_campaign_performance(spark, d)).select(
        "campaign_id", "channel", "attributed_revenue")


@query("top_churn_segments")
def q_top_churn_segments(spark, d):
    return marts.top_churn_segments(q_mart_churn_summary(spark, d)).select(
        "segment", "region", "churn_rate_pct")


@query("count_if")
def q_count_if(spark, d):
    e = q_stg_events(spark, d)
    return e.groupBy("event_type").agg(F.count_if(F.col("clicked_ad")).alias("n_clicked"))


@query("count_distinct_users")
def q_count_distinct_users(spark, d):
    e = q_stg_events(spark, d)
    return e.groupBy("channel").agg(F.count_distinct("customer_id").alias("unique_users"))


@query("conditional_sum")
def q_conditional_sum(spark, d):
    from ..functions.scalars import cond_money_sum
    l = ltv(spark, d)
    return l.groupBy("segment").agg(
        cond_money_sum(~F.col("is_churned"), "total_revenue").alias("active_revenue"))


@query("group_ratio_pct")
def q_group_ratio_pct(spark, d):
    from ..functions.scalars import ratio_pct
    l = ltv(spark, d)
    return l.groupBy("region").agg(
        ratio_pct(F.count_if(F.col("is_churned")), F.count("customer_id")).alias("churn_rate_pct"))


# --- D: derived sources -----------------------------------------------------------

@query("clicked_flag")
def q_clicked_flag(spark, d):
    e = fx.table(spark, d, "events")
    camp = F.concat(F.lit("camp_"), F.lpad((F.col("event_id") % 50 + 1).cast("string"), 4, "0"))
    return derive.clicked_flag(e, campaign=camp).select("event_id", "event_type", "clicked_ad", "campaign_id")


@query("orders_from_purchases")
def q_orders_from_purchases(spark, d):
    e = fx.table(spark, d, "events")
    return derive.orders_from_purchases(e, customer_col="user_id", ts_col="ts", amount_col="value")


@query("latest_per_key")
def q_latest_per_key(spark, d):
    return derive.latest_purchase(fx.raw_events(spark, d))


@query("label_all_customers")
def q_label_all_customers(spark, d):
    return derive.label_all_customers(fx.raw_customers(spark, d), fx.raw_events(spark, d))


@query("orders_numbered")
def q_orders_numbered(spark, d):
    e = fx.table(spark, d, "events")
    return derive.orders_from_purchases(e, customer_col="user_id", ts_col="ts", amount_col="value", number=True)


@query("churn_labels")
def q_churn_labels(spark, d):
    return fx.raw_churn_labels(spark, d)


def asof_inputs(spark, d):
    e = fx.table(spark, d, "events")
    orders = e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("ordered_at"), F.col("value").alias("order_amount"))
    clicks = e.where(F.col("event_type") == "click").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_at"),
        F.concat(F.lit("camp_"), F.lpad((F.col("event_id") % 50 + 1).cast("string"), 4, "0")).alias("campaign_id"))
    return orders, clicks


@query("attribute_orders_asof")
def q_attribute_orders_asof(spark, d):
    orders, clicks = asof_inputs(spark, d)
    return attribution.attribute_orders_asof(orders, clicks)


# --- Q: data quality ------------------------------------------------------------------

@plan_memo
def raw_fixture_tables(spark, d):
    return fx.raw_tables(spark, d)


def mart_tables(spark, d):
    """The three marts; the customer mart is written once, as in the daily run, and read by all that follow."""
    s = staged(spark, d)
    ensure_checkpoint_dir(spark)
    l = ltv(spark, d).checkpoint()
    return {
        "mart_customer_ltv": l,
        "mart_campaign_performance": marts.mart_campaign_performance(s["stg_events"], s["stg_orders"],
                                                                     with_updated_at=False),
        "mart_churn_summary": marts.mart_churn_summary(l, with_updated_at=False),
    }


def all_suites():
    suites = dict(quality.raw_suites(fx.FIXTURE_SEGMENTS))
    suites.update(quality.mart_suites())
    return suites


def _subset(kind):
    return {t: [c for c in cs if c.check == kind] for t, cs in all_suites().items()
            if any(c.check == kind for c in cs)}


def _suite_query(kind):
    def fn(spark, d):
        tables = dict(raw_fixture_tables(spark, d))
        tables.update(mart_tables(spark, d))
        return quality.run_suites(tables, _subset(kind))
    return fn


for _name, _kind in [("expect_row_count_between", quality.ROW_COUNT), ("expect_not_null", quality.NOT_NULL),
                     ("expect_unique", quality.UNIQUE), ("expect_in_set", quality.IN_SET),
                     ("expect_between", quality.BETWEEN)]:
    REGISTRY[_name] = _suite_query(_kind)


@query("run_suite")
def q_run_suite(spark, d):
    return quality.run_suite(fx.raw_customers(spark, d), "customers",
                             quality.raw_suites(fx.FIXTURE_SEGMENTS)["customers"])


@query("raw_suites")
def q_raw_suites(spark, d):
    return quality.run_suites(raw_fixture_tables(spark, d), quality.raw_suites(fx.FIXTURE_SEGMENTS))


@query("mart_suites")
def q_mart_suites(spark, d):
    return quality.run_suites(mart_tables(spark, d), quality.mart_suites())


def schema_models(spark, d):
    m = dict(staged(spark, d))
    m.update(mart_tables(spark, d))
    return m


def fixture_schema_tests():
    return quality.schema_tests([s.lower() for s in fx.FIXTURE_SEGMENTS])


def _schema_query(kind):
    def fn(spark, d):
        return quality.run_schema_tests(schema_models(spark, d),
                                        [t for t in fixture_schema_tests() if t[1] == kind])
    return fn


REGISTRY["schema_test_not_null"] = _schema_query("not_null")
REGISTRY["schema_test_unique"] = _schema_query("unique")
REGISTRY["schema_test_accepted_values"] = _schema_query("accepted_values")


@query("null_census")
def q_null_census(spark, d):
    out = None
    for name, df in raw_fixture_tables(spark, d).items():
        r = quality.null_census(df, name)
        out = r if out is None else out.unionByName(r)
    return out


@query("value_counts")
def q_value_counts(spark, d):
    raw = raw_fixture_tables(spark, d)
    return (quality.value_counts(raw["customers"], "customers", ["segment", "region"])
            .unionByName(quality.value_counts(raw["events"], "events", ["event_type"]))
            .unionByName(quality.value_counts(raw["orders"], "orders", ["status"])))


@query("table_summary")
def q_table_summary(spark, d):
    raw = raw_fixture_tables(spark, d)
    return quality.table_summary(raw["customers"], raw["events"], raw["orders"], raw["churn_labels"])


# --- M / S: churn model ------------------------------------------------------------------

@query("feature_columns")
def q_feature_columns(spark, d):
    return ml.feature_columns(ltv(spark, d))


@query("scan_features")
def q_scan_features(spark, d):
    return ml.scan_features(ltv(spark, d))


@query("scan_scoring")
def q_scan_scoring(spark, d):
    return ml.scan_scoring(ltv(spark, d))


@query("fit_encoder")
def q_fit_encoder(spark, d):
    return ml.fit_encoder(staging.labelled_only(ltv(spark, d)))


@query("apply_encoder")
def q_apply_encoder(spark, d):
    l = ltv(spark, d)
    enc = ml.fit_encoder(staging.labelled_only(l))
    return ml.apply_encoder(ml.scan_scoring(l), enc).select("customer_id", "segment_code", "region_code")


@query("stratified_split")
def q_stratified_split(spark, d):
    return ml.stratified_split(ml.scan_features(ltv(spark, d))).select("customer_id", "is_churned", "split")


@query("class_weight")
def q_class_weight(spark, d):
    s = ml.stratified_split(ml.scan_features(ltv(spark, d)))
    return ml.class_weight(s.where(F.col("split") == "train"))


@query("target_rate")
def q_target_rate(spark, d):
    return ml.target_rate(ltv(spark, d))


def fixture_scores(spark, d):
    """Fixture stand-in for model output: the label table's probability as score."""
    l = staging.labelled_only(ltv(spark, d))
    return l.select(F.col("is_churned").cast("int").alias("label"),
                    F.col("churn_probability").alias("score"),
                    (F.col("churn_probability") >= 0.5).cast("int").alias("prediction"))


@query("roc_auc")
def q_roc_auc(spark, d):
    return ml.roc_auc(fixture_scores(spark, d))


@query("classification_report")
def q_classification_report(spark, d):
    return ml.classification_report(fixture_scores(spark, d))


@query("scoring_summary")
def q_scoring_summary(spark, d):
    l = ltv(spark, d)
    scored = l.select("customer_id", "churn_probability",
                      (F.col("churn_probability") >= 0.5).alias("churn_prediction"))
    return ml.scoring_summary(scored)


def trained(spark, d):
    return ml.train_churn(spark, ml.scan_features(ltv(spark, d)))


@query("train_churn")
def q_train_churn(spark, d):
    """The run record; the learner's AUC is checked as a range."""
    _, rec = trained(spark, d)
    row = {k: rec[k] for k in ("train_rows", "test_rows", "churn_rate", "features")}
    row["auc_in_range"] = rec["auc"] is not None and 0.0 <= rec["auc"] <= 1.0
    return spark.createDataFrame([row], "train_rows long, test_rows long, churn_rate double, features string, "
                                        "auc_in_range boolean")


@query("score_customers")
def q_score_customers(spark, d):
    """Every customer scored; the learner's probabilities are checked by range and rule."""
    model, _ = trained(spark, d)
    p = F.col("churn_probability")
    return ml.score_customers(model, ml.scan_scoring(ltv(spark, d)), with_clock=False).select(
        "customer_id", p.between(0.0, 1.0).alias("in_range"),
        (F.col("churn_prediction") == (p >= 0.5)).alias("follows_rule"),
        (F.bround(p, 4) == p).alias("four_decimals"))


# --- T: pipeline metrics ---------------------------------------------------------------------

@query("map_metric_names")
def q_map_metric_names(spark, d):
    m = metrics.map_metric_names(fx.dotted_names(spark, d))
    return m.select("event_id", "name", "metric",
                    F.get(F.map_keys("labels"), 0).alias("label_name"),
                    F.get(F.map_values("labels"), 0).alias("label_value"))


def _no_labels(df):
    return df.drop("labels")


@query("counter_increase")
def q_counter_increase(spark, d):
    return _no_labels(metrics.counter_increase(fx.counter_samples(spark, d), "24 hours"))


@query("counter_rate")
def q_counter_rate(spark, d):
    return _no_labels(metrics.counter_rate(fx.counter_samples(spark, d), 300))


@query("counter_increase_at")
def q_counter_increase_at(spark, d):
    """The dashboard's "last 24 h" at an instant."""
    return _no_labels(metrics.counter_lookback(fx.counter_samples(spark, d), 86400, as_of="2024-01-20 06:30:00"))


@query("counter_rate_every")
def q_counter_rate_every(spark, d):
    """The dashboard's rate panels: a look-back of an hour at every quarter of an hour."""
    return _no_labels(metrics.counter_lookback(fx.counter_samples(spark, d), 3600, every_seconds=900))


@query("sum_over_series")
def q_sum_over_series(spark, d):
    return metrics.sum_over_series(metrics.counter_increase(fx.counter_samples(spark, d), "24 hours"))


@query("last_value")
def q_last_value(spark, d):
    s = fx.counter_samples(spark, d).unionByName(fx.gauge_samples(spark, d))
    lv = metrics.last_value(s)
    return lv.select("metric", F.col("labels")["pool"].alias("pool"), "ts", "value")


@query("threshold_band")
def q_threshold_band(spark, d):
    inc = metrics.counter_increase(fx.counter_samples(spark, d), "24 hours")
    rate = metrics.counter_rate(fx.counter_samples(spark, d), 120)
    a = inc.select("metric", "window_start", (F.col("increase") / 100.0).alias("value"),
                   metrics.threshold_band(F.col("increase") / 100.0, metrics.FAILURE_STEPS).alias("band"))
    b = rate.select("metric", "window_start", F.col("rate").alias("value"),
                    metrics.threshold_band(F.col("rate"), metrics.HEARTBEAT_STEPS).alias("band"))
    return a.withColumn("panel", F.lit("increase_24h")).unionByName(b.withColumn("panel", F.lit("rate_2m")))


@query("gauge_range")
def q_gauge_range(spark, d):
    g = metrics.gauge_range(fx.gauge_samples(spark, d), fx.GAUGES, fx.FIXTURE_AS_OF)
    return g.select("metric", F.col("labels")["pool"].alias("pool"), "ts", "seq", "value")


@query("label_filter")
def q_label_filter(spark, d):
    return metrics.label_filter(fx.gauge_samples(spark, d), fx.GAUGES, "pool", "default_pool")


@query("success_vs_failure")
def q_success_vs_failure(spark, d):
    s = fx.counter_samples(spark, d)
    return _no_labels(metrics.success_vs_failure(s, "events_purchase_total", "events_error_total", 300))


@query("sla_miss")
def q_sla_miss(spark, d):
    return metrics.sla_miss(fx.run_table(spark, d))


def _late(spark, d):
    attempts = fx.task_runs(spark, d)
    return runs.sla_miss_blocking(attempts, runs.chain_edges(attempts), fx.RUNS_AS_OF, "30 days")


@query("sla_miss_blocking")
def q_sla_miss_blocking(spark, d):
    """Late tasks at an instant, with the unfinished tasks that hold them back."""
    return _late(spark, d).withColumn("blocking_tasks", F.concat_ws(", ", "blocking_tasks"))


@query("sla_miss_report")
def q_sla_miss_report(spark, d):
    report = runs.sla_miss_report(_late(spark, d))
    return report.withColumns({c: F.concat_ws(", ", c) for c in ("missed_tasks", "blocking_tasks")})


# --- S: sources and sinks ----------------------------------------------------------------

@query("scan_count")
def q_scan_count(spark, d):
    out = None
    for name, df in mart_tables(spark, d).items():
        r = raw_io.scan_count(df).select(F.lit(name).alias("table_name"), "row_count")
        out = r if out is None else out.unionByName(r)
    return out


@query("scan_sample")
def q_scan_sample(spark, d):
    """An unordered LIMIT: which rows come is open, how many is not."""
    return raw_io.scan_count(raw_io.scan_sample(ltv(spark, d).select("customer_id"), 100_000))


@query("limit")
def q_limit(spark, d):
    return raw_io.scan_count(raw_io.scan_sample(q_mart_campaign_performance(spark, d), 100_000))


@query("file_inventory")
def q_file_inventory(spark, d):
    names = ["customer", "nation", "region", "orders", "events"]
    return raw_io.file_inventory(spark, {n: f"{d.rstrip('/')}/{n}.parquet" for n in names}).select(
        "table_name", "row_count", "column_count")


@query("quality_gate")
def q_quality_gate(spark, d):
    """Q7 as rows: the checks that would stop the run."""
    return quality.failing(quality.run_suites(raw_fixture_tables(spark, d), quality.raw_suites(fx.FIXTURE_SEGMENTS)))


@query("null_gate")
def q_null_gate(spark, d):
    """Q13 as rows: tables with nulls outside the allowed columns."""
    out = None
    for name, df in raw_fixture_tables(spark, d).items():
        keep = [c for c in df.columns if (name, c) != ("events", "campaign_id")]
        r = quality.null_census(df.select(*keep), name)
        out = r if out is None else out.unionByName(r)
    return quality.null_gate_failures(out)


@query("staging_views")
def q_staging_views(spark, d):
    """The staging models as views, counted by SQL."""
    parts = [spark.sql(f"SELECT '{v}' AS view_name, count(*) AS row_count FROM {v}")
             for v in raw_io.staging_views(spark, staged(spark, d))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _new_folder(spark) -> str:
    """A new folder beside the checkpoints, for queries that write files."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex}"


def _csv_files(spark, d) -> str:
    """The raw tables as header CSVs in the reference's shape."""
    folder = _new_folder(spark)
    tables = fx.raw_tables(spark, d)
    for file, name in RAW_FILES.items():
        (tables[name].write.option("header", True).option("escape", '"')
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{folder}/{file}"))
    return folder


@query("read_raw")
def q_read_raw(spark, d):
    """The events as CSV, read back by header name with the declared types."""
    return raw_io.read_raw(spark, _csv_files(spark, d), "events")


@query("load_raw")
def q_load_raw(spark, d):
    """The four files loaded and published together; the orders as the raw layer holds them."""
    raw_io.load_raw(spark, _csv_files(spark, d), warehouse := _new_folder(spark), register=False)
    return raw_io.read_table(spark, warehouse, "raw", "orders")


@query("write_mart")
def q_write_mart(spark, d):
    """The marts written and published as one release; the campaign mart read from it."""
    release = store.Release(spark, _new_folder(spark), "marts")
    for name, df in mart_tables(spark, d).items():
        release.write(df, name)
    release.publish(register=False)
    return store.read_layer(spark, release.warehouse, "marts")["mart_campaign_performance"]


@query("write_predictions")
def q_write_predictions(spark, d):
    """Predictions published twice, by the stand-in score; the second version is current."""
    warehouse = _new_folder(spark)
    scored = ltv(spark, d).select("customer_id", "churn_probability",
                                  (F.col("churn_probability") >= 0.5).alias("churn_prediction"))
    for rows in (scored.where("churn_prediction"), scored):
        raw_io.write_table(rows, warehouse, "marts", "ml_churn_predictions", register=False)
    return raw_io.read_table(spark, warehouse, "marts", "ml_churn_predictions")


@query("training_runs")
def q_training_runs(spark, d):
    """The record of a training that was repeated, without its clock."""
    folder = _new_folder(spark)
    parts = ml.stratified_split(ml.scan_features(ltv(spark, d)))
    found = parts.agg(F.count_if(F.col("split") == "train").alias("train_rows"),
                      F.count_if(F.col("split") == "test").alias("test_rows"),
                      F.avg(F.col("is_churned").cast("double")).alias("churn_rate")).first().asDict()
    record = found | {"churn_rate": round(found["churn_rate"], 4), "auc": None, "features": ",".join(ALL_FEATURES)}
    for run_id, rows in (("first", 0), ("second", 0), ("second", found["train_rows"])):
        ml.record_training_run(spark, record | {"train_rows": rows}, folder, run_id)
    return ml.training_runs(spark, folder).select("run_id", "train_rows", "test_rows", "churn_rate", "features")


@query("scalar_functions")
def q_scalar_functions(spark, d):
    """F1-F22 side by side on the order and customer tables."""
    from ..functions import scalars as sc
    o = fx.raw_orders(spark, d)
    amount, day = F.col("order_amount"), F.col("order_date")
    at = sc.ts_literal(fx.FIXTURE_AS_OF)
    padded = F.concat(F.lit(" \t "), F.upper("status"), F.lit("\n "))
    return o.select(
        F.col("order_id").cast("string").alias("f01_string"), F.col("order_id").cast("long").alias("f02_long"),
        amount.cast("double").alias("f03_double"), (F.col("order_id") % 2 == 0).cast("boolean").alias("f04_bool"),
        sc.clean_text(padded).alias("f05_clean"), F.to_date(day).alias("f06_date"),
        day.cast("timestamp_ntz").alias("f07_timestamp"),
        F.datediff(F.to_date(at), F.to_date(day)).cast("long").alias("f08_date_diff"),
        F.coalesce(F.when(amount > 100000, amount), F.lit(0.0)).alias("f09_coalesce"),
        sc.safe_divide(amount, F.col("order_id") % 3).alias("f10_safe_divide"), (amount / F.lit(7.0)).alias("f11_divide"),
        sc.round_half_up(amount / 7, 2).alias("f12_round"),
        sc.round_half_even(F.col("order_id") % 100 / F.lit(8.0), 1).alias("f13_half_even"),
        F.when(amount > 100000, "high").otherwise("low").alias("f14_case"),
        (F.when(F.col("order_id") % 3 > 0, amount > 100000) & F.lit(True)).alias("f15_three_valued"),
        (amount * 2 - 1).alias("f17_arithmetic"), sc.str_category(F.when(F.col("order_id") % 2 == 0, F.col("status")))
        .alias("f18_category"), F.col("status").isin("completed", "pending").alias("f19_member"),
        sc.elapsed_days(day.cast("timestamp_ntz"), at).alias("f20_elapsed_days"),
        (day.cast("timestamp_ntz") >= at - F.expr("INTERVAL 9000 DAYS")).alias("f21_lookback"))
