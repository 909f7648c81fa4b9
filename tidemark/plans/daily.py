"""The daily pipeline and the weekly training job as plain function
composition (no scheduler: run the functions in order).

Daily: files present -> land (one CSV parse, which also gives the null gate,
the summary and the raw checks but for uniqueness) -> publish raw -> staging
views -> marts -> schema tests -> mart checks -> score.
Training: LTV mart -> encoders, split, weights, trees -> AUC + report ->
model + run record.

Each mart is written once to the warehouse and read back, which cuts the
lineage (a lost executor recomputes from the written table, not from the
raw files) and lets the LTV mart feed the churn summary, the checks and the
model without being recomputed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, ml, quality, staging
from ..schemas import RAW_FILES
from ..sources import raw as raw_io
from ..sources import store


@dataclass
class DailyResult:
    raw_report: DataFrame
    schema_report: DataFrame
    mart_report: DataFrame
    summary: DataFrame
    value_counts: DataFrame
    marts: dict
    predictions: DataFrame | None
    inventory: DataFrame
    scoring: DataFrame | None

    def profile(self) -> str:
        """The run's printed profile: files, table figures, value counts and scoring figures."""
        parts = [("files", self.inventory), ("tables", self.summary), ("value counts", self.value_counts),
                 ("scoring", self.scoring)]
        # Bounded: a row per table, a row per category, one row.
        return "\n\n".join(f"{name}\n{df.toPandas().to_string(index=False)}" for name, df in parts if df is not None)


def run_daily(spark: SparkSession, raw_dir: str, warehouse: str, *,
              segments=quality.REFERENCE_SEGMENTS, allow_null=None, strict_nulls: bool = False,
              model_path: str | None = None, multi_line: bool = False) -> DailyResult:
    raw_io.require_sources(spark, raw_dir)                                  # S3
    # Each CSV is parsed once into a landing table. The null gate, the summary and every non-unique expectation
    # (SURVEY §4.3) are observed on that write; the tables are read again for uniqueness only. D1: unclicked events
    # carry no campaign, so the strict null gate would always stop here.
    suites = quality.raw_suites(segments)
    allowed = {} if strict_nulls else allow_null or {"events": ["campaign_id"]}
    landed, observed = raw_io.land_observed(
        spark, raw_dir, warehouse, lambda t, columns: quality.profile_aggregates(t, columns, suites[t], allowed.get(t, ())),
        multi_line=multi_line)
    raw = {t: spark.read.parquet(path) for t, path in landed.items()}
    inventory = raw_io.file_inventory(spark, {t: f"{raw_dir.rstrip('/')}/{f}" for f, t in RAW_FILES.items()})  # S4
    raw_report, _census, summary = quality.profile_gates(raw, suites, allowed, strict_nulls, observed)
    counts = (quality.value_counts(raw["customers"], "customers", ["segment", "region"])
              .unionByName(quality.value_counts(raw["events"], "events", ["event_type"]))
              .unionByName(quality.value_counts(raw["orders"], "orders", ["status"]))
              .orderBy("table_name", "column_name", F.desc("count"), "value"))               # A12

    loaded = raw_io.publish_raw(spark, landed, warehouse)                       # S2, after the gates
    staged = staging.stage_all(loaded)
    raw_io.staging_views(spark, staged, warehouse)                          # S5

    # Each mart is written once and read back; all three become current together.
    release = store.Release(spark, warehouse, "marts")
    ltv = release.write(marts.mart_customer_ltv(staged["stg_customers"], staged["stg_orders"],
                                                staged["stg_churn_labels"]), "mart_customer_ltv")
    built = {"mart_customer_ltv": ltv,
             "mart_campaign_performance": release.write(
                 marts.mart_campaign_performance(staged["stg_events"], staged["stg_orders"]), "mart_campaign_performance"),
             "mart_churn_summary": release.write(marts.mart_churn_summary(ltv), "mart_churn_summary")}
    release.publish()

    models = dict(staged)
    models.update(built)
    schema_report = quality.run_schema_tests(models, quality.schema_tests([s.lower() for s in segments]))
    failures = [r for r in schema_report.collect() if r["failures"]]   # one row per test
    if failures:
        raise quality.QualityGateError("schema tests failed: " + ", ".join(
            f"{r['model']}.{r['column']} {r['test']} ({r['failures']})" for r in failures))
    mart_report = quality.quality_gate(quality.run_suites(built, quality.mart_suites()))

    predictions = scoring = None
    if model_path:
        model = ml.load_model(spark, model_path)                            # M9
        trained_at = ml.latest_trained_at(spark, model_path)                # S13
        predictions = ml.score_customers(model, ml.scan_scoring(built["mart_customer_ltv"]), trained_at)
        raw_io.write_table(predictions, warehouse, "marts", "ml_churn_predictions")  # S12
        predictions = raw_io.read_table(spark, warehouse, "marts", "ml_churn_predictions")
        scoring = ml.scoring_summary(predictions)                                    # A14
    return DailyResult(raw_report, schema_report, mart_report, summary, counts, built, predictions, inventory,
                       scoring)


def run_training(spark: SparkSession, warehouse: str, model_path: str, run_id: str | None = None,
                 n_trees: int = ml.N_TREES) -> dict:
    """Train on the published LTV mart; the model and its record are published together under ``run_id``."""
    ltv = raw_io.read_table(spark, warehouse, "marts", "mart_customer_ltv")
    model, record = ml.train_churn(spark, ml.scan_features(ltv), n_trees=n_trees)
    ml.publish_training(spark, model, record, model_path, run_id or uuid.uuid4().hex)
    return record
