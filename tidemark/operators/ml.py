"""Churn model: features, encoders, split, weights, training, evaluation and
scoring (M1-M10, S10, S11, S13, A14, A15).

Everything is a distributed DataFrame / Spark ML step.  Nothing is pulled to
the driver except a handful of scalars (class counts, the number of encoder
labels, the latest training time).

* Encoders: code = position of the value in the sorted distinct values of
  the labelled rows (from 0); unseen values get -1 and nulls are the
  category ``None``.  The DataFrame form (``fit_encoder``/``apply_encoder``) and
  the persisted model form (``StringIndexer`` alphabetical + a SQL mapping of
  the "unseen" slot to -1) give the same codes.
* Split: an exact cut of each class in hash order, ranked only where the cut falls.
* AUC: exact (Mann-Whitney with half credit for ties) from per-score class
  counts and two-level running sums, so no window ever sees all rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import exact_avg, round_half_even, str_category
from ..schemas import ALL_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from ..sources import store

# Fixed values of the reference model.
N_TREES = 100
MAX_DEPTH = 4
LEARNING_RATE = 0.1
SEED = 42
TEST_FRACTION = 0.2
CLASS_NAMES = ["active", "churned"]
AUC_RANGE_ROWS = 1_000_000
#: Rows of a training task, up to ``TRAIN_TASKS`` tasks; beyond, tasks grow to ``TRAIN_TASK_MAX_ROWS`` rows.
TRAIN_TASK_ROWS = 32_768
TRAIN_TASKS = 256
TRAIN_TASK_MAX_ROWS = 262_144


# --- M1, S10, S11, P8 ---------------------------------------------------------------

def feature_columns(ltv: DataFrame) -> DataFrame:
    """M1: the 9 features and the target."""
    return ltv.select(*ALL_FEATURES, TARGET)


def scan_features(ltv: DataFrame) -> DataFrame:
    """Column-pruned labelled rows (the training fetch)."""
    return ltv.select("customer_id", *ALL_FEATURES, TARGET).where(F.col(TARGET).isNotNull())


def scan_scoring(ltv: DataFrame) -> DataFrame:
    """Every customer, no target filter."""
    return ltv.select("customer_id", "name", *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)


# --- M2, M3 ---------------------------------------------------------------------------

def fit_encoder(df: DataFrame, columns=CATEGORICAL_FEATURES) -> DataFrame:
    """M2: (feature, value, code) with code = position in sorted distinct values.

    Codes come from a distributed rank over the distinct values (no feature
    is numbered inside one task, whatever its cardinality).
    """
    from ..functions.windows import dense_codes
    parts = [df.select(F.lit(c).alias("feature"), str_category(c).alias("value")) for c in columns]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return dense_codes(u, "feature", "value")


def apply_encoder(df: DataFrame, encoder: DataFrame, columns=CATEGORICAL_FEATURES,
                  suffix: str = "_code") -> DataFrame:
    """M3: unseen value -> -1; null -> the ``None`` category.

    One join per feature with the fitted encoder (one row per value).  Spark
    broadcasts it only after measuring its size, and splits skewed partitions
    otherwise; nothing is read while the plan is built.
    """
    out = df
    for c in columns:
        e = encoder.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"),
                                                       F.col("code").alias(f"_c_{c}"))
        out = out.withColumn(f"_k_{c}", str_category(c)).join(e, F.col(f"_k_{c}") == F.col(f"_v_{c}"), "left")
        out = (out.withColumn(c + suffix, F.coalesce(F.col(f"_c_{c}"), F.lit(-1).cast("long")))
               .drop(f"_k_{c}", f"_v_{c}", f"_c_{c}"))
    return out


# --- M4, M5, A15 ------------------------------------------------------------------------

def stratified_split(df: DataFrame, id_col: str = "customer_id", seed: int = SEED,
                     test_fraction: float = TEST_FRACTION, label: str = TARGET, bucket_rows: int = 1_000_000) -> DataFrame:
    """M4: adds ``split`` in {train, test}: of each class the ``test_fraction`` with the smallest hashes.

    Exact per class: the test part has ``round(n * test_fraction)`` rows of a
    class of n (half up), at least one and not all if n > 1.  Order is by a
    hash of the id and seed (ties by id), so the cut repeats.  The rank is
    taken in two levels: hash buckets of about ``bucket_rows`` rows are
    counted per class, and only rows of the one bucket that holds a class's
    cut are ranked by a window.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit("-"), F.lit(str(seed))))
    d = df.withColumn("_h", h).withColumn("_place", F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"))
    total = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    # The bucket width follows the size of the largest class: one number, read once.
    largest = total.agg(F.max("_n")).first()[0] or 1
    width = max(1, 2**32 // max(1, -(-largest // bucket_rows)))
    d = d.withColumn("_b", F.floor(F.col("_place") / width))
    per = d.groupBy(F.col(label).alias("_l"), "_b").agg(F.count(F.lit(1)).alias("_m"))
    w = Window.partitionBy("_l").orderBy("_b")          # a row per bucket
    every = Window.partitionBy("_l")
    want = F.floor(F.col("_n") * test_fraction + 0.5)
    want = F.when(F.col("_n") > 1, F.least(F.greatest(want, F.lit(1)), F.col("_n") - 1)).otherwise(F.lit(0))
    per = (per.withColumn("_n", F.sum("_m").over(every)).withColumn("_want", want)
           .withColumn("_before", F.sum("_m").over(w) - F.col("_m"))
           .withColumn("_state", F.when(F.col("_before") + F.col("_m") <= F.col("_want"), "test")
                       .when(F.col("_before") >= F.col("_want"), "train").otherwise("cut"))
           .select("_l", F.col("_b").alias("_pb"), "_state", (F.col("_want") - F.col("_before")).alias("_left")))
    d = d.join(per, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_pb")))
    # Rows outside the cut bucket get keys of their own and need no rank.
    spread = F.when(F.col("_state") == "cut", F.lit(-1)).otherwise(F.col("_place"))
    rank = F.row_number().over(Window.partitionBy("_l", "_b", spread).orderBy("_h", F.col(id_col).cast("string")))
    return d.withColumn("split", F.when(F.col("_state") != "cut", F.col("_state"))
                        .when(rank <= F.col("_left"), "test").otherwise("train")).select(*df.columns, "split")


def class_counts(df: DataFrame, label: str = TARGET) -> DataFrame:
    y = F.col(label).cast("int")
    return df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives"))


def class_weight(train: DataFrame, label: str = TARGET) -> DataFrame:
    """M5: negatives / positives on the training part (null when no positives)."""
    c = class_counts(train, label)
    return c.select("negatives", "positives",
                    F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double"))
                    .alias("scale_pos_weight"))


def target_rate(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and share of positive labels."""
    y = F.col(label)
    return df.where(y.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(y).alias("positives"),
        F.try_divide(F.count_if(y), F.count(F.lit(1))).alias("churn_rate"))


# --- M7, M8, A14 ------------------------------------------------------------------------

def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            rows_per_range: int = AUC_RANGE_ROWS) -> DataFrame:
    """M7: exact area under the ROC curve (Mann-Whitney, ties get half credit).

    1. Per distinct score: positive and negative counts (partial aggregation;
       a score shared by many rows becomes one row), checkpointed.
    2. Distinct scores are range-partitioned into about ``rows_per_range`` each,
       so the number of ranges follows the data; the cut is pinned by a second
       checkpoint.
    3. Negatives ranked below a score = negatives of all lower ranges (a window
       over the range totals, one row per range) + negatives of lower scores
       in the same range (window per range).
    """
    y = F.col(label).cast("int")
    per_score = (df.where(F.col(score).isNotNull() & y.isNotNull())
                 .groupBy(F.col(score).cast("double").alias("s"))
                 .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))
    # The per-score table is read twice (split points, then ranks): write it
    # once to the shared checkpoint folder instead of scanning the input twice.
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    per_score = per_score.checkpoint()
    ranges = max(1, -(-per_score.count() // rows_per_range))
    per_score = per_score.repartitionByRange(ranges, "s").withColumn("b", F.spark_partition_id()).checkpoint()
    totals = per_score.groupBy("b").agg(F.sum("neg").alias("bneg"))
    before = totals.select(
        "b", F.coalesce(F.sum("bneg").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias("neg_before_bucket"))
    ranked = per_score.join(before, "b", "left")
    wb = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.col("neg_before_bucket") + F.coalesce(F.sum("neg").over(wb), F.lit(0))
    dec = "decimal(38,0)"
    pos, neg = F.col("pos").cast(dec), F.col("neg").cast(dec)
    twice = F.lit(2).cast(dec) * pos * neg_below.cast(dec) + pos * neg
    agg = ranked.select(twice.alias("t"), "pos", "neg").agg(
        F.sum("t").alias("t"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(
        # null when a class is absent (the AUC is undefined then)
        F.try_divide(F.col("t").cast("double"),
                     F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")).alias("auc"),
        F.col("p").cast("long").alias("positives"), F.col("n").cast("long").alias("negatives"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M8: precision, recall, F1 and support per class, then the accuracy row and the
    macro and weighted averages; undefined ratios are 0.  The accuracy row has
    the accuracy in all three ratio columns."""
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp1"), F.count_if((y == 0) & (p == 1)).alias("fp1"),
               F.count_if((y == 1) & (p == 0)).alias("fn1"), F.count_if((y == 0) & (p == 0)).alias("tp0"))

    def cls(name, tp, fp, fn):
        tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
        z = F.lit(0.0)
        prec = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), z)
        rec = F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), z)
        f1 = F.coalesce(F.try_divide((F.lit(2) * tp).cast("double"), (F.lit(2) * tp + fp + fn).cast("double")), z)
        return F.struct(F.lit(name).alias("class_name"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1_score"), (tp + fn).cast("long").alias("support"))

    both = c.select(cls(CLASS_NAMES[0], "tp0", "fn1", "fp1").alias("a"), cls(CLASS_NAMES[1], "tp1", "fp1", "fn1").alias("b"),
                    (F.col("tp0") + F.col("tp1")).alias("right"))
    n = F.col("a.support") + F.col("b.support")
    accuracy = F.coalesce(F.try_divide(F.col("right").cast("double"), n.cast("double")), F.lit(0.0))

    def mean(name, of):
        return F.struct(F.lit(name).alias("class_name"), *[of(k).alias(k) for k in ("precision", "recall", "f1_score")],
                        n.alias("support"))

    weighted = lambda k: F.coalesce(F.try_divide(
        F.col(f"a.{k}") * F.col("a.support") + F.col(f"b.{k}") * F.col("b.support"), n.cast("double")), F.lit(0.0))
    return both.select(F.inline(F.array(
        F.col("a"), F.col("b"), mean("accuracy", lambda k: accuracy),
        mean("macro avg", lambda k: (F.col(f"a.{k}") + F.col(f"b.{k}")) / F.lit(2.0)),
        mean("weighted avg", weighted))))


def scoring_summary(scored: DataFrame, prob: str = "churn_probability",
                    pred: str = "churn_prediction") -> DataFrame:
    """Customers scored, predicted churned (count, share), mean probability."""
    n = F.count(F.lit(1))
    k = F.count_if(F.col(pred))
    return scored.agg(n.alias("customers_scored"), k.alias("predicted_churned"),
                      F.try_divide(k, n).alias("predicted_churned_share"), exact_avg(prob).alias("avg_churn_probability"))


# --- M6, M9, M10, S13 ---------------------------------------------------------------------

def _cat(c):
    return f"{c}_cat"


def _idx(c):
    return f"{c}_idx"


def _stages(n_trees: int, seed: int):
    prep = SQLTransformer(statement="SELECT *, " + ", ".join(
        [f"coalesce(CAST({c} AS STRING), 'None') AS {_cat(c)}" for c in CATEGORICAL_FEATURES]
        + [f"CAST({c} AS DOUBLE) AS {c}__d" for c in NUMERIC_FEATURES]) + " FROM __THIS__")
    indexer = StringIndexer(inputCols=[_cat(c) for c in CATEGORICAL_FEATURES],
                            outputCols=[_idx(c) for c in CATEGORICAL_FEATURES],
                            stringOrderType="alphabetAsc", handleInvalid="keep")
    imputer = Imputer(strategy="median", inputCols=[f"{c}__d" for c in NUMERIC_FEATURES],
                      outputCols=[f"{c}__f" for c in NUMERIC_FEATURES])
    assembler = VectorAssembler(inputCols=[f"{c}__f" for c in NUMERIC_FEATURES]
                                + [f"{c}_code" for c in CATEGORICAL_FEATURES],
                                outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight",
                        maxIter=n_trees, maxDepth=MAX_DEPTH, stepSize=LEARNING_RATE, seed=seed,
                        checkpointInterval=10)
    return prep, indexer, imputer, assembler, gbt


def _training_rows(labelled: DataFrame, seed: int = SEED) -> DataFrame:
    """The labelled rows with ``label`` and ``split``, dealt evenly over tasks.

    The trees pass over these rows some 400 times, one short job each.  Spark
    sizes partitions of a shuffle by bytes, and rows this narrow would stand
    in a few; so the number of tasks follows the number of rows instead.
    """
    data = labelled.where(F.col(TARGET).isNotNull()).withColumn("label", F.col(TARGET).cast("double"))
    # The split reads its input three times: written first, the mart is worked out once.
    data = data.checkpoint()
    n = data.count()
    tasks = max(1, min(TRAIN_TASKS, -(-n // TRAIN_TASK_ROWS)), -(-n // TRAIN_TASK_MAX_ROWS))
    # Read by the encoder fit, the class counts, the imputer, the trees and the
    # evaluation: written once to the shared checkpoint folder (and survives lost executors).
    return stratified_split(data, seed=seed).repartition(tasks).checkpoint()


def train_churn(spark: SparkSession, labelled: DataFrame, seed: int = SEED,
                n_trees: int = N_TREES) -> tuple[PipelineModel, dict]:
    """M6: encoders on all labelled rows (D11), hash split, class weight, boosted trees.

    Returns one ``PipelineModel`` (encoders + imputer + trees, so training and
    scoring cannot drift) and the run record (S13 fields without the clock).
    Spark's tree learner checkpoints every 10 iterations into the session's
    checkpoint folder, which bounds lineage and survives lost executors.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    data = _training_rows(labelled, seed)
    prep, indexer, imputer, assembler, gbt = _stages(n_trees, seed)
    enc = Pipeline(stages=[prep, indexer]).fit(data)
    # StringIndexer "keep" puts unseen values at index n; the reference uses -1.
    to_codes = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CASE WHEN {_idx(c)} >= {len(labels)} THEN -1.0 ELSE {_idx(c)} END AS {c}_code"
        for c, labels in zip(CATEGORICAL_FEATURES, enc.stages[1].labelsArray)) + " FROM __THIS__")

    train_raw = data.where(F.col("split") == "train")
    test_raw = data.where(F.col("split") == "test")
    counts = class_counts(train_raw, "label").first()
    if not counts["positives"]:
        raise ValueError("training part has no positive labels")
    weight = counts["negatives"] / counts["positives"]
    train = enc.transform(train_raw).withColumn(
        "weight", F.when(F.col("label") == 1.0, F.lit(weight)).otherwise(F.lit(1.0)))
    rest = Pipeline(stages=[to_codes, imputer, assembler, gbt]).fit(train)
    model = PipelineModel(stages=list(enc.stages) + list(rest.stages))

    scored = model.transform(test_raw).select(
        "label", vector_to_array("probability")[1].alias("score"), "prediction")
    auc_row = roc_auc(scored).first()
    report = [r.asDict() for r in classification_report(scored).collect()]  # five rows
    record = {
        "train_rows": counts["negatives"] + counts["positives"],
        "test_rows": test_raw.count(),
        "auc": None if auc_row is None or auc_row["auc"] is None else round(auc_row["auc"], 4),
        "churn_rate": round(target_rate(data).first()["churn_rate"], 4),
        "features": ",".join(ALL_FEATURES),
        "report": report,
    }
    return model, record


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AUC and classification report of ``model`` on labelled rows."""
    scored = model.transform(test.withColumn("label", F.col(TARGET).cast("double"))).select(
        "label", vector_to_array("probability")[1].alias("score"), "prediction")
    return roc_auc(scored), classification_report(scored)


RUNS_SCHEMA = ("run_id string, trained_at timestamp, train_rows long, test_rows long, auc double, "
               "churn_rate double, features string")


def _write_version(model: PipelineModel, path: str) -> str:
    place = f"{path.rstrip('/')}/versions/{store.new_version()}"
    model.write().save(place)
    return place


def save_model(model: PipelineModel, path: str) -> None:
    """M9: encoders, imputer and trees persist together, as a version of their own.

    The version becomes current by one rename once it is complete; until then,
    and after a failure, the last one loads."""
    place = _write_version(model, path)
    store.commit(SparkSession.active(), path, lambda d: d | {"model": place})


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """M9: the current version; a missing model is a clear error, not a stack trace from the reader."""
    place = store.state(spark, path).get("model")
    if place is None:
        raise FileNotFoundError(f"No model found at {path}. Train the churn model first.")
    return PipelineModel.load(place)


def _with_run(document: dict, record: dict, run_id: str) -> dict:
    entry = {k: record[k] for k in ("train_rows", "test_rows", "auc", "churn_rate", "features")}
    entry["trained_at"] = dt.datetime.now(dt.timezone.utc).isoformat()
    return document | {"runs": document.get("runs", {}) | {run_id: entry}}


def publish_training(spark: SparkSession, model: PipelineModel, record: dict, path: str, run_id: str) -> None:
    """M9 and S13 in one step: the model becomes current and its run is on record, or neither.

    ``run_id`` names the training (a schedule date, say): one that is repeated
    after a failure takes the place of its own record."""
    place = _write_version(model, path)
    store.commit(spark, path, lambda d: _with_run(d | {"model": place, "run_id": run_id}, record, run_id))


def record_training_run(spark: SparkSession, record: dict, path: str, run_id: str | None = None) -> None:
    """Put the run (with ``trained_at``) on record; a ``run_id`` that is on record is replaced."""
    run_id = run_id or uuid.uuid4().hex
    store.commit(spark, path, lambda d: _with_run(d, record, run_id))


def training_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs on record (one a week in the reference: a small table)."""
    rows = [(k, dt.datetime.fromisoformat(r["trained_at"]), r["train_rows"], r["test_rows"], r["auc"], r["churn_rate"],
             r["features"]) for k, r in store.state(spark, path).get("runs", {}).items()]
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def latest_trained_at(spark: SparkSession, path: str | None):
    """``max(trained_at)`` of the runs on record; None when there is none."""
    return training_runs(spark, path).agg(F.max("trained_at").alias("t")).first()["t"] if path else None


def score_customers(model: PipelineModel, scoring: DataFrame, model_trained_at=None,
                    with_clock: bool = True) -> DataFrame:
    """Probability rounded half-even to 4, prediction on the rounded value."""
    p = round_half_even(vector_to_array("probability")[1], 4)
    out = model.transform(scoring).select(
        "customer_id", p.alias("churn_probability"))
    out = out.withColumn("churn_prediction", F.col("churn_probability") >= F.lit(0.5))
    if with_clock:
        out = out.withColumn("scored_at", F.current_timestamp()).withColumn(
            "model_trained_at", F.lit(model_trained_at).cast("timestamp"))
    return out
