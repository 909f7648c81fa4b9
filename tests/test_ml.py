import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.schemas import NUMERIC_FEATURES

SEGMENTS = ["enterprise", "smb", "consumer", "startup"]


def _labelled(spark, n=400):
    rows = []
    for i in range(n):
        orders = i % 7
        cost = float(10 + (i * 37) % 490)
        churned = orders == 0 or cost > 400
        rows.append((str(i), SEGMENTS[i % 4], ["us", "eu", None][i % 3], orders, orders * 50.0,
                     25.0 if orders else 0.0, orders * 3, orders * 50.0 - cost, 20 + i % 50, cost, churned,
                     "n"))
    return spark.createDataFrame(rows, "customer_id string, segment string, region string, total_orders long, "
                                       "total_revenue double, avg_order_value double, customer_lifespan_days long, "
                                       "net_ltv double, age long, acquisition_cost double, is_churned boolean, "
                                       "name string")


def test_auc_matches_brute_force_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.3), (0, 0.3), (1, 0.3), (0, 0.1), (1, 0.95), (0, 0.5), (1, 0.5)]
    got = ml.roc_auc(spark.createDataFrame(rows, "label int, score double"), rows_per_range=4).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = {x.class_name: x for x in ml.classification_report(df).collect()}
    assert r["churned"].precision == 0.0 and r["churned"].recall == 0.0 and r["churned"].support == 1
    assert r["active"].recall == 1.0 and r["active"].support == 2


def test_encoder_unseen_and_null(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,), ("o'brien",), ("back\\slash",)],
                                "segment string").withColumn("region", F.lit("x"))
    enc = ml.fit_encoder(fit)
    codes = {(r.feature, r.value): r.code for r in enc.collect()}
    assert codes[("segment", "None")] == 0 and codes[("segment", "a")] == 1 and codes[("segment", "b")] == 2
    apply = spark.createDataFrame([("a", "x"), ("zzz", "y"), (None, None), ("o'brien", "x"), ("back\\slash", "x")],
                                  "segment string, region string")
    got = [(r.segment_code, r.region_code) for r in ml.apply_encoder(apply, enc).collect()]
    assert sorted(got) == sorted([(1, 0), (-1, -1), (0, -1), (4, 0), (3, 0)])


def test_split_is_exact_per_class_and_repeats(spark):
    import hashlib
    import random
    rnd = random.Random(1)
    sizes = {c: n for c, n in enumerate([1, 2, 3, 5, 5, 8, 400, 1000])}
    rows = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "customer_id string, label int")
    for bucket_rows in (1_000_000, 50):
        got = {r.customer_id: r.split for r in ml.stratified_split(df, label="label", bucket_rows=bucket_rows).collect()}
        assert len(got) == len(rows)
        for c, n in sizes.items():
            want = 0 if n == 1 else max(1, min(n - 1, int(n * 0.2 + 0.5)))
            ids = sorted((f"{c}-{i}" for i in range(n)), key=lambda k: hashlib.md5(f"{k}-42".encode()).hexdigest())
            assert {k for k in ids if got[k] == "test"} == set(ids[:want])
    empty = ml.stratified_split(df.limit(0), label="label")
    assert empty.count() == 0 and empty.columns == ["customer_id", "label", "split"]


def test_report_averages(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 0)] * 5 + [(0, 1)] * 1
    r = {x.class_name: x for x in ml.classification_report(
        spark.createDataFrame(rows, "label int, prediction int")).collect()}
    assert r["accuracy"].precision == r["accuracy"].f1_score == 0.8 and r["accuracy"].support == 10
    assert r["macro avg"].recall == (3 / 4 + 5 / 6) / 2
    assert r["weighted avg"].precision == (5 / 6 * 6 + 3 / 4 * 4) / 10


def test_broken_run_record_is_an_error(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "runs")
    os.makedirs(os.path.join(path, "_manifest"))
    with open(os.path.join(path, "_manifest", "000000000001.json"), "w") as f:
        f.write("not json")
    with pytest.raises(Exception):
        ml.latest_trained_at(spark, path)


def test_train_save_load_score(spark, tmpdir_path):
    data = _labelled(spark)
    model, rec = ml.train_churn(spark, data, n_trees=10)
    assert rec["train_rows"] + rec["test_rows"] == 400
    assert rec["auc"] > 0.9
    path = os.path.join(tmpdir_path, "model")
    ml.save_model(model, path)
    loaded = ml.load_model(spark, path)
    runs = os.path.join(tmpdir_path, "runs")
    assert ml.latest_trained_at(spark, runs) is None
    ml.record_training_run(spark, rec, runs)
    trained_at = ml.latest_trained_at(spark, runs)
    assert trained_at is not None
    unseen = data.withColumn("segment", F.when(F.col("customer_id") == "0", "brand_new").otherwise(F.col("segment")))
    scored = ml.score_customers(loaded, unseen, trained_at)
    assert scored.columns == ["customer_id", "churn_probability", "churn_prediction", "scored_at", "model_trained_at"]
    rows = scored.collect()
    assert len(rows) == 400 and all(0.0 <= r.churn_probability <= 1.0 for r in rows)
    assert all(r.churn_prediction == (r.churn_probability >= 0.5) for r in rows)
    # The persisted encoders give the same codes as the DataFrame encoder (-1 for unseen).
    enc = ml.fit_encoder(data)
    want = {r.customer_id: (r.segment_code, r.region_code) for r in ml.apply_encoder(unseen, enc).collect()}
    got = {r.customer_id: (int(r.segment_code), int(r.region_code))
           for r in loaded.transform(unseen).select("customer_id", "segment_code", "region_code").collect()}
    assert got == want and got["0"][0] == -1


def test_training_rows_are_dealt_evenly_and_read_once(spark, monkeypatch):
    """The tasks of the trees follow the rows, not the bytes, and the input is worked out once."""
    from tidemark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    reads = spark.sparkContext.accumulator(0)

    def seen(age):
        reads.add(1)
        return age

    data = _labelled(spark).coalesce(1).withColumn("age", F.udf(seen, "long").asNondeterministic()("age"))
    monkeypatch.setattr(ml, "TRAIN_TASK_ROWS", 50)
    got = ml._training_rows(data)
    assert reads.value == 400
    sizes = got.groupBy(F.spark_partition_id()).count().toPandas()["count"].tolist()
    assert len(sizes) == 8 and max(sizes) <= 60 and sum(sizes) == 400
    want = {r.customer_id: r.split for r in ml.stratified_split(_labelled(spark)).collect()}
    assert {r.customer_id: r.split for r in got.collect()} == want
    monkeypatch.setattr(ml, "TRAIN_TASKS", 2)
    monkeypatch.setattr(ml, "TRAIN_TASK_MAX_ROWS", 100)
    assert ml._training_rows(data).select(F.spark_partition_id()).distinct().count() == 4


def test_load_missing_model_is_clear_error(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        ml.load_model(spark, os.path.join(tmpdir_path, "nope"))


def test_training_needs_positive_labels(spark):
    data = _labelled(spark).withColumn("is_churned", F.lit(False))
    with pytest.raises(ValueError):
        ml.train_churn(spark, data, n_trees=2)


def test_auc_clustered_scores_match_brute_force(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), 0.5 + rnd.randint(0, 400) * 1e-7) for _ in range(1500)]
    rows += [(rnd.randint(0, 1), rnd.random()) for _ in range(100)]
    got = ml.roc_auc(spark.createDataFrame(rows, "label int, score double"), rows_per_range=16).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = sorted(s for y, s in rows if y == 0)
    import bisect
    want = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p))
               for p in pos) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_empty_and_single_class_inputs_give_nulls_not_errors(spark):
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.7)], "label int, score double")
    assert ml.roc_auc(one_class).first().auc is None
    empty = spark.createDataFrame([], "label int, score double")
    assert ml.roc_auc(empty).first().auc is None
    e2 = spark.createDataFrame([], "customer_id string, churn_probability double, churn_prediction boolean")
    r = ml.scoring_summary(e2).first()
    assert r.customers_scored == 0 and r.predicted_churned_share is None and r.avg_churn_probability is None
    e3 = spark.createDataFrame([], "is_churned boolean")
    assert ml.target_rate(e3).first().churn_rate is None
