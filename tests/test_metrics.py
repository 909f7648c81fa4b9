from pyspark.sql import functions as F

from helpers import T
from tidemark.functions.windows import running_count
from tidemark.operators import metrics as M

SCHEMA = "metric string, labels map<string,string>, ts timestamp_ntz, seq long, value double"


def test_glob_mapping_first_rule_wins(spark):
    names = ["airflow.dagrun.duration.success.my_dag", "airflow.operator_failures_BashOperator",
             "airflow.pool.open_slots.default_pool", "airflow.scheduler_heartbeat",
             "airflow.some.nested.name", "other.metric"]
    df = M.map_metric_names(spark.createDataFrame([(n,) for n in names], "name string"))
    got = {r.name: (r.metric, dict(r.labels)) for r in df.collect()}
    assert got["airflow.dagrun.duration.success.my_dag"] == ("airflow_dagrun_duration_success_seconds",
                                                            {"dag_id": "my_dag"})
    assert got["airflow.operator_failures_BashOperator"] == ("airflow_operator_failures_total",
                                                            {"operator": "BashOperator"})
    assert got["airflow.pool.open_slots.default_pool"] == ("airflow_pool_open_slots", {"pool": "default_pool"})
    assert got["airflow.scheduler_heartbeat"] == ("airflow_scheduler_heartbeat", {})
    assert got["airflow.some.nested.name"] == ("airflow_some_nested_name", {})  # no rule: sanitised
    assert got["other.metric"] == ("other_metric", {})


def test_counter_increase_resets_and_single_sample(spark):
    rows = [("c", {"op": "a"}, T("2024-01-01 00:10:00"), 1, 5.0), ("c", {"op": "a"}, T("2024-01-01 01:10:00"), 2, 8.0),
            ("c", {"op": "a"}, T("2024-01-01 03:00:00"), 3, 2.0), ("c", {"op": "a"}, T("2024-01-01 03:30:00"), 4, 6.0),
            ("c", {"op": "b"}, T("2024-01-01 05:00:00"), 5, 9.0)]
    inc = M.counter_increase(spark.createDataFrame(rows, SCHEMA), "24 hours")
    got = {r.labels["op"]: (r.increase, r.samples) for r in inc.collect()}
    assert got == {"a": (3.0 + 2.0 + 4.0, 4), "b": (0.0, 1)}
    tot = M.sum_over_series(inc).collect()
    assert tot[0].total_increase == 9.0


def test_last_value_and_bands(spark):
    rows = [("g", {}, T("2024-01-01 00:00:00"), 1, 1.0), ("g", {}, T("2024-01-01 00:01:00"), 2, None),
            ("g", {}, T("2024-01-01 00:00:30"), 3, 7.0)]
    lv = M.last_value(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert lv.value == 7.0
    df = spark.createDataFrame([(0.0,), (0.0005,), (0.002,), (1.0,), (3.5,), (None,)], "v double")
    hb = [r.b for r in df.select(M.threshold_band(F.col("v"), M.HEARTBEAT_STEPS).alias("b")).collect()]
    fl = [r.b for r in df.select(M.threshold_band(F.col("v"), M.FAILURE_STEPS).alias("b")).collect()]
    assert hb == ["red", "red", "green", "green", "green", None]
    assert fl == ["green", "green", "green", "yellow", "red", None]


def test_sla_miss(spark):
    runs = spark.createDataFrame([(1, "t", T("2024-01-01 00:00:00"), T("2024-01-01 02:00:00")),
                                  (2, "t", T("2024-01-01 00:00:00"), T("2024-01-01 02:00:01"))],
                                 "run_id long, task string, scheduled_at timestamp_ntz, finished_at timestamp_ntz")
    got = M.sla_miss(runs).collect()
    assert [r.run_id for r in got] == [2] and got[0].duration_seconds == 7201.0


def test_running_count_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 2000).alias("o"))
    rc = running_count(df, ["k"], ["o"], F.floor(F.col("o") / 100))
    rn = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(tuple, rc.select("k", "o", "rn").collect())) == sorted(map(tuple, rn.collect()))


def test_orders_numbered_like_a_global_row_number(spark):
    from pyspark.sql import Window
    from tidemark.operators.derive import orders_from_purchases
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    got = orders_from_purchases(e, customer_col="user_id", ts_col="ts", number=True)
    want = (e.where(F.col("event_type") == "purchase")
            .select(F.row_number().over(Window.orderBy("ts", "event_id")).alias("order_id"),
                    F.col("user_id").alias("customer_id"), F.col("ts").alias("order_date")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dense_codes_match_dense_rank(spark):
    from pyspark.sql import Window
    from tidemark.functions.windows import dense_codes
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("g"), F.format_string("v%05d", F.col("id") * 7 % 1000).alias("v"))
    got = dense_codes(df, "g", "v", rows_per_partition=150)   # ~14 range partitions
    want = df.distinct().select("g", "v", (F.dense_rank().over(Window.partitionBy("g").orderBy("v")) - 1).alias("code"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_totals_are_per_metric(spark):
    at = T("2024-01-01 00:00:00")
    rows = [("ok", {"op": o}, T(f"2024-01-01 0{h}:00:00"), i, v) for i, (o, h, v) in enumerate(
        [("a", 0, 0.0), ("a", 1, 30.0), ("b", 0, 0.0), ("b", 1, 10.0)])]
    rows += [("bad", {"op": "a"}, T("2024-01-01 00:00:00"), 8, 0.0), ("bad", {"op": "a"}, T("2024-01-01 01:00:00"), 9, 4.0)]
    got = M.sum_over_series(M.counter_increase(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.metric: (r.window_start, r.total_increase) for r in got} == {"ok": (at, 40.0), "bad": (at, 4.0)}


def _lookback_brute(rows, seconds, times):
    import datetime as dt
    out = {}
    for op in {r[1]["op"] for r in rows}:
        own = sorted((r[2], r[3], r[4]) for r in rows if r[1]["op"] == op and r[4] is not None)
        for t in times:
            inside = [v for ts, _, v in own if t - dt.timedelta(seconds=seconds) < ts <= t]
            if inside:
                grown = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
                out[op, t] = (grown, len(inside))
    return out


def test_lookback_equals_brute_force(spark):
    import datetime as dt
    import random
    rnd = random.Random(9)
    start = T("2024-01-01 00:00:00")
    rows = [("c", {"op": rnd.choice("ab")}, start + dt.timedelta(seconds=rnd.choice([0, 60, 300, 301, 4000, 4100])
                                                                  + 300 * rnd.randrange(3) + 20_000 * rnd.randrange(2)),
             i, float(rnd.randrange(50)) if rnd.random() > 0.1 else None) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    times = [start + dt.timedelta(seconds=300 * k) for k in range(-2, 120)]
    got = {(r.labels["op"], r.evaluated_at): (r.increase, r.samples) for r in M.counter_lookback(df, 900, 300).collect()}
    assert got == _lookback_brute(rows, 900, times)
    for at in ("2024-01-01 00:10:00", "2024-01-01 06:00:30"):
        got = {(r.labels["op"], r.evaluated_at): (r.increase, r.samples)
               for r in M.counter_lookback(df, 3600, as_of=at).collect()}
        assert got == _lookback_brute(rows, 3600, [T(at)])


def test_unfinished_runs_miss_their_limit(spark):
    rows = [(1, T("2024-01-01 00:00:00"), T("2024-01-01 01:00:00")), (2, T("2024-01-01 00:00:00"), None),
            (3, T("2024-01-01 00:00:00"), T("2024-01-01 03:00:00")), (4, T("2024-01-01 09:00:00"), None)]
    df = spark.createDataFrame(rows, "run_id int, scheduled_at timestamp_ntz, finished_at timestamp_ntz")
    assert [r.run_id for r in M.sla_miss(df).collect()] == [3]
    assert sorted(r.run_id for r in M.sla_miss(df, as_of="2024-01-01 10:00:00").collect()) == [2, 3]
