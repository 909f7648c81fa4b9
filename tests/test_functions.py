"""One check per scalar function of SURVEY §2.7."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_f1_f3_casts(spark):
    assert one(spark, F.col("x").cast("string"), [(12,)], "x long") == ["12"]
    assert one(spark, F.col("x").cast("double"), [("1.5",)]) == [1.5]


def test_f2_bad_int_text_raises(spark):
    with pytest.raises(Exception):
        one(spark, F.col("x").cast("long"), [("abc",)])


def test_f4_bool_text(spark):
    assert one(spark, F.col("x").cast("boolean"), [("True",), ("False",)]) == [True, False]


def test_f5_clean_text(spark):
    assert one(spark, S.clean_text("x"), [(" \tUS\r\n",), (None,)]) == ["us", None]


def test_f6_f7_date_and_timestamp(spark):
    r = one(spark, F.to_date(F.col("x")), [(dt.datetime(2024, 1, 2, 23, 59),)], "x timestamp_ntz")
    assert r == [dt.date(2024, 1, 2)]


def test_f8_date_diff(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 3, 1))], "a date, b date")
    assert df.select(F.datediff("b", "a").cast("long")).first()[0] == 60


def test_f9_coalesce_types(spark):
    df = spark.createDataFrame([(None, None)], "a long, b double")
    r = df.select(F.coalesce("a", F.lit(0).cast("long")).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"))
    assert dict(r.dtypes) == {"a": "bigint", "b": "double"} and tuple(r.first()) == (0, 0.0)


def test_f10_safe_divide(spark):
    df = spark.createDataFrame([(3, 0), (3, 2)], "a long, b long")
    assert [r[0] for r in df.select(S.safe_divide("a", "b")).collect()] == [None, 1.5]


def test_f11_f12_ratio_and_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3)], "a long, b long")
    assert [r[0] for r in df.select(S.ratio_pct("a", "b")).collect()] == [12.5, 33.33, 66.67]
    # half away from zero on exact binary halves; 1.005 is stored below the half
    assert one(spark, S.round_half_up("x", 2), [(0.125,), (-0.125,), (1.005,), (None,)], "x double") == \
        [0.13, -0.13, 1.0, None]
    assert one(spark, S.round_half_up("x", 0), [(2.5,), (-2.5,)], "x double") == [3.0, -3.0]


def test_f13_half_even(spark):
    assert one(spark, S.round_half_even("x", 4), [(0.12345,), (0.12355,)], "x double") == [0.1234, 0.1236]


def test_f14_f15_three_valued_logic(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    r = df.select(F.when(~F.col("c"), 1).otherwise(0)).collect()
    assert [x[0] for x in r] == [0, 1, 0]


def test_f16_current_timestamp(spark):
    assert one(spark, F.current_timestamp())[0] is not None


def test_f17_null_arithmetic(spark):
    assert one(spark, F.lit(1.0) - F.col("x").cast("double")) == [None]


def test_f18_str_category(spark):
    assert one(spark, S.str_category("x"), [("a",), (None,)]) == ["a", "None"]


def test_f19_membership(spark):
    assert one(spark, F.col("x").isin("click", "purchase"), [("click",), ("view",)]) == [True, False]


def test_f20_f21_elapsed_days_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3, 11))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(S.elapsed_days("a", "b")).first()[0] == 1
    assert df.select(S.elapsed_days("b", "a")).first()[0] == -2
    lookback = df.select((S.ts_literal("2024-01-31 00:00:00") - F.make_dt_interval(F.lit(30))).alias("t")).first().t
    assert lookback == dt.datetime(2024, 1, 1)


def test_f22_money_aggregates_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "x double")
    r = df.agg(S.money_sum("x").alias("s"), S.money_avg("x").alias("a")).first()
    assert r.s == 0.6 and r.a == 0.2


def test_money_keeps_its_scale_or_fails(spark):
    import pytest
    from tidemark.functions import scalars as sc
    fine = spark.createDataFrame([(0.004,)] * 1000, "x double")
    assert fine.agg(sc.money_sum("x").alias("s"), sc.money_avg("x").alias("a")).first() == (4.0, 0.004)
    mixed = spark.createDataFrame([(0.1,), (0.2,), (None,), (-0.3,), (123456789.123456,)], "x double")
    assert mixed.agg(sc.money_sum("x").alias("s")).first().s == 123456789.123456
    for bad in (0.0000001, float("nan"), float("inf"), 1e10 + 0.1, 1 / 3):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "x double").agg(sc.money_sum("x")).collect()


def test_fraction_means_keep_small_values(spark):
    from tidemark.functions import scalars as sc
    df = spark.createDataFrame([(1e-9,), (3e-9,), (None,)], "p double")
    assert df.agg(sc.exact_avg("p").alias("a")).first().a == 2e-9


def test_nan_amounts_are_dropped_in_staging(spark):
    from helpers import order, raw
    from tidemark.operators.staging import stg_orders
    rows = [order(1, 1, "2024-01-01 00:00:00", float("nan")), order(2, 1, "2024-01-01 00:00:00", 0.004)]
    assert [r.order_amount for r in stg_orders(raw(spark, "orders", rows)).collect()] == [0.004]
