"""Each expectation type once passing and once failing; gates."""

import pytest

from helpers import churn, customer, raw
from tidemark.operators import quality as Q


def _report(spark, rows, checks):
    return {(r.check, r.column): r for r in Q.run_suite(raw(spark, "customers", rows), "customers", checks).collect()}


def test_expectations_pass_and_fail(spark):
    good = [customer(1, age=20), customer(2, age=30)]
    bad = [customer(1, age=20), customer(1, age=130, segment="SMB"), customer(3, age=None, email=None, segment=None),
           (None, "n", "e", 10, "smb", "US", -1.0, None)]
    checks = [Q.expect_row_count_between(2, 3), Q.expect_not_null("email"), Q.expect_unique("customer_id"),
              Q.expect_in_set("segment", ["smb"]), Q.expect_between("age", 0, 120),
              Q.expect_between("acquisition_cost", 0)]
    ok = _report(spark, good, checks)
    assert all(r.success for r in ok.values())
    r = _report(spark, bad, checks)
    assert not r[(Q.ROW_COUNT, None)].success and r[(Q.ROW_COUNT, None)].element_count == 4
    nn = r[(Q.NOT_NULL, "email")]
    assert not nn.success and nn.unexpected_count == 1 and nn.missing_count == 1
    u = r[(Q.UNIQUE, "customer_id")]
    assert not u.success and u.unexpected_count == 2 and u.missing_count == 1 and u.element_count == 4
    s = r[(Q.IN_SET, "segment")]
    assert not s.success and s.unexpected_count == 1 and s.missing_count == 1  # case-sensitive, null ignored
    b = r[(Q.BETWEEN, "age")]
    assert not b.success and b.unexpected_count == 1 and b.missing_count == 1
    assert not r[(Q.BETWEEN, "acquisition_cost")].success


def test_gate_collects_all_failures(spark):
    rep = Q.run_suite(raw(spark, "customers", [customer(1), customer(1)]), "customers",
                      [Q.expect_unique("customer_id"), Q.expect_row_count_between(5)])
    with pytest.raises(Q.QualityGateError) as e:
        Q.quality_gate(rep)
    assert "2 expectation(s) failed" in str(e.value)
    ok = Q.run_suite(raw(spark, "customers", [customer(1)]), "customers", [Q.expect_unique("customer_id")])
    assert Q.quality_gate(ok) is ok


def test_empty_table(spark):
    r = Q.run_suite(raw(spark, "customers", []), "customers",
                    [Q.expect_row_count_between(1), Q.expect_not_null("email"), Q.expect_unique("customer_id")]).collect()
    by = {x.check: x for x in r}
    assert not by[Q.ROW_COUNT].success and by[Q.NOT_NULL].success and by[Q.UNIQUE].success


def test_schema_tests_count_like_dbt(spark):
    df = raw(spark, "customers", [customer(1, segment="a"), customer(1, segment="b"), customer(2, segment="b"),
                                  customer(3, segment="c"), customer(3, segment=None)])
    assert Q.schema_test_unique(df, "m", "customer_id").first().failures == 2      # repeated values
    assert Q.schema_test_accepted_values(df, "m", "segment", ["a"]).first().failures == 2  # distinct b, c
    assert Q.schema_test_not_null(df, "m", "segment").first().failures == 1


def test_null_gate_allows_listed_columns(spark):
    ch = raw(spark, "churn_labels", [churn(1, True), (2, True, 0.5, None, None)])
    with pytest.raises(Q.NullGateError):
        Q.null_gate({"churn_labels": ch})
    Q.null_gate({"churn_labels": ch}, {"churn_labels": ["last_activity_date", "days_since_last_order"]})


def test_null_census_and_value_counts(spark):
    df = raw(spark, "customers", [customer(1, segment="a"), customer(2, segment=None, email=None),
                                  customer(3, segment="a")])
    rows = {r.column_name: r for r in Q.null_census(df, "customers").collect()}
    assert rows["segment"].null_count == 1 and rows["email"].null_count == 1
    assert rows["segment"].table_null_count == 2 and rows["segment"].rows_with_null == 1
    vc = [(r.column_name, r.value, r["count"]) for r in Q.value_counts(df, "customers", ["segment"]).collect()]
    assert vc == [("segment", "a", 2)]


def test_merged_profile_equals_separate_operators(spark):
    import __spark_entry__  # noqa: F401  (path setup)
    from tidemark.sources import fixtures as fx
    raw = fx.raw_tables(spark, "/root/testdata/sf0.001")
    raw = {k: v.fillna({"days_since_last_order": 0}) if k == "churn_labels" else v for k, v in raw.items()}
    suites = Q.raw_suites(fx.FIXTURE_SEGMENTS)
    allow = {"events": ["campaign_id"], "churn_labels": ["last_activity_date"]}
    report, census, summary, errors = Q.profile_tables(raw, suites, allow)
    assert errors == []
    want = Q.run_suites(raw, suites)
    key = lambda r: (r["suite"], r["check"], r["column"] or "")
    assert sorted(map(tuple, report.collect()), key=lambda t: (t[0], t[1], t[2] or "")) == \
        sorted(map(tuple, want.collect()), key=lambda t: (t[0], t[1], t[2] or ""))
    sep = Q.table_summary(raw["customers"], raw["events"], raw["orders"], raw["churn_labels"])
    cols = sep.columns
    assert sorted(map(tuple, summary.select(*cols).collect()), key=str) == sorted(map(tuple, sep.collect()), key=str)


def test_sieve_equals_counting_every_key(spark, monkeypatch):
    from pyspark.sql import functions as F
    a = spark.range(1000).select((F.col("id") % 997).alias("x"), F.col("id").cast("string").alias("y"),
                                 F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("z"))
    b = spark.range(50).select(F.col("id").alias("x"), F.lit(None).cast("string").alias("y"))
    keys = [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", "y"), ("c", "x")]
    tables = {"a": a, "b": b, "c": b.limit(0)}
    want = {("a", "x"): (3, 6), ("a", "y"): (0, 0), ("a", "z"): (1, 666), ("b", "x"): (0, 0), ("b", "y"): (0, 0),
            ("c", "x"): (0, 0)}
    assert Q.repeated_keys(tables, keys) == want
    assert Q.repeated_keys(tables, []) == {}
    # Hashes that collide all the time: the values decide.
    monkeypatch.setattr(Q.F, "xxhash64", lambda c: F.length(c.cast("string")).cast("long"))
    assert Q.repeated_keys(tables, keys) == want


def test_figures_observed_while_landing_equal_a_profile(spark, tmpdir_path):
    import os
    from test_sources import _make_csvs
    from tidemark.sources import raw as raw_io
    _make_csvs(tmpdir_path, 130, 1600)
    for name in ("customers.csv", "orders.csv"):         # repeated rows, and a table without any
        path = os.path.join(tmpdir_path, name)
        lines = open(path).readlines()
        with open(path, "w") as f:
            f.writelines(lines + lines[1:3] if name == "customers.csv" else lines[:1])
    suites = Q.raw_suites()
    allow = {"events": ["campaign_id"]}
    landed, seen = raw_io.land_observed(spark, tmpdir_path, os.path.join(tmpdir_path, "wh"),
                                        lambda t, cols: Q.profile_aggregates(t, cols, suites[t], allow.get(t, ())))
    tables = {t: spark.read.parquet(p) for t, p in landed.items()}
    got = Q.profile_tables(tables, suites, allow, observed=seen)
    want = Q.profile_tables(tables, suites, allow)
    for g, w in zip(got[:3], want[:3]):
        assert sorted(map(str, g.collect())) == sorted(map(str, w.collect()))
    assert got[3] == want[3] == []
    by = {(r.suite, r.check): r for r in got[0].where("column is null or column in ('customer_id', 'order_id')").collect()}
    assert by["customers", Q.UNIQUE].unexpected_count == 4
    assert by["orders", Q.ROW_COUNT].element_count == 0 and not by["orders", Q.ROW_COUNT].success
