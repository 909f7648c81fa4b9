"""Data-quality operators (Q1-Q13) and table profiles.

A suite runs as distributed aggregates, never by pulling rows to the driver:

* every row-count / not-null / in-set / between check of one table is one
  column of a single ``agg`` (one scan of the table); while a table is landed
  these aggregates ride on the write itself (``profile_aggregates`` as an
  ``Observation``), with no scan of their own;
* all uniqueness checks of all tables share one sieve (``repeated_keys``): a
  64-bit hash per value is counted, in one scan a table and one shuffle, and
  only values whose hash comes twice are counted exactly;
* report rows are produced lazily with ``inline`` over the aggregate row.

Only the gates collect, and what they collect is the report: one row per
check.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

REPORT_SCHEMA = T.StructType([
    T.StructField("suite", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("missing_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
])

ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"


@dataclass(frozen=True)
class Check:
    check: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = field(default_factory=tuple)


def expect_row_count_between(min_value=None, max_value=None) -> Check:
    """Q1."""
    return Check(ROW_COUNT, None, min_value, max_value)


def expect_not_null(column: str) -> Check:
    """Q2."""
    return Check(NOT_NULL, column)


def expect_unique(column: str) -> Check:
    """Q3: every row of a repeated non-null value is unexpected."""
    return Check(UNIQUE, column)


def expect_in_set(column: str, values) -> Check:
    """Q4: nulls ignored; case-sensitive."""
    return Check(IN_SET, column, value_set=tuple(values))


def expect_between(column: str, min_value=None, max_value=None) -> Check:
    """Q5: inclusive bounds; nulls ignored."""
    return Check(BETWEEN, column, min_value, max_value)


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def _report_struct(suite: str, chk: Check, success: Column, element: Column,
                   missing: Column | None, unexpected: Column | None) -> Column:
    return F.struct(
        F.lit(suite).alias("suite"), F.lit(chk.check).alias("check"),
        F.lit(chk.column).cast("string").alias("column"), success.alias("success"),
        element.cast("long").alias("element_count"),
        (missing if missing is not None else F.lit(None)).cast("long").alias("missing_count"),
        (unexpected if unexpected is not None else F.lit(None)).cast("long").alias("unexpected_count"),
    )


def repeated_keys(tables: dict[str, DataFrame], keys: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, int]]:
    """How many non-null values of each (table, column) occur more than once, and on how many rows.

    A sieve first: every table is read once for all of its keys, each value
    becomes a 64-bit hash, and the hashes of all tables are counted together
    (equal ones combine before the shuffle, so a value on a third of all rows
    costs a row per task).  Unique keys end there: values are never shuffled.
    Where hashes come twice, the rows that hold them are met with those hashes
    and their values counted, so a collision of hashes is no duplicate.
    """
    if not keys:
        return {}
    number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    hashed = None
    for table in dict.fromkeys(t for t, _ in number):
        own = [(i, c) for (t, c), i in number.items() if t == table]
        marks = F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("k"), F.xxhash64(F.col(c)).alias("h")))
                          for i, c in own])
        part = tables[table].select(F.explode(marks).alias("m")).where("m is not null").select("m.k", "m.h")
        hashed = part if hashed is None else hashed.unionByName(part)
    ensure_checkpoint_dir(hashed.sparkSession)
    again = (hashed.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "h").checkpoint())
    suspects = {r["k"] for r in again.select("k").distinct().collect()}        # a number per key at most
    out = {k: (0, 0) for k in number}
    for (table, column), i in number.items():
        if i in suspects:
            c = F.col(column)
            rows = tables[table].where(c.isNotNull()).select(c.alias("v"), F.xxhash64(c).alias("h"))
            counts = (rows.join(again.where(F.col("k") == i).select("h"), "h", "left_semi")
                      .groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
            found = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
            out[table, column] = (found["v"], found["n"])
    return out


def _unique_keys(suites: dict[str, list[Check]]) -> list[tuple[str, str]]:
    return [(t, c.column) for t, checks in suites.items() for c in checks if c.check == UNIQUE]


def _scan_checks(df: DataFrame, suite: str, checks: list[Check], repeated: dict[str, int]) -> DataFrame:
    """All checks of one table in one aggregate; ``repeated``: rows of repeated values by column."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, chk in enumerate(checks):
        if chk.check != ROW_COUNT:
            c = F.col(chk.column)
            aggs.append(F.count_if(c.isNull()).alias(f"_m{i}"))
            aggs += _unexpected(chk, f"_u{i}")
    row = df.agg(*aggs)
    n = F.col("_n")
    structs = []
    for i, chk in enumerate(checks):
        if chk.check == ROW_COUNT:
            ok = F.lit(True)
            if chk.min_value is not None:
                ok = ok & (n >= F.lit(chk.min_value))
            if chk.max_value is not None:
                ok = ok & (n <= F.lit(chk.max_value))
            structs.append(_report_struct(suite, chk, ok, n, None, None))
            continue
        m = F.col(f"_m{i}")
        u = m if chk.check == NOT_NULL else F.lit(repeated[chk.column]) if chk.check == UNIQUE else F.col(f"_u{i}")
        structs.append(_report_struct(suite, chk, u == 0, n, m, u))
    return row.select(F.inline(F.array(*structs)))


def _unexpected(chk: Check, name: str) -> list[Column]:
    """The aggregate that counts a check's unexpected values, for the checks that need one."""
    if chk.check not in (IN_SET, BETWEEN):
        return []
    c = F.col(chk.column)
    wrong = ~c.isin(*chk.value_set) if chk.check == IN_SET else _outside(c, chk.min_value, chk.max_value)
    return [F.count_if(c.isNotNull() & wrong).alias(name)]


def run_suite(df: DataFrame, suite: str, checks: list[Check]) -> DataFrame:
    """Q6: report rows (suite, check, column, success, element/missing/unexpected counts)."""
    return run_suites({suite: df}, {suite: checks})


def run_suites(tables: dict[str, DataFrame], suites: dict[str, list[Check]]) -> DataFrame:
    repeated = repeated_keys(tables, _unique_keys(suites))
    out = None
    for name, checks in suites.items():
        r = _scan_checks(tables[name], name, checks, {c: n for (t, c), (_, n) in repeated.items() if t == name})
        out = r if out is None else out.unionByName(r)
    return out


class QualityGateError(ValueError):
    pass


def failing(report: DataFrame) -> DataFrame:
    """The checks of a report that failed."""
    return report.where(~F.col("success"))


def quality_gate(report: DataFrame) -> DataFrame:
    """Q7: run every check, then raise once listing all failures."""
    failed = failing(report).collect()  # one row per check at most
    if failed:
        lines = [f"[{r['suite']}] {r['check']}({r['column']}): unexpected={r['unexpected_count']} "
                 f"missing={r['missing_count']} elements={r['element_count']}" for r in failed]
        raise QualityGateError(f"{len(failed)} expectation(s) failed:\n" + "\n".join(lines))
    return report


# --- the reference's 45 expectations (fixed values) -------------------------------

REFERENCE_SEGMENTS = ["enterprise", "smb", "consumer", "startup"]
ORDER_STATUSES = ["completed", "pending", "cancelled", "refunded"]


def raw_suites(segments=REFERENCE_SEGMENTS) -> dict[str, list[Check]]:
    """Q8: 24 checks over the four raw tables."""
    return {
        "customers": [
            expect_row_count_between(100),
            expect_not_null("customer_id"),
            expect_not_null("email"),
            expect_unique("customer_id"),
            expect_in_set("segment", segments),
            expect_between("age", 0, 120),
            expect_between("acquisition_cost", 0),
        ],
        "events": [
            expect_row_count_between(1000),
            expect_not_null("event_id"),
            expect_not_null("customer_id"),
            expect_unique("event_id"),
            expect_not_null("event_type"),
            expect_between("session_duration_seconds", 0),
        ],
        "orders": [
            expect_row_count_between(100),
            expect_not_null("order_id"),
            expect_not_null("customer_id"),
            expect_unique("order_id"),
            expect_between("order_amount", 0, 100_000),
            expect_in_set("status", ORDER_STATUSES),
        ],
        "churn_labels": [
            expect_row_count_between(100),
            expect_not_null("customer_id"),
            expect_unique("customer_id"),
            expect_between("churn_probability", 0, 1),
            expect_not_null("days_since_last_order"),
        ],
    }


def mart_suites() -> dict[str, list[Check]]:
    """Q9: 21 checks over the three marts (full tables, D6/D7)."""
    return {
        "mart_customer_ltv": [
            expect_row_count_between(100),
            expect_not_null("customer_id"),
            expect_unique("customer_id"),
            expect_not_null("total_orders"),
            expect_between("total_orders", 0),
            expect_between("total_revenue", 0),
            expect_not_null("net_ltv"),
            expect_between("churn_probability", 0, 1),
        ],
        "mart_campaign_performance": [
            expect_row_count_between(1),
            expect_not_null("campaign_id"),
            expect_not_null("channel"),
            expect_between("total_impressions", 0),
            expect_between("total_clicks", 0),
            expect_between("attributed_revenue", 0),
            expect_between("conversion_rate_pct", 0),
        ],
        "mart_churn_summary": [
            expect_row_count_between(1),
            expect_not_null("segment"),
            expect_not_null("region"),
            expect_between("total_customers", 1),
            expect_between("churn_rate_pct", 0, 100),
            expect_between("avg_churn_probability", 0, 1),
        ],
    }


# --- dbt-style schema tests (Q10-Q12) ------------------------------------------------

SCHEMA_REPORT = ["model", "test", "column", "failures"]


def schema_test_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q10: failures = rows where the column is null."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("not_null").alias("test"), F.lit(column).alias("column"),
        F.col("failures").cast("long").alias("failures"))


def schema_test_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q11: failures = non-null values that occur more than once."""
    return _unique_tests({model: df}, [(model, column)])


def _unique_tests(models: dict[str, DataFrame], keys: list[tuple[str, str]]) -> DataFrame:
    """Q11 for all keys at once: one sieve over all models."""
    spark = next(iter(models.values())).sparkSession
    rows = [(t, "unique", c, values) for (t, c), (values, _) in repeated_keys(models, keys).items()]
    return spark.createDataFrame(rows, "model string, test string, column string, failures long")


def schema_test_accepted_values(df: DataFrame, model: str, column: str, values) -> DataFrame:
    """Q12: failures = distinct non-null values outside the list (checked after cleaning)."""
    c = F.col(column)
    bad = df.where(c.isNotNull() & ~c.isin(*values)).select(c).distinct()
    return bad.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("accepted_values").alias("test"), F.lit(column).alias("column"),
        F.col("failures").cast("long").alias("failures"))


def schema_tests(segments=REFERENCE_SEGMENTS) -> list[tuple]:
    """The 30 schema tests as (model, test, column, values)."""
    t = []
    for model, col in [("stg_customers", "customer_id"), ("stg_orders", "order_id"),
                       ("stg_events", "event_id"), ("stg_churn_labels", "customer_id"),
                       ("mart_customer_ltv", "customer_id")]:
        t.append((model, "unique", col, None))
    nn = {
        "stg_customers": ["customer_id", "email", "signup_date"],
        "stg_orders": ["order_id", "customer_id", "order_amount"],
        "stg_events": ["event_id", "customer_id", "event_type"],
        "stg_churn_labels": ["customer_id", "churn_probability"],
        "mart_customer_ltv": ["customer_id", "total_revenue", "net_ltv", "churn_probability"],
        "mart_churn_summary": ["segment", "region", "churn_rate_pct", "revenue_at_risk"],
        "mart_campaign_performance": ["campaign_id", "channel", "total_impressions", "attributed_revenue"],
    }
    for model, cols in nn.items():
        t += [(model, "not_null", c, None) for c in cols]
    t.append(("stg_customers", "accepted_values", "segment", tuple(segments)))
    t.append(("stg_orders", "accepted_values", "status", tuple(ORDER_STATUSES)))
    return t


def run_schema_tests(models: dict[str, DataFrame], tests: list[tuple]) -> DataFrame:
    """All schema tests; the not-null tests of one model share one aggregate, the unique tests of all one sieve."""
    parts = []
    by_model: dict[str, list[str]] = {}
    keys = [(model, col) for model, test, col, _ in tests if test == "unique"]
    if keys:
        parts.append(_unique_tests(models, keys))
    for model, test, col, values in tests:
        if test == "not_null":
            by_model.setdefault(model, []).append(col)
        elif test != "unique":
            parts.append(schema_test_accepted_values(models[model], model, col, values))
    for model, cols in by_model.items():
        row = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(f"_f{i}") for i, c in enumerate(cols)])
        parts.append(row.select(F.inline(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit("not_null").alias("test"), F.lit(c).alias("column"),
                     F.col(f"_f{i}").cast("long").alias("failures")) for i, c in enumerate(cols)]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- profiles ---------------------------------------------------------------------

def null_census(df: DataFrame, table: str) -> DataFrame:
    """Nulls per column, total nulls and rows with any null, in one pass."""
    cols = df.columns
    any_null = F.lit(False)
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
        any_null = any_null | F.col(c).isNull()
    aggs.append(F.count_if(any_null).alias("_rows"))
    row = df.agg(*aggs)
    total = sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0).cast("long"))
    per_col = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("long").alias("null_count"))
                        for i, c in enumerate(cols)])
    return row.select(F.lit(table).alias("table_name"), total.cast("long").alias("table_null_count"),
                      F.col("_rows").cast("long").alias("rows_with_null"),
                      F.inline(per_col))


class NullGateError(ValueError):
    pass


def null_gate_failures(census: DataFrame) -> DataFrame:
    """Tables of a null census that have nulls."""
    return (census.select("table_name", "table_null_count", "rows_with_null").distinct()
            .where(F.col("table_null_count") > 0))


def null_gate(tables: dict[str, DataFrame], allow_null: dict[str, list[str]] | None = None) -> DataFrame:
    """Q13: raise if any table has a null outside its allowed columns."""
    allow_null = allow_null or {}
    out = None
    for name, df in tables.items():
        keep = [c for c in df.columns if c not in set(allow_null.get(name, []))]
        r = null_census(df.select(*keep), name)
        out = r if out is None else out.unionByName(r)
    bad = null_gate_failures(out).collect()      # one row per table
    if bad:
        raise NullGateError("; ".join(f"{r['table_name']}: found {r['table_null_count']} null values across "
                                      f"{r['rows_with_null']} rows" for r in bad))
    return out


def value_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Count per value of each column, nulls dropped, in one scan.

    Columns are unpivoted into (column, value) pairs and counted together.
    Order at read time (most frequent first), once for all tables.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    counts = (df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))
    return counts.select(F.lit(table).alias("table_name"), "column_name", "value", "count")


def table_summary(customers: DataFrame, events: DataFrame, orders: DataFrame,
                  churn: DataFrame) -> DataFrame:
    """One row per table with its summary figures (one global agg each)."""
    c = customers.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("customers").alias("table_name"), "*")
    e = events.agg(F.count(F.lit(1)).alias("row_count"),
                   F.min("event_timestamp").alias("first_event_at"),
                   F.max("event_timestamp").alias("last_event_at")).select(F.lit("events").alias("table_name"), "*")
    from ..functions.scalars import money_avg, money_sum
    o = orders.agg(F.count(F.lit(1)).alias("row_count"),
                   money_sum("order_amount").alias("order_total"),
                   money_avg("order_amount").alias("order_mean")
                   ).select(F.lit("orders").alias("table_name"), "*")
    ch = churn.agg(F.count(F.lit(1)).alias("row_count"),
                   F.count_if(F.col("is_churned")).alias("churned"),
                   F.try_divide(F.count_if(F.col("is_churned")), F.count("is_churned")).alias("churn_rate")
                   ).select(F.lit("churn_labels").alias("table_name"), "*")
    return (c.unionByName(e, allowMissingColumns=True).unionByName(o, allowMissingColumns=True)
            .unionByName(ch, allowMissingColumns=True))


# --- merged raw-table gates: one scan per table ----------------------

def profile_gates(tables: dict[str, DataFrame], suites: dict[str, list[Check]],
                  allow_null: dict[str, list[str]] | None = None, strict_nulls: bool = False,
                  observed: dict[str, dict] | None = None):
    """Null gate, then expectation gate, from ``profile_tables``.

    Raises ``NullGateError`` first (as the reference's file check does), then
    ``QualityGateError`` listing every failed expectation.  Returns
    ``(report, census, summary)``.
    """
    report, census, summary, null_errors = profile_tables(tables, suites, allow_null, strict_nulls, observed)
    if null_errors:
        raise NullGateError("; ".join(null_errors))
    quality_gate(report)
    return report, census, summary


def profile_aggregates(table: str, columns: list[str], checks: list[Check], allowed=()) -> list[Column]:
    """All figures of a table that one pass can give: rows, nulls, non-unique checks and summary.

    Plain aggregates, so they can be an ``agg`` of their own or be observed on
    a write of the table."""
    any_null = F.lit(False)
    for c in columns:
        if c not in allowed:
            any_null = any_null | F.col(c).isNull()
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(any_null).alias("_rows_null")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)]
    for j, chk in enumerate(checks):
        aggs += _unexpected(chk, f"_u{j}")
    return aggs + _summary_aggs().get(table, [])


def profile_tables(tables: dict[str, DataFrame], suites: dict[str, list[Check]],
                   allow_null: dict[str, list[str]] | None = None, strict_nulls: bool = False,
                   observed: dict[str, dict] | None = None):
    """Null census, summary figures and all expectations of each table.

    The figures of ``profile_aggregates`` come from one aggregate per table,
    or are given: ``observed``, by table, as seen while the tables were
    written (with the same ``allow_null``).  The uniqueness checks of all
    tables share one sieve.  Only aggregate rows reach the driver.
    Returns ``(report, census, summary, null_errors)``.
    """
    spark = next(iter(tables.values())).sparkSession
    allow_null = {} if strict_nulls else (allow_null or {})
    report_rows, census_rows, summary_rows, null_errors = [], [], [], []
    repeated = repeated_keys(tables, _unique_keys(suites))
    for name, df in tables.items():
        cols, checks, allowed = df.columns, suites.get(name, []), set(allow_null.get(name, []))
        row = (observed[name] if observed is not None
               else df.agg(*profile_aggregates(name, cols, checks, allowed)).first().asDict())    # one row per table
        n = row["_n"]
        nulls = {c: row[f"_null_{i}"] for i, c in enumerate(cols)}
        total = sum(nulls[c] for c in cols if c not in allowed)
        for c in cols:
            census_rows.append((name, total, row["_rows_null"], c, nulls[c]))
        if total:
            null_errors.append(f"{name}: found {total} null values across {row['_rows_null']} rows")
        for j, chk in enumerate(checks):
            if chk.check == ROW_COUNT:
                ok = (chk.min_value is None or n >= chk.min_value) and (chk.max_value is None or n <= chk.max_value)
                report_rows.append((name, chk.check, None, bool(ok), n, None, None))
                continue
            m = nulls[chk.column]
            u = m if chk.check == NOT_NULL else repeated[name, chk.column][1] if chk.check == UNIQUE else row[f"_u{j}"]
            report_rows.append((name, chk.check, chk.column, u == 0, n, m, u))
        summary_rows.append({k: v for k, v in row.items() if not k.startswith("_")} | {"table_name": name, "row_count": n})
    report = spark.createDataFrame(report_rows, REPORT_SCHEMA)
    census = spark.createDataFrame(census_rows, "table_name string, table_null_count long, rows_with_null long, "
                                                "column_name string, null_count long")
    summary = spark.createDataFrame(
        [(s.get("table_name"), s.get("row_count"), s.get("first_event_at"), s.get("last_event_at"),
          s.get("order_total"), s.get("order_mean"), s.get("churned"), s.get("churn_rate")) for s in summary_rows],
        "table_name string, row_count long, first_event_at timestamp_ntz, last_event_at timestamp_ntz, "
        "order_total double, order_mean double, churned long, churn_rate double")
    return report, census, summary, null_errors


def _summary_aggs() -> dict:
    from ..functions.scalars import money_avg, money_sum
    return {
        "events": [F.min("event_timestamp").alias("first_event_at"), F.max("event_timestamp").alias("last_event_at")],
        "orders": [money_sum("order_amount").alias("order_total"), money_avg("order_amount").alias("order_mean")],
        "churn_labels": [F.count_if(F.col("is_churned")).alias("churned"),
                         F.try_divide(F.count_if(F.col("is_churned")), F.count("is_churned")).alias("churn_rate")],
    }
