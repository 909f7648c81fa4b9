"""Oracle SELECTs per query name; ``oracle.with_base`` prepends the shared CTEs.

A value is either a SELECT string or ``(select, extra_ctes)``.
"""

from __future__ import annotations

from .oracle import mean, money, rhu

CAMP = "'camp_' || lpad(CAST(event_id % 50 + 1 AS VARCHAR), 4, '0')"

ORACLE: dict = {
    # P
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_events": "SELECT * FROM stg_events",
    "stg_churn_labels": "SELECT * FROM stg_churn_labels",
    "completed_orders": "SELECT * FROM stg_orders WHERE status = 'completed'",
    "clicked_events": "SELECT * FROM stg_events WHERE clicked_ad = true AND campaign_id IS NOT NULL",
    "campaign_not_null": """SELECT event_id, customer_id, campaign_id, channel, clicked_ad
                            FROM stg_events WHERE campaign_id IS NOT NULL""",
    "labelled_only": "SELECT customer_id, is_churned FROM mart_customer_ltv WHERE is_churned IS NOT NULL",
    "purchase_events": """SELECT event_id, customer_id, event_at, event_date
                          FROM stg_events WHERE event_type = 'purchase'""",
    # A / J / W
    "order_stats": "SELECT * FROM order_stats",
    "ltv_join_orders": """SELECT c.customer_id, coalesce(o.total_orders, 0) AS total_orders,
                                 coalesce(o.total_revenue, 0.0) AS total_revenue
                          FROM stg_customers c LEFT JOIN order_stats o ON o.customer_id = c.customer_id""",
    "ltv_join_churn": """SELECT c.customer_id, ch.churn_probability, ch.is_churned
                         FROM stg_customers c LEFT JOIN stg_churn_labels ch ON ch.customer_id = c.customer_id""",
    "mart_customer_ltv": "SELECT * FROM mart_customer_ltv",
    "last_click": "SELECT * FROM last_click",
    "attribute_orders": "SELECT * FROM attributed",
    "event_stats": "SELECT * FROM event_stats",
    "revenue_stats": "SELECT * FROM revenue_stats",
    "campaign_join_revenue": """SELECT es.campaign_id, es.channel, es.total_clicks, rs.attributed_orders,
                                       rs.attributed_revenue
                                FROM event_stats es LEFT JOIN revenue_stats rs USING (campaign_id)""",
    "mart_campaign_performance": "SELECT * FROM mart_campaign_performance",
    "mart_churn_summary": "SELECT * FROM mart_churn_summary",
    "top_campaigns": """SELECT campaign_id, channel, attributed_revenue FROM mart_campaign_performance
                        ORDER BY attributed_revenue DESC, campaign_id, channel""",
    "top_churn_segments": """SELECT segment, region, churn_rate_pct FROM mart_churn_summary
                             ORDER BY churn_rate_pct DESC, segment, region""",
    "count_if": """SELECT event_type, CAST(count_if(clicked_ad) AS BIGINT) AS n_clicked
                   FROM stg_events GROUP BY event_type""",
    "count_distinct_users": """SELECT channel, count(DISTINCT customer_id) AS unique_users
                               FROM stg_events GROUP BY channel""",
    "conditional_sum": f"""SELECT segment,
                                  CAST(ifnull(sum({money('total_revenue')}) FILTER (WHERE is_churned = false), 0)
                                       AS DOUBLE) AS active_revenue
                           FROM mart_customer_ltv GROUP BY segment""",
    "group_ratio_pct": f"""SELECT region, {rhu('count_if(is_churned) / count(customer_id) * 100', 2)} AS churn_rate_pct
                           FROM mart_customer_ltv GROUP BY region""",
    # D
    "clicked_flag": f"""SELECT event_id, event_type, event_type IN ('click', 'purchase') AS clicked_ad,
                               CASE WHEN event_type IN ('click', 'purchase') THEN {CAMP} END AS campaign_id
                        FROM events""",
    "orders_from_purchases": """SELECT event_id AS order_id, user_id AS customer_id, ts AS order_date,
                                       CAST(value AS DOUBLE) AS order_amount
                                FROM events WHERE event_type = 'purchase'""",
    "orders_numbered": """SELECT row_number() OVER (ORDER BY ts, event_id) AS order_id, user_id AS customer_id,
                                 ts AS order_date, CAST(value AS DOUBLE) AS order_amount
                          FROM events WHERE event_type = 'purchase'""",
    "latest_per_key": "SELECT * FROM latest_purchase",
    "label_all_customers": """SELECT c.c_custkey AS customer_id, l.last_purchase_at
                              FROM customer c LEFT JOIN latest_purchase l ON l.customer_id = c.c_custkey""",
    "churn_labels": "SELECT * FROM raw_churn_labels",
    "attribute_orders_asof": (f"""
        SELECT o.order_id, o.customer_id, o.ordered_at, o.order_amount, c.campaign_id, c.event_at AS clicked_at
        FROM asof_orders o ASOF LEFT JOIN asof_clicks c
          ON o.customer_id = c.customer_id AND o.ordered_at >= c.event_at""", {
        "asof_orders": """SELECT event_id AS order_id, user_id AS customer_id, ts AS ordered_at,
                                 value AS order_amount FROM events WHERE event_type = 'purchase'""",
        "asof_clicks": f"""SELECT event_id, user_id AS customer_id, ts AS event_at, {CAMP} AS campaign_id
                           FROM events WHERE event_type = 'click'""",
    }),
}


# --- Q: data quality (SQL written per check; same check lists as data) -------------

def _q_table(name: str) -> str:
    return {"customers": "raw_customers", "events": "raw_events", "orders": "raw_orders",
            "churn_labels": "raw_churn_labels"}.get(name, name)


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


# The expectations, as (table, column, kind, arguments); no column: the table's row count.
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")
_RAW_CHECKS = (
    ("customers", None, "rows", (100, None)), ("customers", "customer_id", "not_null", ()),
    ("customers", "email", "not_null", ()), ("customers", "customer_id", "unique", ()),
    ("customers", "segment", "in", _SEGMENTS), ("customers", "age", "between", (0, 120)),
    ("customers", "acquisition_cost", "between", (0, None)),
    ("events", None, "rows", (1000, None)), ("events", "event_id", "not_null", ()),
    ("events", "customer_id", "not_null", ()), ("events", "event_id", "unique", ()),
    ("events", "event_type", "not_null", ()), ("events", "session_duration_seconds", "between", (0, None)),
    ("orders", None, "rows", (100, None)), ("orders", "order_id", "not_null", ()),
    ("orders", "customer_id", "not_null", ()), ("orders", "order_id", "unique", ()),
    ("orders", "order_amount", "between", (0, 100000)),
    ("orders", "status", "in", ("completed", "pending", "cancelled", "refunded")),
    ("churn_labels", None, "rows", (100, None)), ("churn_labels", "customer_id", "not_null", ()),
    ("churn_labels", "customer_id", "unique", ()), ("churn_labels", "churn_probability", "between", (0, 1)),
    ("churn_labels", "days_since_last_order", "not_null", ()),
)
_MART_CHECKS = (
    ("mart_customer_ltv", None, "rows", (100, None)), ("mart_customer_ltv", "customer_id", "not_null", ()),
    ("mart_customer_ltv", "customer_id", "unique", ()), ("mart_customer_ltv", "total_orders", "not_null", ()),
    ("mart_customer_ltv", "total_orders", "between", (0, None)),
    ("mart_customer_ltv", "total_revenue", "between", (0, None)), ("mart_customer_ltv", "net_ltv", "not_null", ()),
    ("mart_customer_ltv", "churn_probability", "between", (0, 1)),
    ("mart_campaign_performance", None, "rows", (1, None)),
    ("mart_campaign_performance", "campaign_id", "not_null", ()),
    ("mart_campaign_performance", "channel", "not_null", ()),
    ("mart_campaign_performance", "total_impressions", "between", (0, None)),
    ("mart_campaign_performance", "total_clicks", "between", (0, None)),
    ("mart_campaign_performance", "attributed_revenue", "between", (0, None)),
    ("mart_campaign_performance", "conversion_rate_pct", "between", (0, None)),
    ("mart_churn_summary", None, "rows", (1, None)), ("mart_churn_summary", "segment", "not_null", ()),
    ("mart_churn_summary", "region", "not_null", ()), ("mart_churn_summary", "total_customers", "between", (1, None)),
    ("mart_churn_summary", "churn_rate_pct", "between", (0, 100)),
    ("mart_churn_summary", "avg_churn_probability", "between", (0, 1)),
)
_KINDS = {"rows": "expect_table_row_count_to_be_between", "not_null": "expect_column_values_to_not_be_null",
          "unique": "expect_column_values_to_be_unique", "in": "expect_column_values_to_be_in_set",
          "between": "expect_column_values_to_be_between"}
# The schema tests, as (model, test, columns, accepted values).
_SCHEMA_TESTS = (
    ("stg_customers", "unique", ("customer_id",), ()), ("stg_orders", "unique", ("order_id",), ()),
    ("stg_events", "unique", ("event_id",), ()), ("stg_churn_labels", "unique", ("customer_id",), ()),
    ("mart_customer_ltv", "unique", ("customer_id",), ()),
    ("stg_customers", "not_null", ("customer_id", "email", "signup_date"), ()),
    ("stg_orders", "not_null", ("order_id", "customer_id", "order_amount"), ()),
    ("stg_events", "not_null", ("event_id", "customer_id", "event_type"), ()),
    ("stg_churn_labels", "not_null", ("customer_id", "churn_probability"), ()),
    ("mart_customer_ltv", "not_null", ("customer_id", "total_revenue", "net_ltv", "churn_probability"), ()),
    ("mart_churn_summary", "not_null", ("segment", "region", "churn_rate_pct", "revenue_at_risk"), ()),
    ("mart_campaign_performance", "not_null", ("campaign_id", "channel", "total_impressions", "attributed_revenue"), ()),
    ("stg_customers", "accepted_values", ("segment",), tuple(s.lower() for s in _SEGMENTS)),
    ("stg_orders", "accepted_values", ("status",), ("completed", "pending", "cancelled", "refunded")),
)


def _check_sql(table: str, col: str | None, kind: str, args: tuple) -> str:
    """A report row: the count of offending values decides."""
    lo, hi = args if kind in ("rows", "between") else (None, None)
    outside = lambda v: " OR ".join(
        [f"{v} < {lo}"] * (lo is not None) + [f"{v} > {hi}"] * (hi is not None)) or "false"
    missing = f"count(*) FILTER (WHERE {col} IS NULL)"
    source = _q_table(table)
    if kind == "rows":
        missing, bad, success = "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)", f"NOT ({outside('count(*)')})"
    else:
        if kind == "unique":
            source = f"(SELECT {col}, count(*) OVER (PARTITION BY {col}) AS alike FROM {source})"
        offends = {"not_null": f"{col} IS NULL", "unique": f"{col} IS NOT NULL AND alike > 1",
                   "in": f"{col} NOT IN ({', '.join(map(_lit, args))})", "between": outside(col)}[kind]
        bad = f"count(*) FILTER (WHERE {offends})"
        success = f"{bad} = 0"
    column = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{table}' AS suite, '{_KINDS[kind]}' AS \"check\", {column} AS \"column\", {success} AS success, "
            f"count(*) AS element_count, {missing} AS missing_count, {bad} AS unexpected_count FROM {source}")


def suites_sql(checks) -> str:
    return "\nUNION ALL\n".join(_check_sql(*c) for c in checks)


def _schema_sql(model, test, col, values) -> str:
    failing = {
        "not_null": f"SELECT 1 FROM {model} WHERE {col} IS NULL",
        "unique": f"SELECT 1 FROM {model} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1",
        "accepted_values": f"SELECT DISTINCT {col} FROM {model} WHERE {col} NOT IN ({', '.join(map(_lit, values))})",
    }[test]
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", count(*) AS failures "
            f"FROM ({failing})")


def _quality_oracle() -> dict:
    every = _RAW_CHECKS + _MART_CHECKS
    out = {}
    for name, kind in [("expect_row_count_between", "rows"), ("expect_not_null", "not_null"),
                       ("expect_unique", "unique"), ("expect_in_set", "in"), ("expect_between", "between")]:
        out[name] = suites_sql(c for c in every if c[2] == kind)
    out["run_suite"] = suites_sql(c for c in _RAW_CHECKS if c[0] == "customers")
    out["raw_suites"] = suites_sql(_RAW_CHECKS)
    out["mart_suites"] = suites_sql(_MART_CHECKS)
    for kind in ("not_null", "unique", "accepted_values"):
        out[f"schema_test_{kind}"] = "\nUNION ALL\n".join(
            _schema_sql(m, t, c, values) for m, t, cols, values in _SCHEMA_TESTS if t == kind for c in cols)
    # Null census per raw table
    cols = {"raw_customers": ("customers", ["customer_id", "name", "email", "age", "segment", "region",
                                            "acquisition_cost", "signup_date"]),
            "raw_orders": ("orders", ["order_id", "customer_id", "order_date", "order_amount",
                                      "product_category", "status"]),
            "raw_events": ("events", ["event_id", "customer_id", "event_type", "event_timestamp", "channel",
                                      "session_duration_seconds", "pages_viewed", "clicked_ad", "campaign_id"]),
            "raw_churn_labels": ("churn_labels", ["customer_id", "is_churned", "churn_probability",
                                                  "last_activity_date", "days_since_last_order"])}
    parts = []
    for t, (name, cs) in cols.items():
        total = " + ".join(f"(count(*) - count({c}))" for c in cs)
        anyn = " OR ".join(f"{c} IS NULL" for c in cs)
        for c in cs:
            parts.append(f"SELECT '{name}' AS table_name, CAST({total} AS BIGINT) AS table_null_count, "
                         f"CAST(count_if({anyn}) AS BIGINT) AS rows_with_null, '{c}' AS column_name, "
                         f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {t}")
    out["null_census"] = "\nUNION ALL\n".join(parts)
    vc = []
    for t, name, cs in [("raw_customers", "customers", ["segment", "region"]), ("raw_events", "events", ["event_type"]),
                        ("raw_orders", "orders", ["status"])]:
        for c in cs:
            vc.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
                      f"count(*) AS count FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}")
    out["value_counts"] = "\nUNION ALL\n".join(vc)
    out["table_summary"] = f"""
        SELECT 'customers' AS table_name, count(*) AS row_count, CAST(NULL AS TIMESTAMP) AS first_event_at,
               CAST(NULL AS TIMESTAMP) AS last_event_at, CAST(NULL AS DOUBLE) AS order_total,
               CAST(NULL AS DOUBLE) AS order_mean, CAST(NULL AS BIGINT) AS churned, CAST(NULL AS DOUBLE) AS churn_rate
        FROM raw_customers
        UNION ALL
        SELECT 'events', count(*), min(event_timestamp), max(event_timestamp), NULL, NULL, NULL, NULL FROM raw_events
        UNION ALL
        SELECT 'orders', count(*), NULL, NULL, CAST(sum({money('order_amount')}) AS DOUBLE),
               {mean(f"sum({money('order_amount')})", 'count(order_amount)')}, NULL, NULL FROM raw_orders
        UNION ALL
        SELECT 'churn_labels', count(*), NULL, NULL, NULL, NULL, CAST(count_if(is_churned) AS BIGINT),
               count_if(is_churned) / count(is_churned) FROM raw_churn_labels"""
    return out


ORACLE.update(_quality_oracle())


# --- M / S: churn model ------------------------------------------------------------------

_NUM = "total_orders, total_revenue, avg_order_value, customer_lifespan_days, net_ltv, age, acquisition_cost"
_ENC = """
    SELECT feature, value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS BIGINT) AS code
    FROM (SELECT DISTINCT 'segment' AS feature, coalesce(CAST(segment AS VARCHAR), 'None') AS value
          FROM mart_customer_ltv WHERE is_churned IS NOT NULL
          UNION
          SELECT DISTINCT 'region', coalesce(CAST(region AS VARCHAR), 'None')
          FROM mart_customer_ltv WHERE is_churned IS NOT NULL)"""
_SPLIT = """
    SELECT customer_id, is_churned,
           CASE WHEN row_number() OVER (PARTITION BY is_churned ORDER BY md5(customer_id || '-42'), customer_id)
                     <= CASE WHEN n > 1 THEN greatest(1, least(n - 1, floor(n * 0.2 + 0.5))) ELSE 0 END
                THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, count(*) OVER (PARTITION BY is_churned) AS n FROM mart_customer_ltv WHERE is_churned IS NOT NULL)"""
_SCORES = """SELECT CAST(is_churned AS INTEGER) AS label, churn_probability AS score,
                    CAST(churn_probability >= 0.5 AS INTEGER) AS prediction
             FROM mart_customer_ltv WHERE is_churned IS NOT NULL"""

ORACLE.update({
    "feature_columns": f"SELECT {_NUM}, segment, region, is_churned FROM mart_customer_ltv",
    "scan_features": f"""SELECT customer_id, {_NUM}, segment, region, is_churned FROM mart_customer_ltv
                         WHERE is_churned IS NOT NULL""",
    "scan_scoring": f"SELECT customer_id, name, segment, region, {_NUM} FROM mart_customer_ltv",
    "fit_encoder": _ENC,
    "apply_encoder": (f"""
        SELECT l.customer_id, coalesce(s.code, -1) AS segment_code, coalesce(r.code, -1) AS region_code
        FROM mart_customer_ltv l
        LEFT JOIN enc s ON s.feature = 'segment' AND s.value = coalesce(CAST(l.segment AS VARCHAR), 'None')
        LEFT JOIN enc r ON r.feature = 'region' AND r.value = coalesce(CAST(l.region AS VARCHAR), 'None')""",
                      {"enc": _ENC}),
    "stratified_split": _SPLIT,
    "class_weight": f"""
        SELECT count(*) FILTER (WHERE NOT is_churned) AS negatives, count(*) FILTER (WHERE is_churned) AS positives,
               count(*) FILTER (WHERE NOT is_churned) / nullif(count(*) FILTER (WHERE is_churned), 0) AS scale_pos_weight
        FROM ({_SPLIT}) WHERE split = 'train'""",
    "train_churn": f"""
        SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
               round(count(*) FILTER (WHERE is_churned) / count(*), 4) AS churn_rate,
               'total_orders,total_revenue,avg_order_value,customer_lifespan_days,net_ltv,age,acquisition_cost,'
               'segment,region' AS features, true AS auc_in_range
        FROM ({_SPLIT})""",
    "score_customers": """SELECT customer_id, true AS in_range, true AS follows_rule, true AS four_decimals
                          FROM mart_customer_ltv""",
    "target_rate": """SELECT count(*) AS rows, CAST(count_if(is_churned) AS BIGINT) AS positives,
                             count_if(is_churned) / count(*) AS churn_rate
                      FROM mart_customer_ltv WHERE is_churned IS NOT NULL""",
    "roc_auc": (f"""
        SELECT CAST(sum(2 * CAST(pos AS HUGEINT) * below + CAST(pos AS HUGEINT) * neg) AS DOUBLE)
                   / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
        FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                         AS below
              FROM (SELECT CAST(score AS DOUBLE) AS s, count_if(label = 1) AS pos, count_if(label = 0) AS neg
                    FROM scores WHERE score IS NOT NULL GROUP BY score))""", {"scores": _SCORES}),
    "classification_report": (f"""
        SELECT 'active' AS class_name,
               coalesce(CAST(tp0 AS DOUBLE) / nullif(CAST(tp0 + fn1 AS DOUBLE), 0), 0.0) AS precision,
               coalesce(CAST(tp0 AS DOUBLE) / nullif(CAST(tp0 + fp1 AS DOUBLE), 0), 0.0) AS recall,
               coalesce(CAST(2 * tp0 AS DOUBLE) / nullif(CAST(2 * tp0 + fn1 + fp1 AS DOUBLE), 0), 0.0) AS f1_score,
               CAST(tp0 + fp1 AS BIGINT) AS support FROM cm
        UNION ALL
        SELECT 'churned',
               coalesce(CAST(tp1 AS DOUBLE) / nullif(CAST(tp1 + fp1 AS DOUBLE), 0), 0.0),
               coalesce(CAST(tp1 AS DOUBLE) / nullif(CAST(tp1 + fn1 AS DOUBLE), 0), 0.0),
               coalesce(CAST(2 * tp1 AS DOUBLE) / nullif(CAST(2 * tp1 + fp1 + fn1 AS DOUBLE), 0), 0.0),
               CAST(tp1 + fn1 AS BIGINT) FROM cm
        UNION ALL
        SELECT 'accuracy', a, a, a, CAST(tp0 + fp1 + tp1 + fn1 AS BIGINT)
        FROM (SELECT *, coalesce((tp0 + tp1) / nullif(tp0 + fp1 + tp1 + fn1, 0), 0.0) AS a FROM cm)
        UNION ALL
        SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(n0 + n1 AS BIGINT) FROM ratios
        UNION ALL
        SELECT 'weighted avg', coalesce((p0 * n0 + p1 * n1) / nullif(n0 + n1, 0), 0.0),
               coalesce((r0 * n0 + r1 * n1) / nullif(n0 + n1, 0), 0.0),
               coalesce((f0 * n0 + f1 * n1) / nullif(n0 + n1, 0), 0.0), CAST(n0 + n1 AS BIGINT) FROM ratios""", {

        "scores": _SCORES,
        "cm": """SELECT count_if(label = 1 AND prediction = 1) AS tp1, count_if(label = 0 AND prediction = 1) AS fp1,
                        count_if(label = 1 AND prediction = 0) AS fn1, count_if(label = 0 AND prediction = 0) AS tp0
                 FROM scores""",
        "ratios": """SELECT tp0 + fp1 AS n0, tp1 + fn1 AS n1, ifnull(tp0 / nullif(tp0 + fn1, 0), 0.0) AS p0,
                            ifnull(tp1 / nullif(tp1 + fp1, 0), 0.0) AS p1, ifnull(tp0 / nullif(tp0 + fp1, 0), 0.0) AS r0,
                            ifnull(tp1 / nullif(tp1 + fn1, 0), 0.0) AS r1,
                            ifnull(2 * tp0 / nullif(2 * tp0 + fn1 + fp1, 0), 0.0) AS f0,
                            ifnull(2 * tp1 / nullif(2 * tp1 + fp1 + fn1, 0), 0.0) AS f1 FROM cm"""}),
    "scoring_summary": """
        SELECT count(*) AS customers_scored, CAST(count_if(churn_probability >= 0.5) AS BIGINT) AS predicted_churned,
               count_if(churn_probability >= 0.5) / count(*) AS predicted_churned_share,
               CAST(sum(CAST(churn_probability AS DECIMAL(18, 6))) AS DOUBLE) / count(churn_probability)
                   AS avg_churn_probability
        FROM mart_customer_ltv""",
})


# --- T: pipeline metrics (window starts aligned to the epoch, like Spark's window) -------

def _bucket(ts: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp(CAST(floor(epoch_us({ts}) / {us}) * {us} AS BIGINT))"


_COUNTERS = """
    SELECT 'events_' || event_type || '_total' AS metric, ts, event_id AS seq,
           CAST((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)) % 200 AS DOUBLE) AS value
    FROM events"""
_GAUGES = """
    SELECT CASE event_id % 3 WHEN 0 THEN 'airflow_pool_open_slots' WHEN 1 THEN 'airflow_pool_used_slots'
                ELSE 'airflow_pool_starving_tasks' END AS metric,
           CASE WHEN user_id % 2 = 0 THEN 'default_pool' ELSE 'other_pool' END AS pool,
           ts, event_id AS seq, CAST(value AS DOUBLE) AS value
    FROM events"""


def _increase_sql(seconds: int, where: str = "true") -> str:
    b = _bucket("ts", seconds)
    return f"""
        SELECT metric, window_start, window_start + INTERVAL {seconds} SECOND AS window_end,
               sum(CASE WHEN prev IS NULL THEN 0.0 WHEN value >= prev THEN value - prev ELSE value END) AS increase,
               count(*) AS samples
        FROM (SELECT metric, value, {b} AS window_start,
                     lag(value) OVER (PARTITION BY metric, {b} ORDER BY ts, seq) AS prev
              FROM counters WHERE value IS NOT NULL AND {where})
        GROUP BY metric, window_start"""


# Quarter hours from the first sample to an hour behind the last.
_STEPS = """
    SELECT unnest(generate_series(
               make_timestamp(CAST(ceil(epoch_us(min(ts)) / 900000000.0) * 900000000 AS BIGINT)),
               max(ts) + INTERVAL 1 HOUR, INTERVAL 15 MINUTE)) AS evaluated_at FROM counters"""


def _lookback_sql(times: str, seconds: int) -> str:
    """Every sample of every range, stepped through afresh for each time."""
    return f"""
        SELECT metric, evaluated_at, sum(grown) AS increase, sum(grown) / {float(seconds)} AS rate, count(*) AS samples
        FROM (SELECT metric, evaluated_at, CASE WHEN prev IS NULL THEN 0.0 WHEN value < prev THEN value ELSE value - prev END AS grown
              FROM (SELECT metric, evaluated_at, value, lag(value) OVER (PARTITION BY metric, evaluated_at ORDER BY ts, seq) AS prev
                    FROM ({times}) JOIN counters ON ts <= evaluated_at AND ts > evaluated_at - INTERVAL {seconds} SECOND
                    WHERE value IS NOT NULL))
        GROUP BY metric, evaluated_at"""


# Dotted name prefixes of the sample events, and the exporter's name rules as
# (pattern, metric or its prefix, label key).
_PREFIXES = [
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
_NAME_RULES = (
    (r"airflow\.dagrun\.duration\.success\.([^.]*)", "airflow_dagrun_duration_success_seconds", "dag_id"),
    (r"airflow\.dagrun\.duration\.failed\.([^.]*)", "airflow_dagrun_duration_failed_seconds", "dag_id"),
    (r"airflow\.dagrun\.schedule_delay\.([^.]*)", "airflow_dagrun_schedule_delay_seconds", "dag_id"),
    (r"airflow\.operator_successes_([^.]*)", "airflow_operator_successes_total", "operator"),
    (r"airflow\.operator_failures_([^.]*)", "airflow_operator_failures_total", "operator"),
    (r"airflow\.pool\.open_slots\.([^.]*)", "airflow_pool_open_slots", "pool"),
    (r"airflow\.pool\.used_slots\.([^.]*)", "airflow_pool_used_slots", "pool"),
    (r"airflow\.pool\.starving_tasks\.([^.]*)", "airflow_pool_starving_tasks", "pool"),
    (r"airflow\.dag_processing\.last_runtime\.([^.]*)", "airflow_dag_processing_last_runtime_seconds", "dag_file"),
    (r"airflow\.([^.]*)", "airflow_", None),
)
# Colour steps of the panels, from the highest bound down.
_HEARTBEAT = "CASE WHEN {v} >= 0.001 THEN 'green' WHEN {v} IS NOT NULL THEN 'red' END"
_FAILURES = "CASE WHEN {v} >= 3 THEN 'red' WHEN {v} >= 1 THEN 'yellow' WHEN {v} IS NOT NULL THEN 'green' END"


#: Task i waits for task i - 1: reachability by a recursive walk, then the unfinished ones of the run.
_LATE = """
    WITH RECURSIVE name AS (SELECT * FROM (VALUES
            (1, 'generate_synthetic_data'), (2, 'validate_data_files'), (3, 'summarize_data'), (4, 'dq_validate_raw'),
            (5, 'load_to_bigquery'), (6, 'dbt_run'), (7, 'dbt_test'), (8, 'dq_validate_marts'), (9, 'ml_churn_score')) v(i, task)),
    edge AS (SELECT a.task AS upstream, b.task FROM name a JOIN name b ON b.i = a.i + 1),
    waits AS (SELECT upstream, task FROM edge UNION
              SELECT w.upstream, e.task FROM waits w JOIN edge e ON e.upstream = w.task),
    state AS (
        SELECT 'orders_' || o_orderpriority AS dag_id, o_orderdate AS scheduled_at, name.task,
               min(l_shipdate) FILTER (WHERE l_shipdate <= TIMESTAMP '2000-06-15') AS finished_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN name ON i = l_linenumber
        WHERE o_orderdate <= TIMESTAMP '2000-06-15' AND o_orderpriority IS NOT NULL GROUP BY ALL),
    late AS (
        SELECT s.*, COALESCE((
            SELECT list(b.task ORDER BY b.task) FROM state b
            WHERE b.dag_id = s.dag_id AND b.scheduled_at = s.scheduled_at AND b.finished_at IS NULL
              AND (b.task = s.task OR EXISTS (SELECT 1 FROM waits w WHERE w.upstream = b.task AND w.task = s.task))),
            []) AS blocking
        FROM state s
        WHERE scheduled_at + INTERVAL 30 DAY < TIMESTAMP '2000-06-15'
          AND (finished_at IS NULL OR finished_at > scheduled_at + INTERVAL 30 DAY))
"""


def _metrics_oracle() -> dict:
    ctes = {"counters": _COUNTERS, "gauges": _GAUGES}
    prefix = "CASE event_id % 10 " + " ".join(
        f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PREFIXES[:-1])) + f" ELSE '{_PREFIXES[-1]}' END"
    metric_case, key_case, val_case = [], [], []
    for rx, target, key in _NAME_RULES:
        cond, part = f"regexp_full_match(name, '{rx}')", f"regexp_extract(name, '{rx}', 1)"
        metric_case.append(f"WHEN {cond} THEN " + (f"'{target}'" if key else f"'{target}' || {part}"))
        key_case.append(f"WHEN {cond} THEN " + (f"'{key}'" if key else "NULL"))
        val_case.append(f"WHEN {cond} THEN " + (part if key else "NULL"))
    fallback = "regexp_replace(name, '[^a-zA-Z0-9_:]', '_', 'g')"
    inc24 = _increase_sql(86400)
    rate2 = _increase_sql(120)
    return {
        "map_metric_names": (f"""
            SELECT event_id, name, CASE {' '.join(metric_case)} ELSE {fallback} END AS metric,
                   CASE {' '.join(key_case)} ELSE NULL END AS label_name,
                   CASE {' '.join(val_case)} ELSE NULL END AS label_value
            FROM names""", {"names": f"SELECT event_id, {prefix} || event_type AS name FROM events"}),
        "counter_increase": (inc24, ctes),
        "counter_rate": (f"SELECT *, increase / 300.0 AS rate FROM ({_increase_sql(300)})", ctes),
        "sum_over_series": (f"""SELECT metric, window_start, window_end, sum(increase) AS total_increase
                                FROM ({inc24}) GROUP BY ALL""", ctes),
        "counter_increase_at": (_lookback_sql("SELECT TIMESTAMP '2024-01-20 06:30:00' AS evaluated_at", 86400), ctes),
        "counter_rate_every": (_lookback_sql(_STEPS, 3600), ctes),
        "last_value": (f"""
            SELECT metric, NULL::VARCHAR AS pool, arg_max(ts, {{'t': ts, 's': seq}}) AS ts,
                   arg_max(value, {{'t': ts, 's': seq}}) AS value
            FROM counters WHERE value IS NOT NULL GROUP BY metric
            UNION ALL
            SELECT metric, pool, arg_max(ts, {{'t': ts, 's': seq}}), arg_max(value, {{'t': ts, 's': seq}})
            FROM gauges WHERE value IS NOT NULL GROUP BY metric, pool""", ctes),
        "threshold_band": (f"""
            SELECT metric, window_start, increase / 100.0 AS value, {_FAILURES.format(v='increase / 100.0')} AS band,
                   'increase_24h' AS panel FROM ({inc24})
            UNION ALL
            SELECT metric, window_start, increase / 120.0, {_HEARTBEAT.format(v='increase / 120.0')}, 'rate_2m'
            FROM ({rate2})""", ctes),
        "gauge_range": ("""
            SELECT metric, pool, ts, seq, value FROM gauges
            WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-31 00:00:00'""",
                        ctes),
        "label_filter": ("""
            SELECT ts,
                   arg_max(value, seq) FILTER (WHERE metric = 'airflow_pool_open_slots') AS airflow_pool_open_slots,
                   arg_max(value, seq) FILTER (WHERE metric = 'airflow_pool_used_slots') AS airflow_pool_used_slots,
                   arg_max(value, seq) FILTER (WHERE metric = 'airflow_pool_starving_tasks')
                       AS airflow_pool_starving_tasks
            FROM gauges WHERE pool = 'default_pool' GROUP BY ts""", ctes),
        "success_vs_failure": (f"""
            SELECT *, increase / 300.0 AS rate, 'success' AS kind
            FROM ({_increase_sql(300, "metric = 'events_purchase_total'")})
            UNION ALL
            SELECT *, increase / 300.0 AS rate, 'failure' AS kind
            FROM ({_increase_sql(300, "metric = 'events_error_total'")})""", ctes),
        "sla_miss": """
            SELECT event_id AS run_id, event_type AS task, date_trunc('day', ts) AS scheduled_at, ts AS finished_at,
                   (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000000.0 AS duration_seconds
            FROM events WHERE ts > date_trunc('day', ts) + INTERVAL 2 HOUR""",
        "sla_miss_blocking": "SELECT * FROM (" + _LATE + """
            SELECT dag_id, scheduled_at, task, finished_at,
                   (epoch_us(finished_at) - epoch_us(scheduled_at)) / 1000000.0 AS duration_seconds,
                   array_to_string(blocking, ', ') AS blocking_tasks FROM late)""",
        "sla_miss_report": "SELECT * FROM (" + _LATE + """
            SELECT dag_id, scheduled_at, array_to_string(list_sort(list_distinct(list(task))), ', ') AS missed_tasks,
                   array_to_string(list_sort(list_distinct(flatten(list(blocking)))), ', ') AS blocking_tasks
            FROM late GROUP BY dag_id, scheduled_at)""",
    }


ORACLE.update(_metrics_oracle())


ORACLE.update({
    "scan_count": """
        SELECT 'mart_customer_ltv' AS table_name, count(*) AS row_count FROM mart_customer_ltv
        UNION ALL SELECT 'mart_campaign_performance', count(*) FROM mart_campaign_performance
        UNION ALL SELECT 'mart_churn_summary', count(*) FROM mart_churn_summary""",
    "scan_sample": "SELECT least(count(*), 100000) AS row_count FROM mart_customer_ltv",
    "limit": "SELECT least(count(*), 100000) AS row_count FROM mart_campaign_performance",
    "file_inventory": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, CAST(count(*) AS INTEGER) AS column_count "
        f"FROM (DESCRIBE {t})" for t in ("customer", "nation", "region", "orders", "events")),
    "quality_gate": f"SELECT * FROM ({suites_sql(_RAW_CHECKS)}) WHERE NOT success",
    "null_gate": "\nUNION ALL\n".join(
        f"SELECT * FROM (SELECT '{name}' AS table_name, CAST({' + '.join(f'(count(*) - count({c}))' for c in cols)} AS BIGINT)"
        f" AS table_null_count, count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in cols)}) AS rows_with_null "
        f"FROM raw_{name}) WHERE table_null_count > 0" for name, cols in (
            ("customers", ("customer_id", "name", "email", "age", "segment", "region", "acquisition_cost", "signup_date")),
            ("orders", ("order_id", "customer_id", "order_date", "order_amount", "product_category", "status")),
            ("events", ("event_id", "customer_id", "event_type", "event_timestamp", "channel", "session_duration_seconds",
                        "pages_viewed", "clicked_ad")),
            ("churn_labels", ("customer_id", "is_churned", "churn_probability", "last_activity_date",
                              "days_since_last_order")))),
    "read_raw": "SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id) FROM raw_events",
    "load_raw": "SELECT * FROM raw_orders",
    "write_mart": "SELECT * FROM mart_campaign_performance",
    "write_predictions": "SELECT customer_id, churn_probability, churn_probability >= 0.5 AS churn_prediction FROM mart_customer_ltv",
    "training_runs": f"""
        SELECT run_id, CASE run_id WHEN 'first' THEN 0 ELSE count(*) FILTER (WHERE split = 'train') END AS train_rows,
               count(*) FILTER (WHERE split = 'test') AS test_rows,
               round(count(*) FILTER (WHERE is_churned) / count(*), 4) AS churn_rate,
               'total_orders,total_revenue,avg_order_value,customer_lifespan_days,net_ltv,age,acquisition_cost,'
               'segment,region' AS features
        FROM ({_SPLIT}), (VALUES ('first'), ('second')) v(run_id) GROUP BY run_id""",
    "staging_views": "\nUNION ALL\n".join(
        f"SELECT '{v}' AS view_name, count(*) AS row_count FROM {v}"
        for v in ("stg_customers", "stg_orders", "stg_events", "stg_churn_labels")),
    "scalar_functions": f"""
        SELECT CAST(order_id AS VARCHAR) AS f01_string, order_id AS f02_long, order_amount AS f03_double,
               order_id % 2 = 0 AS f04_bool, lower(status) AS f05_clean, CAST(order_date AS DATE) AS f06_date,
               CAST(order_date AS TIMESTAMP) AS f07_timestamp,
               CAST(DATE '2024-01-31' - CAST(order_date AS DATE) AS BIGINT) AS f08_date_diff,
               CASE WHEN order_amount > 100000 THEN order_amount ELSE 0.0 END AS f09_coalesce,
               CASE WHEN order_id % 3 <> 0 THEN order_amount / (order_id % 3) END AS f10_safe_divide,
               order_amount / 7.0 AS f11_divide, {rhu('order_amount / 7', 2)} AS f12_round,
               round_even(order_id % 100 / 8.0, 1) AS f13_half_even,
               CASE WHEN order_amount > 100000 THEN 'high' ELSE 'low' END AS f14_case,
               CASE WHEN order_id % 3 > 0 THEN order_amount > 100000 END AS f15_three_valued,
               order_amount * 2 - 1 AS f17_arithmetic,
               CASE WHEN order_id % 2 = 0 THEN status ELSE 'None' END AS f18_category,
               status = 'completed' OR status = 'pending' AS f19_member,
               CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(CAST(order_date AS TIMESTAMP)))
                          / 86400000000.0) AS BIGINT) AS f20_elapsed_days,
               CAST(order_date AS TIMESTAMP) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 9000 DAY AS f21_lookback
        FROM raw_orders""",
})
