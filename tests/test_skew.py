"""One key holding a third of all rows: results must equal a brute-force
computation (the hot key is split over time buckets / slices, never dropped)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import attribution, metrics

BASE = dt.datetime(2024, 1, 1)


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    clicks, orders = [], []
    for i in range(n):
        cust = 1 if i % 3 == 0 else rnd.randint(2, 60)   # customer 1: a third of all rows
        t = BASE + dt.timedelta(seconds=rnd.randint(0, 20 * 86400))
        if rnd.random() < 0.6:
            clicks.append((f"e{i:06d}", cust, t, f"camp_{rnd.randint(1, 9)}"))
        else:
            orders.append((f"o{i:06d}", cust, t))
    return clicks, orders


def test_asof_hot_customer_matches_brute_force(spark):
    clicks, orders = _rows()
    cdf = spark.createDataFrame(clicks, "event_id string, customer_id long, event_at timestamp_ntz, campaign_id string")
    odf = spark.createDataFrame(orders, "order_id string, customer_id long, ordered_at timestamp_ntz")
    want = {}
    for oid, cust, t in orders:
        best = None
        for eid, c, ct, camp in clicks:
            if c == cust and ct <= t and (best is None or (ct, eid) > best[0]):
                best = ((ct, eid), camp)
        want[oid] = best[1] if best else None
    for rows in (300, 10 ** 9):   # cut into segments / everyone whole
        got = {r.order_id: r.campaign_id for r in attribution.attribute_orders_asof(odf, cdf, rows).collect()}
        assert got == want
    assert sum(1 for o in orders if o[1] == 1) > len(orders) / 4


def test_counter_increase_hot_series_matches_brute_force(spark):
    rnd = random.Random(3)
    rows, v = [], {}
    for i in range(4000):
        m = "hot" if i % 3 else f"s{i % 7}"
        v[m] = (v.get(m, 0) + rnd.randint(0, 3)) % 50          # wraps: resets
        rows.append((m, {}, BASE + dt.timedelta(seconds=i * 37), i, float(v[m])))
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, seq long, value double")
    want = {}
    prev = {}
    for m, _, t, _, val in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        day = dt.datetime(t.year, t.month, t.day)
        p = prev.get((m, day))
        step = 0.0 if p is None else (val - p if val >= p else val)
        want[(m, day)] = want.get((m, day), 0.0) + step
        prev[(m, day)] = val
    for size in (250, 10 ** 9):
        got = {(r.metric, r.window_start): r.increase for r in metrics.counter_increase(df, "1 day", size).collect()}
        assert got == want


def test_last_click_attribution_hot_customer_salted(spark):
    from helpers import raw, event, order
    from tidemark.operators import staging
    rnd = random.Random(11)
    evs, ords = [], []
    for i in range(600):
        cust = 1 if i % 3 == 0 else rnd.randint(2, 30)
        t = f"2024-01-{1 + rnd.randint(0, 27):02d} {rnd.randint(0, 23):02d}:00:00"
        if i % 2:
            evs.append(event(f"e{i:05d}", cust, "click", t, campaign=f"camp_{rnd.randint(1, 5)}"))
        else:
            ords.append(order(i, cust, t, float(rnd.randint(1, 99))))
    e = staging.stg_events(raw(spark, "events", evs))
    o = staging.stg_orders(raw(spark, "orders", ords))
    last = {}
    for eid, cust, _, ts, _, _, _, _, camp in evs:
        k = (ts, eid)
        if str(cust) not in last or k > last[str(cust)][0]:
            last[str(cust)] = (k, camp)
    want = {str(oid): last.get(str(cust), (None, None))[1] for oid, cust, *_ in ords}
    for hot_rows in (20, 10 ** 9):
        got = {r.order_id: r.campaign_id for r in attribution.attribute_orders(o, e, hot_rows=hot_rows).collect()}
        assert got == want


def test_hot_paths_match_the_oracle_on_driver_data(spark):
    import duckdb
    import __spark_entry__ as E
    from tidemark.plans import queries as Qm
    from tools.check_oracle import rows_of
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ["customer", "nation", "region", "orders", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    cases = {
        "attribute_orders_asof": attribution.attribute_orders_asof(*Qm.asof_inputs(spark, d), segment_rows=500),
        "attribute_orders": attribution.attribute_orders(Qm.staged(spark, d)["stg_orders"],
                                                         Qm.staged(spark, d)["stg_events"], hot_rows=2),
    }
    for name, df in cases.items():
        want = con.sql(E.oracle_sql()[name]).to_arrow_table().to_pandas(date_as_object=True)
        assert rows_of(df.toPandas(), 0.0) == rows_of(want, 0.0), name


def _spread(rows_df):
    """Sizes of the segments, ascending."""
    return sorted(r["count"] for r in rows_df.groupBy("_seg").count().collect())


def test_a_burst_of_one_series_spreads_over_tasks(spark):
    """Two thirds of all samples belong to one series and fall into one second."""
    from tidemark.functions.windows import Segments
    rnd = random.Random(5)
    rows, v = [], {}
    for i in range(6000):
        m = "hot" if i % 3 else f"s{i % 7}"
        v[m] = (v.get(m, 0) + rnd.randint(0, 3)) % 40
        at = BASE + dt.timedelta(microseconds=i * 100) if m == "hot" else BASE + dt.timedelta(seconds=i * 11)
        rows.append((m, {}, at, i, float(v[m]) if rnd.random() > 0.05 else None))
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, seq long, value double")
    want, prev = {}, {}
    for m, _, t, _, val in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        if val is None:
            continue
        k = (m, t.replace(minute=t.minute - t.minute % 5, second=0, microsecond=0))
        p = prev.get(k)
        want[k] = want.get(k, 0.0) + (0.0 if p is None else val - p if val >= p else val)
        prev[k] = val
    for size in (400, 10 ** 9):
        got = {(r.metric, r.window_start): r.increase for r in metrics.counter_rate(df, 300, size).collect()}
        assert got == want
    cut = Segments(df.select("metric", "ts", "seq"), ["metric"], ["ts", "seq"], 400)
    sizes = _spread(cut.rows)
    assert not cut.one and len(sizes) >= 12 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert len({r._seg for r in cut.rows.where("metric = 'hot'").select("_seg").distinct().collect()}) >= 8


def test_lookback_over_segments_before_1970_and_after_2038(spark):
    from test_metrics import _lookback_brute
    rnd = random.Random(13)
    for year in (1969, 2024, 2039):
        start = dt.datetime(year, 12, 31, 22)
        rows = [("c", {"op": rnd.choice("aab")}, start + dt.timedelta(seconds=rnd.randrange(9000)), i,
                 float(rnd.randrange(30)) if rnd.random() > 0.1 else None) for i in range(400)]
        df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, seq long, value double")
        times = [start + dt.timedelta(seconds=300 * k) for k in range(-2, 40)]
        for size in (60, 10 ** 9):
            got = {(r.labels["op"], r.evaluated_at): (r.increase, r.samples)
                   for r in metrics.counter_lookback(df, 900, 300, segment_rows=size).collect()}
            assert got == _lookback_brute(rows, 900, times)
            at = start + dt.timedelta(seconds=4000)
            got = {(r.labels["op"], r.evaluated_at): (r.increase, r.samples)
                   for r in metrics.counter_lookback(df, 3600, as_of=str(at), segment_rows=size).collect()}
            assert got == _lookback_brute(rows, 3600, [at])


def test_asof_scan_of_a_customer_with_most_rows_in_a_minute(spark):
    """80 % of all rows on one customer, within a minute and with many equal times; compared with an as-of join."""
    import duckdb
    from tidemark.functions.windows import Segments
    rnd = random.Random(2)
    clicks, orders = [], []
    for i in range(8000):
        cust = 1 if i % 5 else rnd.randint(2, 400)
        t = BASE + (dt.timedelta(milliseconds=rnd.randrange(60_000)) if cust == 1 else dt.timedelta(minutes=rnd.randrange(900)))
        if i % 4 == 0:
            clicks.append((f"e{i:06d}", cust, t, f"camp_{i}"))
        else:
            orders.append((f"o{i:06d}", cust, t))
    orders += [("none", None, BASE), ("when", 1, None)]
    clicks += [("x", None, BASE, "camp_none")]
    cdf = spark.createDataFrame(clicks, "event_id string, customer_id long, event_at timestamp_ntz, campaign_id string")
    odf = spark.createDataFrame(orders, "order_id string, customer_id long, ordered_at timestamp_ntz")
    con = duckdb.connect()
    con.register("c", cdf.toPandas())
    con.register("o", odf.toPandas())
    want = con.sql("SELECT order_id, campaign_id, event_at FROM o ASOF LEFT JOIN (SELECT customer_id, event_at, "
                   "arg_max(campaign_id, event_id) AS campaign_id FROM c GROUP BY ALL) c "
                   "ON o.customer_id = c.customer_id AND o.ordered_at >= c.event_at").fetchall()
    for size in (500, 10 ** 9):
        got = attribution.attribute_orders_asof(odf, cdf, size).select("order_id", "campaign_id", "clicked_at").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    both = odf.select("customer_id", F.col("ordered_at").alias("t"), "order_id").union(cdf.select("customer_id", "event_at", "event_id"))
    sizes = _spread(Segments(both, ["customer_id"], ["t", "order_id"], 500).rows)
    assert len(sizes) >= 14 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
