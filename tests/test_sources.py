"""CSV sources, namespaces, inventory and the daily / training pipelines on
CSV files in the reference's shape written to a fresh temp folder."""

import csv
import datetime as dt
import os

import pytest

from tidemark.plans import daily
from tidemark.sources import raw as raw_io

SEGMENTS = ["enterprise", "smb", "consumer", "startup"]
TYPES = ["page_view", "click", "add_to_cart", "purchase", "wishlist", "review"]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _make_csvs(d, n_customers=120, n_events=1500):
    base = dt.datetime(2024, 1, 1)
    _write(os.path.join(d, "customers.csv"),
           ["customer_id", "name", "email", "age", "segment", "region", "acquisition_cost", "signup_date"],
           [[i, f" Name {i} ", f"customer_{i}@example.com", 18 + i % 50, SEGMENTS[i % 4],
             ["US", "EU", "APAC", "LATAM"][i % 4], round(10 + (i * 37) % 490 + 0.25, 2),
             (base - dt.timedelta(days=i % 700)).date().isoformat()] for i in range(1, n_customers + 1)])
    events, orders = [], []
    for i in range(n_events):
        t = TYPES[(i * 7) % 6]
        clicked = t in ("click", "purchase")
        ts = base + dt.timedelta(days=i % 90, hours=i % 24, minutes=(i * 13) % 60)
        cid = 1 + (i * 31) % n_customers
        events.append([f"evt_{i:08d}", cid, t, ts.isoformat(sep=" "), "email", 5 + i % 1700, 1 + i % 19,
                       str(clicked), f"camp_{1 + i % 50:04d}" if clicked else ""])
        if t == "purchase":
            orders.append([len(orders) + 1, cid, ts.isoformat(sep=" "), round(20 + (i * 11) % 300 + 0.5, 2),
                           "home", ["completed", "completed", "pending", "refunded"][i % 4]])
    _write(os.path.join(d, "events.csv"), ["event_id", "customer_id", "event_type", "event_timestamp", "channel",
                                           "session_duration_seconds", "pages_viewed", "clicked_ad", "campaign_id"],
           events)
    _write(os.path.join(d, "orders.csv"), ["order_id", "customer_id", "order_date", "order_amount",
                                           "product_category", "status"], orders)
    _write(os.path.join(d, "churn_labels.csv"), ["customer_id", "is_churned", "churn_probability",
                                                 "last_activity_date", "days_since_last_order"],
           [[i, str(i % 3 == 0), round((i * 7919 % 10001) / 10000, 4), "2024-03-01", i % 60]
            for i in range(1, n_customers + 1)])


def test_read_raw_reference_shape(spark, tmpdir_path):
    _make_csvs(tmpdir_path, 5, 20)
    ev = raw_io.read_raw(spark, tmpdir_path, "events").collect()
    assert len(ev) == 20 and isinstance(ev[1].clicked_ad, bool)
    assert ev[1].campaign_id == "camp_0002" and ev[0].campaign_id is None
    assert ev[0].event_timestamp == dt.datetime(2024, 1, 1, 0, 0)


def test_require_sources_names_every_missing_file(spark, tmpdir_path):
    _make_csvs(tmpdir_path, 5, 20)
    os.remove(os.path.join(tmpdir_path, "orders.csv"))
    os.remove(os.path.join(tmpdir_path, "events.csv"))
    with pytest.raises(FileNotFoundError) as e:
        raw_io.require_sources(spark, tmpdir_path)
    assert "events.csv" in str(e.value) and "orders.csv" in str(e.value)


def test_bad_csv_fails_fast(spark, tmpdir_path):
    _make_csvs(tmpdir_path, 5, 20)
    with open(os.path.join(tmpdir_path, "customers.csv"), "a") as f:
        f.write("x,not a row,,abc,,,zz,2024-01-01\n")
    with pytest.raises(Exception):
        raw_io.read_raw(spark, tmpdir_path, "customers").collect()


def test_layer_namespace():
    assert raw_io.layer_namespace(" marts ") == "marts"
    assert raw_io.layer_namespace(None, "analytics") == "analytics"


def test_file_inventory(spark, tmpdir_path):
    _make_csvs(tmpdir_path, 5, 20)
    inv = raw_io.file_inventory(spark, {"events": os.path.join(tmpdir_path, "events.csv")}).collect()
    assert inv[0].row_count == 20 and inv[0].column_count == 9 and inv[0].file_size > 0


def test_daily_and_training_pipelines(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    _make_csvs(raw_dir)
    wh = os.path.join(tmpdir_path, "warehouse")
    res = daily.run_daily(spark, raw_dir, wh)
    assert res.raw_report.count() == 24 and res.mart_report.count() == 21 and res.schema_report.count() == 30
    assert res.marts["mart_customer_ltv"].count() == 120
    assert res.predictions is None
    # published in the catalog by layer (S7) and queryable by SQL
    assert spark.sql("SELECT count(*) AS n FROM marts.mart_customer_ltv").first().n == 120
    assert spark.sql("SELECT count(*) AS n FROM raw.events").first().n == 1500
    assert spark.sql("SELECT count(*) AS n FROM stg_orders").first().n > 0   # staging view (S5)
    model_path = os.path.join(tmpdir_path, "model")
    rec = daily.run_training(spark, wh, model_path, "2024-W01", n_trees=5)
    assert rec["train_rows"] + rec["test_rows"] == 120
    res2 = daily.run_daily(spark, raw_dir, wh, model_path=model_path)
    p = res2.predictions.collect()
    assert len(p) == 120 and p[0].model_trained_at is not None
    assert res2.scoring.first().customers_scored == 120 and res2.inventory.count() == 4
    printed = res2.profile()
    assert all(x in printed for x in ("files", "value counts", "scoring", "customers_scored"))


def test_daily_strict_null_gate_stops_on_unclicked_events(spark, tmpdir_path):
    _make_csvs(tmpdir_path, 120, 1500)
    from tidemark.operators.quality import NullGateError
    wh = os.path.join(tmpdir_path, "wh")
    with pytest.raises(NullGateError):
        daily.run_daily(spark, tmpdir_path, wh, strict_nulls=True)
    assert not os.path.exists(os.path.join(wh, "raw"))   # nothing published past a failed gate


def _customers_csv(path, lines):
    with open(os.path.join(path, "customers.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_columns_come_by_header_name_and_quotes_are_standard(spark, tmpdir_path):
    _customers_csv(tmpdir_path, [
        "customer_id,email,name,age,region,segment,acquisition_cost,signup_date,note",
        '7,a@x.org,"An ""Al"" Bo, Jr",30,US,smb,12.5,2024-01-02,extra'])
    r = raw_io.read_raw(spark, tmpdir_path, "customers").collect()[0]
    assert (r.customer_id, r.email, r.name, r.region, r.segment, r.acquisition_cost) == (
        7, "a@x.org", 'An "Al" Bo, Jr', "US", "smb", 12.5)
    assert "note" not in r.asDict()
    _customers_csv(tmpdir_path, ["customer_id,email,age,region,segment,acquisition_cost,signup_date", "1,a,1,b,c,1,2024-01-01"])
    with pytest.raises(ValueError, match="name"):
        raw_io.read_raw(spark, tmpdir_path, "customers")


def test_file_without_rows_stays_in_the_inventory(spark, tmpdir_path):
    _customers_csv(tmpdir_path, ["customer_id,email"])
    r = raw_io.file_inventory(spark, {"customers": os.path.join(tmpdir_path, "customers.csv")}).collect()
    assert [(x.table_name, x.file_count, x.row_count, x.column_count) for x in r] == [("customers", 1, 0, 2)]
    assert r[0].file_size > 0


def test_publishing_points_at_the_landed_version(spark, tmpdir_path):
    raw_dir, wh = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "warehouse")
    os.makedirs(raw_dir)
    _make_csvs(raw_dir, 5, 20)
    first = raw_io.land_raw(spark, raw_dir, wh)
    raw_io.publish_raw(spark, first, wh)
    _make_csvs(raw_dir, 8, 30)
    second = raw_io.land_raw(spark, raw_dir, wh)
    assert spark.table("raw.customers").count() == 5        # a landed version is not yet published
    raw_io.publish_raw(spark, second, wh)
    assert spark.table("raw.customers").count() == 8 and spark.read.parquet(first["customers"]).count() == 5


def test_managed_tables_are_not_replaced(spark, tmpdir_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    spark.range(3).write.mode("overwrite").saveAsTable("kept.numbers")
    with pytest.raises(ValueError, match="managed"):
        raw_io.write_table(spark.range(1).toDF("id"), tmpdir_path, "kept", "numbers")
    assert spark.table("kept.numbers").count() == 3


def test_a_rebuild_leaves_the_last_version_alone(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        raw_io.read_table(spark, tmpdir_path, "marts", "t")
    raw_io.write_table(spark.range(3), tmpdir_path, "marts", "t", register=False)
    before = raw_io.read_table(spark, tmpdir_path, "marts", "t")
    # A rebuild from the table itself, and one that fails.
    raw_io.write_table(before.where("id > 0"), tmpdir_path, "marts", "t", register=False)
    with pytest.raises(Exception):
        raw_io.write_table(before.selectExpr("raise_error('no') as id"), tmpdir_path, "marts", "t", register=False)
    assert before.count() == 3 and raw_io.read_table(spark, tmpdir_path, "marts", "t").count() == 2


def test_quoted_line_breaks_on_request(spark, tmpdir_path):
    _customers_csv(tmpdir_path, ["customer_id,email,name,age,region,segment,acquisition_cost,signup_date",
                                 '1,a@x.org,"Ann', 'Bo",30,US,smb,1.5,2024-01-02', "2,b@x.org,Cy,31,EU,smb,2.5,2024-01-03"])
    r = {x.customer_id: x.name for x in raw_io.read_raw(spark, tmpdir_path, "customers", multi_line=True).collect()}
    assert r == {1: "Ann\nBo", 2: "Cy"}
    with pytest.raises(Exception):
        raw_io.read_raw(spark, tmpdir_path, "customers").collect()
