"""Publishing: one rename per release, readers of one moment, catalog that follows, keyed training records."""

import os
import threading

import pytest
from test_ml import _labelled
from tidemark.operators import ml, staging
from tidemark.plans import daily
from tidemark.sources import raw as raw_io
from tidemark.sources import store
from test_sources import _make_csvs


def test_commits_count_up_and_build_on_one_another(spark, tmpdir_path):
    assert store.state(spark, tmpdir_path) == {}
    store.commit(spark, tmpdir_path, lambda d: d | {"a": 1})
    store.commit(spark, tmpdir_path, lambda d: d | {"b": d["a"] + 1})
    assert store.state(spark, tmpdir_path) == {"a": 1, "b": 2}
    assert sorted(n for n in os.listdir(os.path.join(tmpdir_path, "_manifest")) if n.endswith(".json") and n[0] != ".") == [
        "000000000001.json", "000000000002.json"]


def test_a_publisher_that_comes_second_applies_its_change_to_the_newer_state(spark, tmpdir_path):
    calls = []

    def change(d):
        calls.append(dict(d))
        if len(calls) == 1:       # another publisher is first
            store.commit(spark, tmpdir_path, lambda x: x | {"other": True})
        return d | {"mine": True}

    store.commit(spark, tmpdir_path, change)
    assert store.state(spark, tmpdir_path) == {"mine": True, "other": True} and len(calls) == 2


def test_readers_see_whole_releases_only(spark, tmpdir_path):
    """A reader polls while two tables are rebuilt together: never one missing, never versions of two releases."""
    def release(n):
        r = store.Release(spark, tmpdir_path, "polled")
        for t in ("a", "b"):
            r.write(spark.range(1).selectExpr(f"{n} AS version"), t)
        r.publish()

    release(0)
    seen, wrong, stop = set(), [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                now = {t: df.first().version for t, df in store.read_layer(spark, tmpdir_path, "polled").items()}
                if len(now) != 2 or len(set(now.values())) != 1:
                    wrong.append(now)
                seen.update(now.values())
                if not spark.catalog.tableExists("polled.a") or spark.table("polled.b").count() != 1:
                    wrong.append("catalog")
            except Exception as e:  # noqa: BLE001
                wrong.append(repr(e)[:300])

    reader = threading.Thread(target=poll)
    reader.start()
    for n in range(1, 6):
        release(n)
    stop.set()
    reader.join()
    assert not wrong and len(seen) > 1
    assert spark.table("polled.a").first().version == spark.table("polled.b").first().version == 5


def test_the_catalog_follows_in_place(spark, tmpdir_path):
    raw_io.write_table(spark.range(2), tmpdir_path, "followed", "t")
    raw_io.write_table(spark.range(5).selectExpr("id", "id * 2 AS twice"), tmpdir_path, "followed", "t")
    assert spark.table("followed.t").columns == ["id", "twice"] and spark.table("followed.t").count() == 5
    with pytest.raises(ValueError, match="changed type"):
        raw_io.write_table(spark.range(1).selectExpr("CAST(id AS STRING) AS id"), tmpdir_path, "followed", "t")
    # Refused before anything was published.
    assert raw_io.read_table(spark, tmpdir_path, "followed", "t").count() == 5


def test_a_failed_release_publishes_nothing(spark, tmpdir_path):
    first = store.Release(spark, tmpdir_path, "whole")
    first.write(spark.range(1), "a")
    first.write(spark.range(1), "b")
    first.publish(register=False)
    second = store.Release(spark, tmpdir_path, "whole")
    second.write(spark.range(7), "a")
    with pytest.raises(Exception):
        second.write(spark.range(1).selectExpr("raise_error('no') AS id"), "b")
    assert {t: df.count() for t, df in store.read_layer(spark, tmpdir_path, "whole").items()} == {"a": 1, "b": 1}


def test_staging_views_outlive_the_session_and_follow_loads(spark, tmpdir_path):
    raw_dir, wh = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "warehouse")
    os.makedirs(raw_dir)
    _make_csvs(raw_dir)
    daily.run_daily(spark, raw_dir, wh)
    other = spark.newSession()
    assert not other.catalog.tableExists("stg_orders")                      # the session's own view
    want = staging.stage_all(raw_io.read_all_raw(spark, raw_dir))
    for name, df in want.items():
        got = other.table(f"staging.{name}")
        assert got.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    _make_csvs(raw_dir, 130, 1600)
    daily.run_daily(spark, raw_dir, wh)
    assert spark.newSession().table("staging.stg_events").count() == 1600
    other.catalog.refreshTable("raw.events")        # a session keeps the listing of a table it has read
    assert other.table("staging.stg_events").count() == 1600


def test_a_repeated_training_leaves_one_record_and_the_old_model_until_it_is_whole(spark, tmpdir_path, monkeypatch):
    data = _labelled(spark)
    model, record = ml.train_churn(spark, data, n_trees=2)
    ml.publish_training(spark, model, record, tmpdir_path, "week 1")
    first = store.state(spark, tmpdir_path)["model"]
    # The next training fails while its model is written, and between model and record.
    with monkeypatch.context() as m:
        m.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ml.publish_training(spark, model, record, tmpdir_path, "week 2")
    assert store.state(spark, tmpdir_path)["model"] == first
    assert ml.training_runs(spark, tmpdir_path).count() == 1
    assert ml.load_model(spark, tmpdir_path).transform(data).count() == 400
    for _ in range(2):       # repeated, and repeated again
        ml.publish_training(spark, model, record | {"auc": 0.5}, tmpdir_path, "week 2")
    runs = {r.run_id: r.auc for r in ml.training_runs(spark, tmpdir_path).collect()}
    assert runs == {"week 1": record["auc"], "week 2": 0.5}
    assert store.state(spark, tmpdir_path)["run_id"] == "week 2" and store.state(spark, tmpdir_path)["model"] != first
    assert ml.latest_trained_at(spark, tmpdir_path) is not None
