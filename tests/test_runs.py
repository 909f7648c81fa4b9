import random

import pytest
from helpers import T
from pyspark.sql import functions as F

from tidemark.operators import runs as R


def edges(spark, rows):
    return spark.createDataFrame(rows, "dag_id string, upstream string, task string")


def closure(pairs):
    out = set(pairs)
    while True:
        more = {(d, a, c) for d, a, b in out for e, x, c in out if d == e and b == x} - out
        if not more:
            return out
        out |= more


def test_closure_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [("d%d" % (k % 2), f"t{a:02d}", f"t{b:02d}") for k in range(60) for a, b in [sorted(rnd.sample(range(30), 2))]]
    rows += [("d0", None, "t1"), (None, "t1", "t2"), rows[0]]
    got = [tuple(r) for r in R.upstream_tasks(edges(spark, rows)).collect()]
    assert sorted(got) == sorted(closure([r for r in rows if None not in r]))


def test_long_chain_in_few_rounds(spark):
    chain = edges(spark, [("d", f"t{i:03d}", f"t{i + 1:03d}") for i in range(40)])
    assert R.upstream_tasks(chain, max_rounds=7).count() == 40 * 41 // 2
    with pytest.raises(ValueError, match="deeper"):
        R.upstream_tasks(chain, max_rounds=3)


def test_a_task_that_waits_for_itself(spark):
    with pytest.raises(ValueError, match="waits for itself"):
        R.upstream_tasks(edges(spark, [("d", "a", "b"), ("d", "b", "c"), ("d", "c", "a")]))


def attempts(spark, rows):
    return spark.createDataFrame(rows, "dag_id string, scheduled_at timestamp_ntz, task string, finished_at timestamp_ntz")


def test_blocking_tasks(spark):
    day, other = T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00")
    graph = edges(spark, [("d", "a", "b"), ("d", "b", "c"), ("d", "x", "c"), ("e", "c", "a")])
    rows = [("d", day, "a", T("2024-01-01 01:00:00")), ("d", day, "b", None), ("d", day, "b", None), ("d", day, "c", None),
            ("d", day, "x", T("2024-01-01 09:00:00")), ("d", day, "y", None),
            ("d", other, "a", None), ("d", other, "c", None),
            ("e", day, "a", T("2024-01-01 03:00:00")), ("e", day, "c", T("2024-01-01 02:30:00")), ("e", day, "c", None),
            (None, day, "a", None), ("d", None, "a", None), ("d", day, None, None)]
    found = R.sla_miss_blocking(attempts(spark, rows), graph, "2024-01-01 08:00:00")
    got = {(r.dag_id, r.task): (r.duration_seconds, r.blocking_tasks) for r in found.collect()}
    assert got == {("d", "b"): (None, ["b"]), ("d", "c"): (None, ["b", "c", "x"]), ("d", "x"): (None, ["x"]),
                   ("d", "y"): (None, ["y"]), ("e", "a"): (10800.0, []), ("e", "c"): (9000.0, [])}
    report = {r.dag_id: (r.missed_tasks, r.blocking_tasks) for r in R.sla_miss_report(found).collect()}
    assert report == {"d": (["b", "c", "x", "y"], ["b", "c", "x", "y"]), "e": (["a", "c"], [])}
    # Later: x is done, and the next day's tasks are late too.
    found = R.sla_miss_blocking(attempts(spark, rows), graph, "2024-01-02 03:00:00")
    got = {(r.dag_id, r.scheduled_at, r.task): r.blocking_tasks for r in found.collect()}
    assert got["d", day, "c"] == ["b", "c"] and got["d", day, "x"] == []
    assert got["d", other, "c"] == ["a", "c"] and got["d", other, "a"] == ["a"]


def test_no_runs_and_no_edges(spark):
    none = attempts(spark, [])
    graph = R.daily_edges(spark)
    assert R.sla_miss_blocking(none, graph, "2024-01-01 00:00:00").collect() == []
    one = attempts(spark, [("marketing_data_extract_load", T("2024-01-01 00:00:00"), "dbt_run", None)])
    got = R.sla_miss_blocking(one, graph.where(F.lit(False)), "2024-01-02 00:00:00").collect()
    assert [r.blocking_tasks for r in got] == [["dbt_run"]]


def test_daily_chain(spark):
    rows = [("marketing_data_extract_load", T("2024-01-01 00:00:00"), t, T("2024-01-01 00:30:00") if i < 4 else None)
            for i, t in enumerate(R.DAILY_TASKS)]
    found = R.sla_miss_blocking(attempts(spark, rows), R.daily_edges(spark), "2024-01-01 06:00:00").collect()
    assert {r.task: r.blocking_tasks for r in found} == {
        t: sorted(R.DAILY_TASKS[4:i + 1]) for i, t in enumerate(R.DAILY_TASKS) if i >= 4}
