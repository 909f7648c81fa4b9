"""Task runs against their limit, with the tasks that block them.

A DAG's tasks wait for one another along edges; which unfinished tasks hold a
late one back is a question of reachability, so the edges are closed first
(``upstream_tasks``) and then met with the unfinished tasks of each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import join_small_dimension
from ..functions.scalars import ts_literal
from ..session import ensure_checkpoint_dir

# The daily pipeline's tasks, each waiting for the one before it (fixed values).
DAILY_TASKS = [
    "generate_synthetic_data",
    "validate_data_files",
    "summarize_data",
    "dq_validate_raw",
    "load_to_bigquery",
    "dbt_run",
    "dbt_test",
    "dq_validate_marts",
    "ml_churn_score",
]
SLA_LIMIT = "2 hours"


def chain_edges(dags: DataFrame, tasks: list[str] = DAILY_TASKS) -> DataFrame:
    """Edges ``(dag_id, upstream, task)`` of a chain of tasks, for every ``dag_id`` of ``dags``."""
    pairs = F.array(*[F.struct(F.lit(a).alias("upstream"), F.lit(b).alias("task")) for a, b in zip(tasks, tasks[1:])])
    return dags.select("dag_id").distinct().select("dag_id", F.inline(pairs))


def daily_edges(spark: SparkSession, dag_id: str = "marketing_data_extract_load") -> DataFrame:
    return chain_edges(spark.createDataFrame([(dag_id,)], "dag_id string"))


def upstream_tasks(edges: DataFrame, max_rounds: int = 24) -> DataFrame:
    """Transitive closure of ``edges(dag_id, upstream, task)``: every task each task waits for, directly or not.

    Each round joins what the last one found with all that is known, on both
    sides, so paths double in length: a graph of depth d takes about log2(d)
    rounds.  Rounds are cut by checkpoints.  Edges with a null end are left
    out, repeated ones count once.  A task that waits for itself raises
    ValueError; so does a graph deeper than 2 ** ``max_rounds``.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    known = edges.select("dag_id", "upstream", "task").dropna().distinct().checkpoint()
    new = known

    def through(first: DataFrame, second: DataFrame) -> DataFrame:
        second = second.select(F.col("dag_id").alias("d"), F.col("upstream").alias("u"), F.col("task").alias("t"))
        return (first.join(second, (F.col("dag_id") == F.col("d")) & (F.col("task") == F.col("u")))
                .select("dag_id", "upstream", F.col("t").alias("task")))

    for _ in range(max_rounds):
        new = (through(new, known).unionByName(through(known, new)).distinct()
               .join(known, ["dag_id", "upstream", "task"], "left_anti").checkpoint())
        if new.isEmpty():
            loops = known.where("upstream = task").limit(1).collect()
            if loops:
                raise ValueError(f"task {loops[0]['task']} of {loops[0]['dag_id']} waits for itself")
            return known
        known = known.unionByName(new).checkpoint()
    raise ValueError(f"the task graph is deeper than 2 ** {max_rounds}")


def sla_miss_blocking(runs: DataFrame, edges: DataFrame, as_of: str, limit: str = SLA_LIMIT) -> DataFrame:
    """Tasks that missed their limit as known at ``as_of``, with the tasks that block them.

    ``runs``: one row per attempt ``(dag_id, scheduled_at, task, finished_at)``;
    a task's run is (dag_id, scheduled_at).  A task is finished by its first
    finished attempt; what finished after ``as_of`` is unfinished then.  It
    missed when ``scheduled_at + limit`` is past and it finished later or not
    at all.  ``blocking_tasks``: unfinished tasks among it and those it waits
    for, directly or not, in the same run, in order of name.

    Returns (dag_id, scheduled_at, task, finished_at, duration_seconds,
    blocking_tasks).  Attempts without a DAG, time or task are left out.  A
    run has at most one row per task once attempts are combined (map-side
    too), so the window over a run is small; the closed edges are broadcast
    only within the size check of ``join_small_dimension``.
    """
    now = ts_literal(as_of)
    due = F.col("scheduled_at") + F.expr(f"INTERVAL {limit}")
    state = (runs.where(F.col("dag_id").isNotNull() & F.col("task").isNotNull() & (F.col("scheduled_at") <= now))
             .groupBy("dag_id", "scheduled_at", "task")
             .agg(F.min(F.when(F.col("finished_at") <= now, F.col("finished_at"))).alias("finished_at")))
    run = Window.partitionBy("dag_id", "scheduled_at")
    late = (state.withColumn("_open", F.collect_set(F.when(F.col("finished_at").isNull(), F.col("task"))).over(run))
            .where((due < now) & (F.col("finished_at").isNull() | (F.col("finished_at") > due))))
    waits = upstream_tasks(edges).groupBy("dag_id", "task").agg(F.collect_set("upstream").alias("_up"))
    out = join_small_dimension(late, waits, ["dag_id", "task"], "left")
    held = F.array_append(F.coalesce("_up", F.array().cast("array<string>")), F.col("task"))
    took = F.timestamp_diff("MICROSECOND", F.col("scheduled_at"), F.col("finished_at")) / F.lit(1e6)
    return out.select("dag_id", "scheduled_at", "task", "finished_at", took.alias("duration_seconds"),
                      F.array_sort(F.array_intersect("_open", held)).alias("blocking_tasks"))


def sla_miss_report(misses: DataFrame) -> DataFrame:
    """The alert of each run with misses: ``(dag_id, scheduled_at, missed_tasks, blocking_tasks)``, names in order."""
    names = lambda c: F.array_sort(F.array_distinct(c))
    return misses.groupBy("dag_id", "scheduled_at").agg(
        names(F.collect_list("task")).alias("missed_tasks"),
        names(F.flatten(F.collect_list("blocking_tasks"))).alias("blocking_tasks"))
