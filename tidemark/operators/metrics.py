"""Pipeline-metric queries (T1-T10) over a table of samples.

Samples: ``(metric string, labels map<string,string>, ts timestamp, value
double, seq long)``; ``seq`` breaks ties between samples of one series at the
same instant.  A series is (metric, labels); labels are grouped as their
sorted entry array because maps cannot be grouping keys.

Counter increases need consecutive samples of a series.  A busy series can
hold a large share of all samples, and a burst of them can fall into one
second, so no window is partitioned by series or time alone: series are cut
into segments of a bounded number of rows (``functions.windows.Segments``),
``lag`` runs inside a segment, and the step into a segment comes from a window
over one row (first and last sample) per segment.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ts_literal
from ..functions.windows import SEGMENT_ROWS, Segments

# Name mapping rules of the metrics exporter, first match wins (fixed values):
# (glob, metric name, label key); "$1" is the text matched by "*".
MAPPING_RULES = [
    ("airflow.dagrun.duration.success.*", "airflow_dagrun_duration_success_seconds", "dag_id"),
    ("airflow.dagrun.duration.failed.*", "airflow_dagrun_duration_failed_seconds", "dag_id"),
    ("airflow.dagrun.schedule_delay.*", "airflow_dagrun_schedule_delay_seconds", "dag_id"),
    ("airflow.operator_successes_*", "airflow_operator_successes_total", "operator"),
    ("airflow.operator_failures_*", "airflow_operator_failures_total", "operator"),
    ("airflow.pool.open_slots.*", "airflow_pool_open_slots", "pool"),
    ("airflow.pool.used_slots.*", "airflow_pool_used_slots", "pool"),
    ("airflow.pool.starving_tasks.*", "airflow_pool_starving_tasks", "pool"),
    ("airflow.dag_processing.last_runtime.*", "airflow_dag_processing_last_runtime_seconds", "dag_file"),
    ("airflow.*", "airflow_$1", None),
]

# Dashboard colour steps (fixed values): (lower bound or None, colour).
HEARTBEAT_STEPS = [(None, "red"), (0.001, "green")]
FAILURE_STEPS = [(None, "green"), (1, "yellow"), (3, "red")]
SLA_LIMIT = "2 hours"


def glob_to_regex(glob: str) -> str:
    """``*`` matches within one dot-separated component."""
    return "^" + "([^.]*)".join(re.escape(p) for p in glob.split("*")) + "$"


def map_metric_names(df: DataFrame, name_col: str = "name", rules=MAPPING_RULES) -> DataFrame:
    """Adds ``metric`` and ``labels``; unmatched names are sanitised, no labels.

    The first matching rule is found once per row (``_rule``); name and labels
    then branch on that index, so each regex runs at most once.
    """
    name = F.col(name_col)
    regexes = [glob_to_regex(glob) for glob, _, _ in rules]
    rule = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        rule = F.when(name.rlike(regexes[i]), F.lit(i)).otherwise(rule)
    out = df.withColumn("_rule", rule)
    idx = F.col("_rule")
    metric = F.regexp_replace(name, r"[^a-zA-Z0-9_:]", "_")
    labels = F.create_map().cast("map<string,string>")
    for i, (glob, target, key) in enumerate(rules):
        rx = regexes[i]
        m = F.regexp_replace(name, rx, target) if "$1" in target else F.lit(target)
        lab = (F.create_map(F.lit(key), F.regexp_extract(name, rx, 1)) if key
               else F.create_map().cast("map<string,string>"))
        metric = F.when(idx == i, m).otherwise(metric)
        labels = F.when(idx == i, lab).otherwise(labels)
    return out.withColumn("metric", metric).withColumn("labels", labels).drop("_rule")


def _key() -> Column:
    return F.array_sort(F.map_entries(F.col("labels")))


def _inc(value: Column, prev: Column) -> Column:
    """One counter step: a drop is a reset, so the new value is the growth."""
    return (F.when(prev.isNull(), F.lit(0.0))
            .when(value >= prev, value - prev)
            .otherwise(value))


def _steps(samples: DataFrame, slice_: Column, segment_rows: int) -> DataFrame:
    """Samples reduced to (series, slice): ``_in`` growth inside the slice, ``_b`` the step into it from the
    series' last sample before (null for its first slice), ``_n`` samples.  ``slice_`` must not fall along time."""
    s = (samples.where(F.col("value").isNotNull())
         .select("metric", _key().alias("_k"), "ts", "seq", F.col("value").cast("double").alias("value"))
         .withColumn("_s", slice_))
    order = F.struct("ts", "seq")
    point = F.struct("value", "_s")
    cut = Segments(s, ["metric", "_k"], ["ts", "seq"], segment_rows)
    grown = _inc(F.col("value"), F.col("_p.value"))
    inner = F.col("_p._s") == F.col("_s")
    growth = [F.coalesce(F.sum(F.when(inner, grown)), F.lit(0.0)).alias("_in"),
              F.sum(F.when(~inner, grown)).alias("_b")]
    steps = (cut.rows.withColumn("_p", F.lag(point).over(cut.within()))
             .groupBy("metric", "_k", "_s").agg(*growth, F.count(F.lit(1)).alias("_n")))
    if cut.one:
        return steps
    # The first sample of a segment follows the last one of the segment before.
    ends = (cut.borders(F.min_by(point, order).alias("_f"), F.max_by(point, order).alias("_l"))
            .withColumn("_p", F.lag("_l").over(cut.across()))
            .select("metric", "_k", F.col("_f.value").alias("value"), F.col("_f._s").alias("_s"), "_p"))
    ends = ends.groupBy("metric", "_k", "_s").agg(*growth).withColumn("_n", F.lit(0).cast("long"))
    return (steps.unionByName(ends).groupBy("metric", "_k", "_s")
            .agg(F.sum("_in").alias("_in"), F.sum("_b").alias("_b"), F.sum("_n").alias("_n")))


def counter_increase(samples: DataFrame, range_: str = "24 hours", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per series and tumbling range, growth of a counter (resets counted).

    The first sample of a range adds 0 (no edge extrapolation).  No task
    orders more than about ``segment_rows`` samples.  Returns (metric, labels,
    window_start, window_end, increase, samples).
    """
    steps = _steps(samples, F.window("ts", range_), segment_rows)
    return steps.select("metric", F.map_from_entries("_k").alias("labels"), F.col("_s.start").alias("window_start"),
                        F.col("_s.end").alias("window_end"), F.col("_in").alias("increase"), F.col("_n").alias("samples"))


def counter_rate(samples: DataFrame, range_seconds: int = 300, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Increase per second over tumbling ranges (2 m / 5 m on the dashboard)."""
    inc = counter_increase(samples, f"{range_seconds} seconds", segment_rows)
    return inc.withColumn("rate", F.col("increase") / F.lit(float(range_seconds)))


def counter_lookback(samples: DataFrame, range_seconds: int, every_seconds: int | None = None,
                     as_of: str | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """T2 / T3 at evaluation times: growth over ``(t - range, t]`` for each series.

    ``every_seconds``: at every multiple of it (which must divide the range)
    whose range holds a sample; ``as_of``: at that instant only.  The first
    sample of a range adds 0 and resets count, as in ``counter_increase``.
    Returns (metric, labels, evaluated_at, increase, rate, samples).

    Samples are reduced to slices of ``every_seconds`` (growth inside, and the
    step into the slice); the growth over a range is a windowed sum over
    slices, less the step into its first slice.  No sample is copied per time.
    """
    if (every_seconds is None) == (as_of is None):
        raise ValueError("give either every_seconds or as_of")
    if every_seconds is not None and range_seconds % every_seconds:
        raise ValueError("every_seconds must divide range_seconds")
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", zero, F.col("ts").cast("timestamp_ntz"))
    if as_of is not None:
        end = F.timestamp_diff("MICROSECOND", zero, ts_literal(as_of))
        inside = samples.where((micros > end - range_seconds * 1_000_000) & (micros <= end))
        out = (_steps(inside, F.lit(0), segment_rows)
               .select("metric", "_k", F.col("_in").alias("increase"), F.col("_n").alias("samples"),
                       ts_literal(as_of).alias("evaluated_at")))
    else:
        # Slice number: the evaluation time at its (inclusive) end, in steps.
        slices = _steps(samples, -F.floor(-micros / F.lit(every_seconds * 1_000_000)), segment_rows)
        series = Window.partitionBy("metric", "_k").orderBy("_s")
        # Times without samples of their own: the steps after a slice while it is in range, up to the next slice.
        span = range_seconds // every_seconds
        slices = slices.withColumn("_until", F.least(
            F.col("_s") + span - 1, F.coalesce(F.lead("_s").over(series) - 1, F.lit(2**62))))
        slices = slices.withColumn("_t", F.explode(F.sequence(F.col("_s"), F.col("_until"))))
        own = F.col("_t") == F.col("_s")
        into = F.coalesce("_b", F.lit(0.0))
        window = Window.partitionBy("metric", "_k").orderBy("_t").rangeBetween(-(span - 1), 0)
        total = F.sum(F.when(own, F.col("_in") + into).otherwise(0.0)).over(window)
        entry = F.first(F.when(own, into), ignorenulls=True).over(window)
        # Whole days and the seconds left: an interval of any length, before or after 1970.
        seconds = F.col("_t") * every_seconds
        at = zero + F.make_dt_interval(days=F.floor(seconds / 86400).cast("int"),
                                       secs=F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))
        out = slices.select("metric", "_k", (total - entry).alias("increase"),
                            F.sum(F.when(own, F.col("_n"))).over(window).alias("samples"), at.alias("evaluated_at"))
    return out.select("metric", F.map_from_entries("_k").alias("labels"), "evaluated_at", "increase",
                      (F.col("increase") / F.lit(float(range_seconds))).alias("rate"), "samples")


def sum_over_series(increases: DataFrame, value_col: str = "increase") -> DataFrame:
    """T4: total of each metric across its series (label values) per range."""
    return increases.groupBy("metric", "window_start", "window_end").agg(F.sum(value_col).alias(f"total_{value_col}"))


def last_value(samples: DataFrame) -> DataFrame:
    """T5: latest non-null sample per series."""
    s = samples.where(F.col("value").isNotNull()).select("metric", _key().alias("_k"), "ts", "seq", "value")
    latest = F.max_by(F.struct("ts", "value"), F.struct("ts", "seq"))
    return s.groupBy("metric", "_k").agg(latest.alias("_l")).select(
        "metric", F.map_from_entries("_k").alias("labels"),
        F.col("_l.ts").alias("ts"), F.col("_l.value").alias("value"))


def threshold_band(value: Column, steps) -> Column:
    """Colour of the highest step whose lower bound is <= value."""
    base = [c for lo, c in steps if lo is None]
    out = F.lit(base[0] if base else None)
    for lo, colour in sorted([s for s in steps if s[0] is not None], key=lambda s: s[0]):
        out = F.when(value >= F.lit(float(lo)), F.lit(colour)).otherwise(out)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(out)


def gauge_range(samples: DataFrame, metrics: list[str], as_of: str, range_: str = "24 hours") -> DataFrame:
    """Raw gauge samples of the listed metrics in ``(as_of - range, as_of]``."""
    end = ts_literal(as_of)
    start = end - F.expr(f"INTERVAL {range_}")
    return samples.where(F.col("metric").isin(*metrics) & (F.col("ts") > start) & (F.col("ts") <= end))


def label_filter(samples: DataFrame, metrics: list[str], label: str, value: str) -> DataFrame:
    """Samples with ``labels[label] = value``, the listed metrics side by side per ts."""
    s = samples.where(F.col("metric").isin(*metrics) & (F.col("labels")[label] == F.lit(value)))
    return s.groupBy("ts").pivot("metric", metrics).agg(F.max_by("value", "seq"))


def success_vs_failure(samples: DataFrame, success_metric: str, failure_metric: str,
                       range_seconds: int = 300, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Both rates, tagged."""
    both = counter_rate(samples.where(F.col("metric").isin(success_metric, failure_metric)), range_seconds, segment_rows)
    return both.withColumn("kind", F.when(F.col("metric") == success_metric, "success").otherwise("failure"))


def sla_miss(runs: DataFrame, limit: str = SLA_LIMIT, as_of: str | None = None) -> DataFrame:
    """Runs that finished later than ``scheduled_at + limit``.

    With ``as_of``, runs not finished by then whose limit has passed are
    reported too (null ``duration_seconds``)."""
    due = F.col("scheduled_at") + F.expr(f"INTERVAL {limit}")
    late = F.coalesce(F.col("finished_at") > due, F.lit(False))
    if as_of is not None:
        late = late | (F.col("finished_at").isNull() & (due < ts_literal(as_of)))
    dur = F.timestamp_diff("MICROSECOND", F.col("scheduled_at"), F.col("finished_at")) / F.lit(1e6)
    return runs.where(late).withColumn("duration_seconds", dur)
