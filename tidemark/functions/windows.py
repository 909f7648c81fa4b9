"""Ordered-window helpers that never put a whole key into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import join_small_dimension

#: Rows that one task may order: keys beyond are cut into segments.
SEGMENT_ROWS = 5_000_000


class Segments:
    """Rows of every key cut, in order, into segments of bounded size, for scans along a key.

    ``rows`` are the given ones with a segment number (``_seg``), ascending
    along ``order`` within a key.  If the largest key (a count with map-side
    combine) is within ``max_rows``, every key is one segment and ``one`` is
    true: a plain window per key is bounded then.  Otherwise all rows are
    range-partitioned by (keys, order) into pieces of about ``max_rows``, and
    the pieces are pinned by a checkpoint, so every later read sees the same
    cut; a key of any size, however its rows cluster, spreads over pieces.
    Rows that are equal in keys and order share a piece: give an ``order`` that
    tells a key's rows apart.

    A scan then has two levels: ``within`` a segment, and over ``borders``,
    one row per key and segment, which carries a value across.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], max_rows: int = SEGMENT_ROWS):
        self.keys, self.order = keys, order
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        top, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
        self.one = (top or 0) <= max_rows
        if self.one:
            self.rows = df.withColumn("_seg", F.lit(0))
            return
        ensure_checkpoint_dir(df.sparkSession)
        self.rows = (df.repartitionByRange(math.ceil(total / max_rows), *keys, *order)
                     .withColumn("_seg", F.spark_partition_id()).checkpoint())

    def within(self):
        """Window over a segment, in order."""
        return Window.partitionBy(*self.keys, "_seg").orderBy(*self.order)

    def borders(self, *aggregates: Column) -> DataFrame:
        """One row per key and segment (map-side combined)."""
        return self.rows.groupBy(*self.keys, "_seg").agg(*aggregates)

    def across(self):
        """Window over a key's borders, in order."""
        return Window.partitionBy(*self.keys).orderBy("_seg")


def running_count(df: DataFrame, keys: list[str], order: list[str], bucket: Column,
                  name: str = "rn") -> DataFrame:
    """``row_number() over (partition by keys order by order)`` in two levels.

    ``bucket`` must be monotone in ``order`` (e.g. the day of a timestamp).
    Level 1 counts rows per (keys, bucket) (partial aggregation) and turns
    them into offsets with a window over that small table; level 2 numbers
    rows inside each (keys, bucket) and adds the offset.  A hot key is spread
    over its buckets instead of one task.
    """
    d = df.withColumn("_bk", bucket)
    counts = d.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    # One row per (keys, bucket): with no keys this window sees only the bucket
    # totals (bounded by the number of buckets), never the rows.
    w = (Window.partitionBy(*keys) if keys else Window).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*keys, "_bk").orderBy(*order)
    d = d.withColumn("_rn", F.row_number().over(inner))
    on = [*keys, "_bk"]
    return (join_small_dimension(d, offsets, on, "left")
            .withColumn(name, (F.col("_rn") + F.col("_off")).cast("long"))
            .drop("_bk", "_rn", "_off", "_n"))


def numbered(df: DataFrame, order: list[str], name: str = "rn", rows_per_partition: int = 1_000_000) -> DataFrame:
    """``row_number() over (order by order)`` with no task above about ``rows_per_partition`` rows.

    Rows are range-partitioned by ``order`` into as many pieces as their
    number asks for (however they cluster), the pieces pinned by a checkpoint;
    offsets come from a window over one row per piece.  ``order`` should be
    unique: equal rows get their numbers in any order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = max(1, math.ceil(df.count() / rows_per_partition))
    d = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)      # one row per piece
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inner = Window.partitionBy("_pid").orderBy(*order)
    return (d.withColumn("_rn", F.row_number().over(inner)).join(offsets, "_pid")
            .withColumn(name, (F.col("_rn") + F.col("_off")).cast("long")).drop("_pid", "_rn", "_off"))


def dense_codes(df: DataFrame, group_col: str, value_col: str, name: str = "code",
                rows_per_partition: int = 1_000_000) -> DataFrame:
    """Per group, code = position of the value among its sorted distinct values (from 0).

    The distinct values are checkpointed and counted; they are then
    range-partitioned by (group, value) into ``ceil(count / rows_per_partition)``
    pieces and the partition ids are pinned with a second checkpoint (so
    every later read sees the same cut).  Offsets come from per-(group,
    partition) counts, a window over one row per partition; codes inside a
    partition from a window over that partition only.  No task holds more
    than about ``rows_per_partition`` values, whatever a group's size.
    """
    ensure_checkpoint_dir(df.sparkSession)
    distinct = df.select(group_col, value_col).distinct().checkpoint()
    n = max(1, math.ceil(distinct.count() / rows_per_partition))
    d = (distinct.repartitionByRange(n, group_col, value_col)
         .withColumn("_pid", F.spark_partition_id())
         .checkpoint())
    counts = d.groupBy(group_col, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(group_col, "_pid").orderBy(value_col)
    return (d.withColumn("_rn", F.row_number().over(inner))
            .join(offsets, [group_col, "_pid"], "left")
            .select(group_col, value_col, (F.col("_off") + F.col("_rn") - 1).cast("long").alias(name)))
