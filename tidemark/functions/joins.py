"""Join helper that broadcasts only behind a size check.

``join_small_dimension`` adds a broadcast hint only when the optimizer's size
estimate of the dimension plan is within ``max_bytes`` (for file scans an
upper bound from file sizes; no job is run).  Otherwise it leaves the join
to Spark: a shuffle join that AQE turns into a broadcast only after the
dimension's shuffle output has been measured below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and whose skewed
partitions AQE splits.  The choice changes the plan only, never the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_small_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                         max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return fact.join(F.broadcast(dim) if estimated_bytes(dim) <= max_bytes else dim, on, how)
