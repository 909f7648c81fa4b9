"""Spark session settings shared by the library, tests and the bench.

The library never creates a session on its own behalf; callers pass one in.
``get_session`` is a convenience for scripts and tests.  It only fills in
settings that are unset, so a cluster's own configuration (shuffle sizing,
checkpoint folder, memory) always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on for its semantics (not for speed).
SEMANTIC_CONF = {
    # Timestamps in the data are wall-clock UTC; date() and day windows use it.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts raise, as the warehouse dialect does.
    "spark.sql.ansi.enabled": "true",
}

# Settings that matter at scale: runtime re-planning, skew splitting, runtime
# broadcast conversion from measured sizes, and partition sizing that keeps
# tasks near a few hundred MB (AQE coalesces small shuffle partitions).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Coalesce to the advisory size rather than to the core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Static settings: only effective when this call starts the Spark context.
STATIC_CONF = {
    "spark.ui.enabled": "false",
    # Delete checkpoint files (AUC per-score table, encoder values, training
    # data) once their datasets go out of scope.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "tidemark", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Get or create a session; fill in only the settings the launch left unset."""
    extra = dict(extra or {})
    if shuffle_partitions is not None:
        extra["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**STATIC_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for k, v in SCALE_CONF.items():
        if k not in extra and not launched.contains(k):
            spark.conf.set(k, v)
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file
    system); it is only filled in here when unset, which happens in local
    tests.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object "
                                   "store) that every executor can reach")
            # Single-machine runs (tests) only.
            d = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()
