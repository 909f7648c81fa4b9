"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

LONG_MAX = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a plan that reads it.

    Cuts lineage and survives lost executors; used where a costly result is
    read more than once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shipped(spark: SparkSession, value):
    """Send a value of bounded size to the executors; the result, called in a
    task, gives it (unpacked once per Python worker)."""
    sent, held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get():
        if not held:
            held.append(pickle.loads(sent.value))
        return held[0]
    return get


def made_once(spark: SparkSession, value, make: Callable):
    """Like ``shipped``, but the result, called in a task, gives ``make(value)``,
    made once per Python worker and kept for the worker's later tasks.

    A worker holds one copy of a broadcast for all its tasks; what is made
    stands in that copy and goes with it.
    """
    sent = spark.sparkContext.broadcast({"value": cloudpickle.dumps(value)})

    def get():
        kept = sent.value
        if "made" not in kept:
            kept["made"] = make(pickle.loads(kept["value"]))
        return kept["made"]
    return get


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str,
             batch_rows: int = 8192) -> DataFrame:
    """``mapInArrow`` over Python tuples: ``fn`` gets an iterator of rows of one
    partition and yields output tuples, which are sent back in bounded batches."""
    out = df.sparkSession.createDataFrame([], schema).schema
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(out)

        def rows():
            for b in batches:
                # Slices keep the Python objects of one batch bounded.
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        buf: list[tuple] = []
        for row in fn(rows()):
            buf.append(row)
            if len(buf) >= batch_rows:
                yield _batch(buf, names, arrow)
                buf = []
        if buf:
            yield _batch(buf, names, arrow)

    return df.mapInArrow(run, out)


def _batch(rows: list[tuple], names: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=arrow.field(i).type) for i, c in enumerate(cols)],
                                      names=names)


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Components of an undirected graph: ``edges(a, b)`` (long) -> ``(node, component)``.

    ``component`` is the smallest node of the component; nodes without an
    edge to another node are not listed.  Alternating large-star / small-star
    rounds (logarithmic in the component size); every step is a min
    aggregate with map-side combine or a key join, so a node with very many
    links costs one partial row per task.  Rounds are cut by checkpoints.
    Null ends are ignored.  Raises if ``max_rounds`` do not suffice.
    """
    cur = checkpointed(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _signature(cur)
    if seen[0] == 0:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        # The sides of both joins are written first: the joins then read plain shuffles, whose skewed
        # partitions (a node with a large share of all links) Spark can split.
        # Large star: a node's larger neighbours move to its smallest neighbour.
        low = checkpointed(cur.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")))
        large = checkpointed(cur.join(low, F.col("v") == F.col("x"), "left")
                             .select("u", F.coalesce("m", "v").alias("v"))
                             .union(low.select("x", "m")).distinct())
        # Small star: a node's smaller neighbours meet at the smallest of them.
        low = checkpointed(large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")))
        small = (large.join(low, F.col("u") == F.col("x")).where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("x", "m")).distinct())
        cur = checkpointed(small)
        now = _signature(cur)
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _signature(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first()
    return tuple(r)
