"""Raw sources and sinks (S1-S9, S12): CSV reads with declared schemas,
layered namespaces, table writes and file inventory.

Writes go to a warehouse folder the caller names (on a cluster: a shared
file system or object store); nothing is written to machine-local temp
space.  Table rebuilds are whole new versions, published by ``sources.store``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_FILES, RAW_SCHEMAS
from ..operators.staging import view_sql
from . import store
from .store import new_version

LAYERS = ("raw", "staging", "marts")


def require_sources(spark: SparkSession, raw_dir: str, files=tuple(RAW_FILES)) -> None:
    """S3: check every expected file first; one error names all missing files."""
    missing = [f for f in files if not store.exists(spark, f"{raw_dir.rstrip('/')}/{f}")]
    if missing:
        raise FileNotFoundError(f"Missing file(s) in {raw_dir}: {', '.join(missing)}")


def read_raw(spark: SparkSession, raw_dir: str, table: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, columns taken by header name, with the declared types.

    The files may list the columns in any order; further columns are left
    out, a missing one raises.  Files whose headers differ from the first
    one's, and malformed rows, fail the read.  Quoted text may hold commas and
    doubled quotes.  With ``multi_line`` it may hold line breaks too; a file
    is then one task, since no split can tell where a row begins, so large
    inputs should come in many files.  Without it a value that spans lines
    fails the read.
    """
    file = {v: k for k, v in RAW_FILES.items()}[table]
    path = f"{raw_dir.rstrip('/')}/{file}"
    options = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    declared = {f.name: f for f in RAW_SCHEMAS[table].fields}
    missing = [c for c in declared if c not in header]
    if missing:
        raise ValueError(f"{file} has no column {', '.join(missing)}")
    schema = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])
    return (spark.read.schema(schema).options(**options)
            .option("enforceSchema", False)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .csv(path).select(*declared))


def read_all_raw(spark: SparkSession, raw_dir: str, multi_line: bool = False) -> dict[str, DataFrame]:
    require_sources(spark, raw_dir)
    return {t: read_raw(spark, raw_dir, t, multi_line) for t in RAW_FILES.values()}


def layer_namespace(layer: str | None, default: str = "default") -> str:
    """Custom layer name used verbatim (trimmed), else the default namespace."""
    return default if layer is None else layer.strip()


def table_path(warehouse: str, layer: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{layer_namespace(layer)}/{table}"


def write_table(df: DataFrame, warehouse: str, layer: str, table: str, register: bool = True) -> str:
    """Whole-table rebuild (truncate + reload) as parquet; returns the new version's folder.

    Every rebuild is a version folder of its own, made current by one rename
    of the layer's manifest, so readers of the last one are not disturbed and
    a failed write changes nothing.  With ``register`` the catalog's
    ``<layer>.<table>`` (S7) follows, so SQL users can query
    ``marts.mart_customer_ltv``.  Tables that belong together are published
    together with ``store.Release``.
    """
    release = store.Release(df.sparkSession, warehouse, layer_namespace(layer))
    release.write(df, table)
    release.publish(register)
    return release.paths[table]


def read_table(spark: SparkSession, warehouse: str, layer: str, table: str) -> DataFrame:
    """The published version of a table."""
    path = store.state(spark, f"{warehouse.rstrip('/')}/{layer_namespace(layer)}").get("tables", {}).get(table)
    if path is None:
        raise FileNotFoundError(f"{layer}.{table} is not published in {warehouse}")
    return spark.read.parquet(path)


def load_raw(spark: SparkSession, raw_dir: str, warehouse: str, register: bool = True) -> dict[str, DataFrame]:
    """Load the four files into the raw layer, all published together; returns the reloaded tables."""
    release = store.Release(spark, warehouse, "raw")
    out = {table: release.write(df, table) for table, df in read_all_raw(spark, raw_dir).items()}
    release.publish(register)
    return out


LANDING = "_landing"


def land_raw(spark: SparkSession, raw_dir: str, warehouse: str, version: str | None = None) -> dict[str, str]:
    """Parse each CSV once into a new version folder (not published); returns the folder of each table.

    Every check then reads only the columns it needs from parquet instead of
    parsing the text again, and the written files cut the lineage.  Earlier
    versions, the published one among them, stay as they are.
    """
    return land_observed(spark, raw_dir, warehouse, lambda table, columns: [], version)[0]


def land_observed(spark: SparkSession, raw_dir: str, warehouse: str,
                  aggregates: Callable[[str, list[str]], list[Column]],
                  version: str | None = None, multi_line: bool = False) -> tuple[dict[str, str], dict[str, dict]]:
    """``land_raw`` that also returns, by table, the values of ``aggregates(table, columns)``.

    They are observed on the rows as they are written, without a scan of
    their own; the write is one stage, whose tasks count once however often
    they are tried.
    """
    version = version or new_version()
    landed, observed = {}, {}
    for table, df in read_all_raw(spark, raw_dir, multi_line).items():
        landed[table] = f"{table_path(warehouse, LANDING, table)}/{version}"
        wanted = aggregates(table, df.columns)
        seen = Observation()
        if wanted:
            df = df.observe(seen, *wanted)
        df.write.mode("errorifexists").parquet(landed[table])
        if wanted:
            observed[table] = seen.get
    return landed, observed


def publish_raw(spark: SparkSession, landed: dict[str, str], warehouse: str) -> dict[str, DataFrame]:
    """S2 after the gates: point the raw layer's tables, together, at the landed version; no data is written again."""
    release = store.Release(spark, warehouse, "raw")
    out = {table: release.add(table, path) for table, path in landed.items()}
    release.publish()
    return out


def staging_views(spark: SparkSession, staged: dict[str, DataFrame], warehouse: str | None = None) -> list[str]:
    """Publish staging models as (lazy) views of the session; with ``warehouse`` also as catalog views
    ``staging.<model>`` over the published raw tables, which outlive the session and follow every new load."""
    for name, df in staged.items():
        df.createOrReplaceTempView(name)
    if warehouse is None:
        return list(staged)
    return list(staged) + store.persist_views(spark, warehouse, "staging", {n: view_sql(n) for n in staged})


def scan_count(df: DataFrame) -> DataFrame:
    """Exact row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def scan_sample(df: DataFrame, n: int = 100_000) -> DataFrame:
    """The reference's unordered ``LIMIT n`` (checks here use full tables)."""
    return df.limit(n)


def file_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per table: files, bytes, rows and columns (file listing + one count).

    ``paths``: a CSV or parquet file or folder by table name.  A file without
    rows counts with its size and no rows.
    """
    out = None
    for name, path in paths.items():
        df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).csv(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        summary = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p)
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(int(summary.getFileCount())).cast("long").alias("file_count"),
            F.lit(int(summary.getLength())).cast("long").alias("file_size"), "row_count",
            F.lit(len(df.columns)).alias("column_count"))
        out = row if out is None else out.unionByName(row)
    return out
