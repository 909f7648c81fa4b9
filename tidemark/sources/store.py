"""What is published: one manifest per folder, swapped by one rename.

A folder's state (which version of every table of a layer is current, which
model, which training runs) is a small JSON document in
``<folder>/_manifest/<number>.json``; the highest number is current.  A change
writes the whole next document to a side file and renames it to the next
number.  The rename does not replace an existing file: of two publishers one
is first, and the other reads the new state and applies its change to that.  A
reader takes one document and so sees every table of the same moment; a failed
writer leaves nothing that a reader would look at.

Data lie in version folders that nothing rewrites, so a query that is running
on the last version is not disturbed; clearing old versions is the
deployment's business.  All file access goes through Hadoop's file systems.
Exclusive renames are as atomic as the store's: HDFS guarantees them, a plain
local disk all but guarantees them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest"


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def new_version() -> str:
    """Name of a version folder; later names sort behind earlier ones, and no two are equal."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    place = f"{folder.rstrip('/')}/{MANIFEST}"
    if not exists(spark, place):
        return []
    names = [s.getPath().getName() for s in file_system(spark, place).listStatus(hadoop_path(spark, place))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{MANIFEST}/{number:012d}.json"


def _read(spark: SparkSession, path: str) -> dict:
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def state(spark: SparkSession, folder: str) -> dict:
    """The current document of a folder; empty when nothing was published."""
    numbers = _numbers(spark, folder)
    return _read(spark, _file(folder, numbers[-1])) if numbers else {}


def commit(spark: SparkSession, folder: str, change: Callable[[dict], dict], attempts: int = 50) -> dict:
    """Publish ``change(current document)``; repeated on the newer one when another publisher was first."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = hadoop_path(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    fs = place.getFileSystem(conf)
    fs.mkdirs(place)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), conf)
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    for _ in range(attempts):
        numbers = _numbers(spark, folder)
        document = change(_read(spark, _file(folder, numbers[-1])) if numbers else {})
        side = hadoop_path(spark, f"{folder.rstrip('/')}/{MANIFEST}/.{uuid.uuid4().hex}")
        stream = fs.create(side, False)
        try:
            stream.write(json.dumps(document, sort_keys=True).encode("utf-8"))
        finally:
            stream.close()
        following = _file(folder, numbers[-1] + 1 if numbers else 1)
        try:
            context.rename(fs.makeQualified(side), fs.makeQualified(hadoop_path(spark, following)), keep)
            return document
        except Exception as e:  # noqa: BLE001 - only "another was first" is dealt with
            fs.delete(side, False)
            if "FileAlreadyExistsException" not in str(e):
                raise
    raise RuntimeError(f"{folder}: other publishers were first {attempts} times")


class Release:
    """Versions of tables of one layer that become current together."""

    def __init__(self, spark: SparkSession, warehouse: str, layer: str):
        self.spark, self.warehouse, self.layer = spark, warehouse.rstrip("/"), layer
        self.folder = f"{self.warehouse}/{layer}"
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` as the table's next version; returns what was written.  Nothing is published yet."""
        path = f"{self.folder}/{table}/{new_version()}"
        df.write.mode("errorifexists").parquet(path)
        return self.add(table, path)

    def add(self, table: str, path: str) -> DataFrame:
        """Take files that are already written as the table's next version."""
        self.paths[table] = path
        return self.spark.read.parquet(path)

    def publish(self, register: bool = True) -> dict[str, str]:
        """Make all versions of this release current with one rename; the catalog then follows.

        With ``register``, tables appear in the session catalog as
        ``<layer>.<table>``, external tables that are pointed at the new
        version in place (``ALTER TABLE ... SET LOCATION``), so there is no
        moment without a table.  (Another session that has read the table
        keeps its file listing until ``REFRESH TABLE``.)  What the catalog cannot follow (a managed
        table of that name, columns that went or changed type) is refused
        before anything is published.
        """
        added = {t: _catalog_check(self.spark, self.layer, t, p) for t, p in self.paths.items()} if register else {}
        document = commit(self.spark, self.folder, lambda d: d | {"tables": d.get("tables", {}) | self.paths})
        for table, columns in added.items():
            _catalog_follow(self.spark, self.warehouse, self.layer, table, self.paths[table], columns)
        return document["tables"]


def _catalog_check(spark: SparkSession, layer: str, table: str, path: str) -> list[str] | None:
    """Columns to add to the catalog's table, in DDL; None when there is no table yet."""
    name = f"`{layer}`.`{table}`"
    if not spark.catalog.tableExists(name):
        return None
    if spark.catalog.getTable(name).tableType == "MANAGED":
        raise ValueError(f"{layer}.{table} is a managed table; drop it first")
    had = [(f.name, f.dataType) for f in spark.table(name).schema]
    now = [(f.name, f.dataType) for f in spark.read.parquet(path).schema]
    if now[:len(had)] != had:
        raise ValueError(f"{layer}.{table}: columns went or changed type; drop the table first")
    return [f"`{n}` {t.simpleString()}" for n, t in now[len(had):]]


def _catalog_follow(spark: SparkSession, warehouse: str, layer: str, table: str, path: str, columns) -> None:
    name = f"`{layer}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{warehouse}/{layer}'")
    if columns is None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        return
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    if columns:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(columns)})")
    spark.catalog.refreshTable(name)


def read_layer(spark: SparkSession, warehouse: str, layer: str) -> dict[str, DataFrame]:
    """All tables of a layer, of one moment."""
    tables = state(spark, f"{warehouse.rstrip('/')}/{layer}").get("tables", {})
    return {t: spark.read.parquet(p) for t, p in tables.items()}


def persist_views(spark: SparkSession, warehouse: str, layer: str, views: dict[str, str]) -> list[str]:
    """Keep views in the session catalog as ``<layer>.<view>`` (replaced in place); they outlive the session
    wherever the catalog does."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{warehouse.rstrip('/')}/{layer}'")
    for name, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {query}")
    return [f"{layer}.{name}" for name in views]
