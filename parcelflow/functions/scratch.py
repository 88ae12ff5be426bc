"""Shared scratch folder for tables that one run writes and reads back."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Per application, the folders of `stored` tables, each with a weak reference to the relation that reads it.
_tables: dict[str, list] = defaultdict(list)
#: Folders made inside a `with scratch(...)` block.
_scopes: list[list[str]] = []


def _root(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")) and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError(f"executors may not see {warehouse}: name a shared folder in spark.checkpoint.dir")
    return warehouse


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder named by `spark.checkpoint.dir`, else in the warehouse folder.

    Every executor must see the folder: on a cluster a warehouse folder on a local disk is an error. What the caller writes there stays until
    `discard`, or to the end of the `scratch` block around the call.
    """
    path = f"{_root(spark)}/parcelflow/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block at whose end all scratch folders made in it are deleted: results that read them must be used or written inside."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder; one that is gone already is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a scratch table: a cut in the lineage that survives lost executors.

    The table lives as long as any frame that reads it, like Spark's own shuffle files: each call deletes tables that no plan refers to any more.
    """
    spark = df.sparkSession
    tables = _tables[spark.sparkContext.applicationId]
    dead = [path for path, relation in tables if relation.get() is None]
    tables[:] = [(path, relation) for path, relation in tables if path not in dead]
    for path in dead:
        discard(spark, path)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    # all plans made from the table share this relation
    relation = table._jdf.queryExecution().analyzed().relation()
    tables.append((path, spark.sparkContext._jvm.java.lang.ref.WeakReference(relation)))
    return table
