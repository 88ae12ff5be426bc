"""Scratch tables live as long as frames that read them."""

import gc
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from parcelflow.functions import scratch as folder


def there(spark, name):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return sorted(Path(root, "parcelflow").glob(f"{name}-*"))


def collected(spark):
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def test_many_unread_results_under_one_name(spark):
    """Five lazy results, also through frames derived from them; none is deleted before it is read."""
    frames = [folder.stored(spark.range(i + 1), "lazy") for i in range(5)]
    frames = [f.selectExpr("id + 1 AS n").where("n > 0") for f in frames]
    collected(spark)
    folder.stored(spark.range(1), "other")
    assert [f.count() for f in frames] == [1, 2, 3, 4, 5]


def test_tables_that_nothing_reads_are_deleted(spark):
    for i in range(4):
        folder.stored(spark.range(i), "dropped").count()
    collected(spark)
    kept = folder.stored(spark.range(7), "dropped")
    assert len(there(spark, "dropped")) <= 2 and kept.count() == 7


def test_block_deletes_its_folders(spark):
    with folder.scratch(spark):
        outer = folder.stored(spark.range(3), "outer")
        with folder.scratch(spark):
            assert folder.stored(spark.range(2), "inner").count() == 2 and len(there(spark, "inner")) == 1
        assert not there(spark, "inner") and outer.count() == 3
    assert not there(spark, "outer")


def session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)), sparkContext=SimpleNamespace(master=master))


def test_a_local_warehouse_is_no_shared_folder():
    local, shared = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}, {"spark.sql.warehouse.dir": "hdfs://lake/warehouse"}
    assert folder.scratch_path(session("local[8]", **local), "x").startswith("file:/tmp/warehouse/parcelflow/x-")
    assert folder.scratch_path(session("yarn", **shared), "x").startswith("hdfs://lake/")
    assert folder.scratch_path(session("yarn", **local, **{"spark.checkpoint.dir": "hdfs://lake/shared/"}), "x").startswith("hdfs://lake/shared/parcelflow/")
    with pytest.raises(ValueError, match="shared folder"):
        folder.scratch_path(session("spark://host:7077", **local), "x")
