from pathlib import Path

import pytest

from frames import ts, values
from parcelflow import config
from parcelflow.functions.lookups import unique_lookup
from parcelflow.functions.scratch import scratch_path
from parcelflow.operators import quality
from parcelflow.sources import schemas, tables


def test_csv_scan_types_blanks_and_quotes(spark, tmp_path):
    (tmp_path / "products.csv").write_text('product_id,product_category_name\n01001,"a ""quoted"", name"\n2,""\n3,\n')
    df = tables.read_csv(spark, str(tmp_path / "products.csv"), schemas.RAW_PRODUCTS)
    assert values(df) == [("01001", 'a "quoted", name'), ("2", None), ("3", None)]


def test_csv_scan_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('order_id,review_score\n"a\nb",3\n')
    assert values(tables.read_csv(spark, str(tmp_path / "r.csv"), schemas.RAW_REVIEWS, multi_line=True)) == [("a\nb", 3)]


def test_csv_scan_rejects_other_header_and_bad_values(spark, tmp_path):
    (tmp_path / "h.csv").write_text("order_id,stars\n1,3\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "h.csv"), schemas.RAW_REVIEWS).collect()
    (tmp_path / "v.csv").write_text("order_id,review_score\n1,many\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "v.csv"), schemas.RAW_REVIEWS).collect()


def test_csv_scan_keeps_further_columns(spark, tmp_path):
    (tmp_path / "items.csv").write_text("seller_id,order_item_id,product_id,order_id,price,freight_value,limit\ns,1,p,o,9.5,,x\n")
    df = tables.read_csv(spark, str(tmp_path / "items.csv"), schemas.RAW_ORDER_ITEMS)
    assert df.columns == ["seller_id", "order_item_id", "product_id", "order_id", "price", "freight_value", "limit"]
    assert values(df) == [("s", "1", "p", "o", "9.5", None, "x")]
    (tmp_path / "customers.csv").write_text("customer_city,customer_state,x,customer_id,y\na,SP,1,c,2\n")
    tables.load_bronze(spark, {"raw_customers": str(tmp_path / "customers.csv")}, str(tmp_path / "bronze"))
    assert tables.read_tables(spark, str(tmp_path / "bronze"), ["raw_customers"])["raw_customers"].count() == 1


def test_csv_scan_infers_without_a_schema(spark, tmp_path):
    (tmp_path / "i.csv").write_text("a,b\n1,x\n2,\n")
    df = tables.read_csv(spark, str(tmp_path / "i.csv"))
    assert df.dtypes == [("a", "int"), ("b", "string")] and values(df) == [(1, "x"), (2, None)]


def test_csv_round_trip_counts_rows(spark, tmp_path):
    rows = [("1", "c", "delivered", ts("2020-01-01 10:00:00"), None, None, None, ts("2020-01-05 00:00:00"))]
    df = spark.createDataFrame(rows, schemas.RAW_ORDERS)
    assert tables.write_csv(df, str(tmp_path / "out")) == 1
    assert values(tables.read_csv(spark, str(tmp_path / "out"), schemas.RAW_ORDERS)) == rows


def test_sorted_parts_and_single_file(spark, tmp_path):
    df = spark.range(1000).repartition(8).orderBy("id")
    assert tables.write_csv(df, str(tmp_path / "many")) == 1000
    lines = [line for part in sorted(Path(tmp_path / "many").glob("part-*")) for line in part.read_text().splitlines() if line != "id"]
    assert lines == [str(i) for i in range(1000)]
    tables.write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list(Path(tmp_path / "one").glob("part-*"))) == 1


def test_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(5), path) == 5
    assert tables.write_table(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_empty_tables_are_written_and_counted(spark, tmp_path):
    nothing = spark.range(10).where("id < 0")
    grouped = nothing.groupBy("id").count().join(spark.range(3), "id")
    assert tables.write_table(nothing, str(tmp_path / "a")) == 0
    assert tables.write_table(grouped, str(tmp_path / "b")) == 0
    assert tables.write_csv(grouped.orderBy("id"), str(tmp_path / "c"), single_file=True) == 0
    assert spark.read.parquet(str(tmp_path / "b")).count() == 0


def test_partitioned_table_has_few_files(spark, tmp_path):
    df = spark.range(1000, numPartitions=8).selectExpr("id", "id % 3 as part")
    assert tables.write_table(df, str(tmp_path / "p"), ("part",)) == 1000
    assert len(list(Path(tmp_path / "p").glob("part=*/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000


def test_bronze_load_counts(spark, tmp_path):
    (tmp_path / "items.csv").write_text("order_id,product_id\n1,p\n1,q\n")
    (tmp_path / "reviews.csv").write_text("order_id,review_score\n1,5\n")
    counts = tables.load_bronze(
        spark, {"raw_order_items": str(tmp_path / "items.csv"), "raw_reviews": str(tmp_path / "reviews.csv")}, str(tmp_path / "bronze")
    )
    assert values(counts) == [("raw_order_items", 2), ("raw_reviews", 1)]
    loaded = tables.read_tables(spark, str(tmp_path / "bronze"), ("raw_order_items", "raw_reviews"))
    assert values(tables.row_counts(loaded)) == values(counts)


def test_config_round_trip(spark, tmp_path):
    frames = {"warehouses": config.warehouses_df(spark), "carriers": config.carriers_df(spark), "sla_targets": config.sla_targets_df(spark), "anomaly_windows": config.windows_df(spark)}
    for name, df in frames.items():
        tables.write_csv(df, str(tmp_path / f"{name}.csv"), single_file=True)
    read = tables.read_config(spark, str(tmp_path))
    assert quality.config_faults(read, schemas.CONFIG_TABLES, config.CONFIG_ROWS).count() == 0
    assert config.carriers_from(read["carriers"]) == config.CARRIERS
    assert config.sla_targets_from(read["sla_targets"]) == config.SLA_TARGETS
    assert config.windows_from(read["anomaly_windows"]) == config.ANOMALY_WINDOWS


def test_lookups(spark):
    repeated = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "k string, v string")
    assert values(unique_lookup(repeated, "k", "v")) == [("a", "2")]


def test_scratch_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")
