from datetime import date

from frames import fact, shipment, values
from parcelflow import config
from parcelflow.operators import quality
from parcelflow.sources import schemas


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_null_counts(spark):
    df = frame(spark, [(None, 1), ("a", 2), (None, 3)], "k string, n int")
    assert values(quality.null_counts(df, ("k", "n"))) == [("k", 2)]


def test_duplicates_ignore_nulls(spark):
    df = frame(spark, [("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert values(quality.duplicates(df, "k")) == [("a", 2)]


def test_orphans(spark):
    child, parent = frame(spark, [("a",), ("x",), ("x",), (None,)], "k string"), frame(spark, [("a",), ("b",)], "p string")
    assert values(quality.orphans(child, "k", parent, "p")) == [("x", 2)]


def test_values(spark):
    df = frame(spark, [("lost",), ("none",), (None,)], "v string")
    assert values(quality.unaccepted_values(df, "v", config.ISSUE_TYPES)) == [("lost", 1)]
    assert values(quality.missing_values(df, "v", ("none", "damaged"))) == [("damaged",)]
    assert values(quality.value_counts(df, "v")) == [(None, 1), ("lost", 1), ("none", 1)]


def test_date_order(spark):
    day = date(2024, 1, 10)
    ddl = "shipment_id string, order_id string, order_purchase_date date, delivered_customer_date date, estimated_delivery_date date"
    rows = [("good", "1", day, day, day), ("early", "2", day, date(2024, 1, 9), day), ("open", "3", day, None, day), ("promised", "4", day, None, date(2024, 1, 9))]
    assert values(quality.bad_date_order(frame(spark, rows, ddl)), "shipment_id") == [("early",), ("promised",)]


def test_blank_keys(spark):
    tables = {"good": frame(spark, [("a",)], "k string"), "bad": frame(spark, [("a",), (" ",), (None,)], "k string")}
    assert values(quality.blank_keys(tables, "k")) == [("bad", 2)]


def test_counts(spark):
    counts = frame(spark, [("orders", 10), ("items", 9), ("flags", 10), ("empty", 0)], "table_name string, row_count bigint")
    expected = frame(spark, [(10,)], "expected_rows bigint")
    assert values(quality.empty_tables(counts)) == [("empty", 0)]
    found = quality.unexpected_counts(counts, expected, exact=("items", "flags"), larger=("orders",))
    assert values(found) == [("items", 9, 10), ("orders", 10, 10)]


def test_missed_labels(spark):
    metrics = frame(spark, [("A", "m1"), ("B", "m1"), ("C", "m1"), ("D", "m1")], "anomaly_id string, validation_metric string")
    summary = frame(spark, [("A", "m1", True), ("B", "m2", True), ("C", "m1", False)], "anomaly_id string, validation_metric string, detected boolean")
    assert values(quality.missed_labels(summary, metrics)) == [("B", "m1", "m2", True), ("C", "m1", "m1", False), ("D", "m1", None, False)]


def test_config_structure(spark):
    frames = {
        "warehouses": config.warehouses_df(spark), "carriers": config.carriers_df(spark).drop("warehouse_exception"),
        "sla_targets": config.sla_targets_df(spark).limit(2),
    }
    faults = quality.config_faults(frames, schemas.CONFIG_TABLES, config.CONFIG_ROWS).collect()
    assert {tuple(f) for f in faults if f.table_name != "anomaly_windows"} == {
        ("carriers", "warehouse_exception", "absent column", 1, 0), ("sla_targets", None, "row count", 3, 2),
    }
    assert {f.fault for f in faults if f.table_name == "anomaly_windows"} == {"absent column", "absent table"}


def test_catalog_and_columns(spark):
    spark.range(1).createOrReplaceTempView("raw_orders")
    assert quality.missing_tables(spark, ("raw_orders", "raw_nothing")) == {"raw_nothing"}
    assert quality.missing_columns(spark.range(1), ("id", "other")) == {"other"}


def test_suite_finds_each_fault(spark):
    day = date(2024, 1, 10)
    bad = fact(spark, [shipment(1, day), shipment(1, day, issue="lost"), shipment(None, day, warehouse="nowhere")])
    bad = bad.withColumn("shipment_id", bad.order_id)
    dim = frame(spark, [("W",)], "warehouse_id string")
    checks = {
        "fact": quality.TableChecks(
            not_null=("shipment_id", "carrier_id"), unique=("order_id",), accepted={"issue_type": config.ISSUE_TYPES},
            relationships=(("warehouse_id", "dim", "warehouse_id"),), date_order=True,
        )
    }
    report = quality.suite_report({"fact": bad.replace("None", None), "dim": dim}, checks)
    assert values(report, "check_name", "column_name", "violations", "status") == [
        ("accepted_values", "issue_type", 1, "fail"), ("date_order", "order_purchase_date", 0, "pass"), ("not_null", "carrier_id", 0, "pass"),
        ("not_null", "shipment_id", 1, "fail"), ("relationships", "warehouse_id", 1, "fail"), ("unique", "order_id", 1, "fail"),
    ]
