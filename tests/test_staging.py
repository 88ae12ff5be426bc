from datetime import date
from decimal import Decimal

import pytest

from frames import ts, values
from parcelflow.operators import staging
from parcelflow.sources import schemas


@pytest.fixture
def bronze(spark):
    def order(i, bought, arrived, promised, customer="c1"):
        return (i, customer, "delivered", ts(bought), None, None, ts(arrived), ts(promised))

    orders = [
        order("on_time", "2020-01-01 10:00:00", "2020-01-06 01:00:00", "2020-01-09"),
        order("late", "2020-01-01 23:00:00", "2020-01-07 01:00:00", "2020-01-05", "nobody"),
        order("open", "2020-01-01", None, "2020-01-05"),
        order("unassigned", "2020-01-01", "2020-01-02", "2020-01-05"),
        order("no_target", "2020-01-01", "2020-01-20", "2020-01-05"),
    ]
    assigned = ("on_time", "late", "open", "no_target")
    return {
        "orders": spark.createDataFrame(orders, schemas.RAW_ORDERS),
        "customers": spark.createDataFrame([("c1", "SP")], schemas.RAW_CUSTOMERS),
        "warehouse_assignments": spark.createDataFrame([(i, "W", "Warehouse", "SP") for i in assigned], schemas.RAW_WAREHOUSE_ASSIGNMENTS),
        "carrier_assignments": spark.createDataFrame([(i, "C", "Carrier") for i in assigned], schemas.RAW_CARRIER_ASSIGNMENTS),
        "sla_targets": spark.createDataFrame([(i, "cat", "standard", None if i == "no_target" else 5) for i in assigned], schemas.RAW_SLA_TARGETS),
    }


def test_stg_orders_keeps_every_order(bronze):
    sla = bronze.pop("sla_targets")
    assert sla is not None
    found = staging.stg_orders(**bronze)
    assert len(found.columns) == 13
    assert values(found, "order_id", "customer_state", "warehouse_id") == [
        ("late", None, "W"), ("no_target", "SP", "W"), ("on_time", "SP", "W"), ("open", "SP", "W"), ("unassigned", "SP", None),
    ]


def test_stg_shipments_measures(bronze):
    found = staging.stg_shipments(**bronze)
    assert tuple(found.columns) == staging.SHIPMENT_COLUMNS
    assert values(found, "shipment_id", "actual_delivery_days", "delay_days", "sla_breach_flag", "real_late_delivery_flag") == [
        ("ship_late", 6, 2, True, True), ("ship_no_target", 19, 15, False, True), ("ship_on_time", 5, 0, False, False),
    ]
    assert found.where("order_id = 'on_time'").first().order_purchase_date == date(2020, 1, 1)


def test_stg_issues(spark):
    flags = spark.createDataFrame([("1", "damaged", "x", Decimal("0.1"), "A"), ("2", "none", "none", Decimal("0.2"), "none"), ("3", None, None, None, None), ("4", "lost", "x", None, "none")], schemas.RAW_ISSUE_FLAGS)
    assert values(staging.stg_issues(flags), "order_id", "quality_issue_flag") == [("1", True), ("2", False), ("3", False), ("4", False)]


def test_fact_keeps_shipments_without_issue(spark, bronze):
    issues = staging.stg_issues(spark.createDataFrame([("late", "wrong", "x", Decimal("0.1"), "A")], schemas.RAW_ISSUE_FLAGS))
    found = staging.fct_shipments(staging.stg_shipments(**bronze), bronze["sla_targets"], issues)
    assert tuple(found.columns) == staging.FACT_COLUMNS
    assert values(found, "order_id", "category_name", "issue_type") == [("late", "cat", "wrong"), ("no_target", "cat", None), ("on_time", "cat", None)]
