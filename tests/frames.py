"""Small hand-made frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

FACT_SCHEMA = (
    "shipment_id string, order_id string, warehouse_id string, carrier_id string, category_name string, sla_tier string,"
    " order_purchase_date date, delivered_customer_date date, estimated_delivery_date date, actual_delivery_days int,"
    " estimated_delivery_days int, sla_target_days int, delay_days int, sla_breach_flag boolean,"
    " real_late_delivery_flag boolean, issue_type string, quality_issue_flag boolean, anomaly_flag string"
)


def shipment(number, day, warehouse="W", carrier="C", breach=False, issue="none", flag="none", category="x", tier="fast", delay=0):
    return (
        f"ship_{number}", str(number), warehouse, carrier, category, tier, day, day + timedelta(days=3), day + timedelta(days=5),
        3, 5, 5, delay, breach, delay > 0, issue, issue not in ("none", None), flag,
    )


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def segment_weeks(spark, weeks, warehouse="W", carrier="C", flags=None):
    """A fact from `(monday, shipments, breaches, damages)` rows."""
    rows, number = [], 0
    for monday, shipments, breaches, damages in weeks:
        for i in range(shipments):
            number += 1
            flag = (flags or {}).get(monday, "none")
            rows.append(
                shipment(f"{warehouse}{carrier}{number}", monday + timedelta(days=i % 7), warehouse, carrier, i < breaches,
                         "damaged" if i < damages else "none", flag)
            )
    return fact(spark, rows)


def mondays(n, start=date(2024, 1, 1)):
    return [start + timedelta(weeks=i) for i in range(n)]


def names(spark, warehouse="W", carrier="C"):
    return (
        spark.createDataFrame([(warehouse, "Warehouse")], "warehouse_id string, warehouse_name string"),
        spark.createDataFrame([(carrier, "Carrier")], "carrier_id string, carrier_name string"),
    )


def values(df, *columns):
    """Sorted tuples of some columns, or of all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def ts(text):
    return datetime.fromisoformat(text) if text else None
