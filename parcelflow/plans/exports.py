"""Dashboard exports: facts and marts with their warehouse and carrier names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelflow.sources import schemas
from parcelflow.sources.tables import read_csv, write_csv

# Column names and sort keys that consumers of the exports rely on.
SHIPMENT_EXPORT = (
    "shipment_id", "order_id", "order_purchase_date", "delivered_customer_date", "estimated_delivery_date", "warehouse_id",
    "warehouse_name", "carrier_id", "carrier_name", "category_name", "sla_tier", "actual_delivery_days",
    "estimated_delivery_days", "sla_target_days", "delay_days", "sla_breach_flag", "real_late_delivery_flag", "issue_type",
    "quality_issue_flag", "anomaly_flag",
)
DAILY_EXPORT = (
    "order_purchase_date", "warehouse_id", "warehouse_name", "carrier_id", "carrier_name", "sla_tier", "shipment_count",
    "sla_breach_count", "on_time_count", "sla_attainment_pct", "avg_delay_days", "real_late_delivery_count",
)
WEEKLY_EXPORT = (
    "week_start_date", "warehouse_id", "warehouse_name", "carrier_id", "carrier_name", "category_name", "issue_type",
    "shipment_count", "issue_count", "issue_rate_pct", "anomaly_count", "dominant_anomaly_flag",
)


def _named(df: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame, columns) -> DataFrame:
    return df.join(dim_warehouse, "warehouse_id", "left").join(dim_carrier, "carrier_id", "left").select(*columns)


def shipments(fact: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    """The fact with names. Dimensions are written or in-memory tables, so Spark knows their size."""
    return _named(fact, dim_warehouse, dim_carrier, SHIPMENT_EXPORT)


def daily_sla(daily: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    return _named(daily, dim_warehouse, dim_carrier, DAILY_EXPORT)


def weekly_quality(weekly: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    return _named(weekly, dim_warehouse, dim_carrier, WEEKLY_EXPORT)


# See above.
EXPORT_ORDER = {
    "fct_shipments_dashboard": ("order_purchase_date", "shipment_id"),
    "daily_sla_performance": ("order_purchase_date", "warehouse_id", "carrier_id", "sla_tier"),
    "weekly_quality_by_segment": ("week_start_date", "warehouse_id", "carrier_id", "category_name", "issue_type"),
}


def export_sorted(df: DataFrame, name: str, folder: str) -> int:
    """Write one export as CSV in its order; returns the number of rows. The parts are in order too."""
    return write_csv(df.orderBy(*EXPORT_ORDER[name]), f"{folder}/{name}")


def export_summary(summary: DataFrame, folder: str) -> DataFrame:
    """Write the label summary as CSV and read it back with its types."""
    path = f"{folder}/anomaly_summary"
    write_csv(summary, path, single_file=True)
    return read_csv(summary.sparkSession, path, schemas.ANOMALY_SUMMARY)
