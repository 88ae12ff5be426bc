"""Explicit schemas of the source, config and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(6,4)": T.DecimalType(6, 4),
}


def _schema(columns: str) -> T.StructType:
    """A schema from `name type` pairs. Unlike `StructType.fromDDL` it needs no running session."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_ORDERS = _schema(
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,"
    " order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz,"
    " order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
RAW_ORDER_ITEMS = _schema("order_id string, product_id string")
RAW_PRODUCTS = _schema("product_id string, product_category_name string")
RAW_CUSTOMERS = _schema("customer_id string, customer_state string")
RAW_REVIEWS = _schema("order_id string, review_score int")
RAW_PAYMENTS = _schema("order_id string, payment_value double")
RAW_SELLERS = _schema("seller_id string, seller_state string")
RAW_GEOLOCATION = _schema("geolocation_state string, geolocation_region string")
RAW_WAREHOUSE_ASSIGNMENTS = _schema(
    "order_id string, warehouse_id string, warehouse_name string, customer_state string"
)
RAW_CARRIER_ASSIGNMENTS = _schema("order_id string, carrier_id string, carrier_name string")
RAW_SLA_TARGETS = _schema("order_id string, category_name string, sla_tier string, sla_target_days int")
RAW_ISSUE_FLAGS = _schema(
    "order_id string, issue_type string, issue_source string,"
    " synthetic_issue_probability decimal(6,4), anomaly_flag string"
)

SOURCE_TABLES = {
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_products": RAW_PRODUCTS,
    "raw_customers": RAW_CUSTOMERS,
    "raw_reviews": RAW_REVIEWS,
    "raw_payments": RAW_PAYMENTS,
    "raw_sellers": RAW_SELLERS,
    "raw_geolocation": RAW_GEOLOCATION,
}
ASSIGNMENT_TABLES = {
    "raw_warehouse_assignments": RAW_WAREHOUSE_ASSIGNMENTS,
    "raw_carrier_assignments": RAW_CARRIER_ASSIGNMENTS,
    "raw_sla_targets": RAW_SLA_TARGETS,
    "raw_issue_flags": RAW_ISSUE_FLAGS,
}
BRONZE_TABLES = {**SOURCE_TABLES, **ASSIGNMENT_TABLES}

WAREHOUSES = _schema(
    "warehouse_id string, warehouse_name string, assigned_states string, region_rule_notes string"
)
CARRIERS = _schema(
    "carrier_id string, carrier_name string, reliability_tier string, performance_notes string,"
    " warehouse_exception string"
)
SLA_TARGET_CONFIG = _schema("sla_tier string, target_days int, description string")
ANOMALY_WINDOWS = _schema(
    "anomaly_id string, anomaly_type string, affected_carrier_id string, affected_warehouse_id string,"
    " issue_type string, start_date date, end_date date, notes string"
)
CONFIG_TABLES = {
    "warehouses": WAREHOUSES,
    "carriers": CARRIERS,
    "sla_targets": SLA_TARGET_CONFIG,
    "anomaly_windows": ANOMALY_WINDOWS,
}

ANOMALY_RESULTS = _schema(
    "detection_metric string, week_start_date date, warehouse_id string, warehouse_name string,"
    " carrier_id string, carrier_name string, shipment_count bigint, sla_breach_count bigint,"
    " damaged_issue_count bigint, sla_breach_rate double, damaged_issue_rate double,"
    " trailing_4_week_mean double, trailing_4_week_std double, z_score double,"
    " anomaly_detected boolean, known_anomaly_count bigint, known_anomaly_labels string"
)
ANOMALY_SUMMARY = _schema(
    "anomaly_id string, validation_metric string, detected boolean, first_detected_week date,"
    " flagged_segment_weeks bigint, top_flagged_segments string"
)
