"""Staging models over the bronze tables, and the shipment fact.

The join forms take the assignment tables one by one, `assigned_orders` merges them first. `orders_of`, `shipments_of` and `fact_of` give the
same rows from the wide enriched orders, with one join by order id for the first and none for the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.scalars import days_between

# Names and order of the columns of the three tables.
ORDER_COLUMNS = (
    "order_id", "customer_id", "customer_state", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date", "warehouse_id",
    "warehouse_name", "carrier_id", "carrier_name",
)
SHIPMENT_COLUMNS = (
    "shipment_id", "order_id", "warehouse_id", "carrier_id", "customer_state", "order_purchase_date",
    "delivered_customer_date", "estimated_delivery_date", "actual_delivery_days", "estimated_delivery_days",
    "sla_target_days", "delay_days", "sla_breach_flag", "real_late_delivery_flag",
)
FACT_COLUMNS = (
    "shipment_id", "order_id", "warehouse_id", "carrier_id", "category_name", "sla_tier", "order_purchase_date",
    "delivered_customer_date", "estimated_delivery_date", "actual_delivery_days", "estimated_delivery_days",
    "sla_target_days", "delay_days", "sla_breach_flag", "real_late_delivery_flag", "issue_type",
    "quality_issue_flag", "anomaly_flag",
)


def stg_orders(orders: DataFrame, customers: DataFrame, warehouse_assignments: DataFrame, carrier_assignments: DataFrame) -> DataFrame:
    """Every order with its customer's state and, where assigned, its warehouse and carrier."""
    return (
        orders.join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .join(warehouse_assignments.select("order_id", "warehouse_id", "warehouse_name"), "order_id", "left")
        .join(carrier_assignments.select("order_id", "carrier_id", "carrier_name"), "order_id", "left")
        .select(*ORDER_COLUMNS)
    )


def orders_of(orders: DataFrame, customers: DataFrame, enriched: DataFrame) -> DataFrame:
    """`stg_orders` with the assignments of the wide enriched orders: one join by order id instead of two."""
    assigned = enriched.select("order_id", "warehouse_id", "warehouse_name", "carrier_id", "carrier_name")
    return (
        orders.join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .join(assigned, "order_id", "left")
        .select(*ORDER_COLUMNS)
    )


#: Columns that each assignment table gives to an order.
ASSIGNED = {
    "raw_warehouse_assignments": ("warehouse_id", "warehouse_name"),
    "raw_carrier_assignments": ("carrier_id", "carrier_name"),
    "raw_sla_targets": ("category_name", "sla_tier", "sla_target_days"),
    "raw_issue_flags": ("issue_type", "issue_source", "synthetic_issue_probability", "anomaly_flag"),
}


def merged_assignments(assignments: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order id of the given assignment tables: `order_id`, all their columns, and per table `has_<table>`.

    One union and one shuffle for any number of tables instead of a join for each; rows are combined before it. An order that
    a table lists more than once counts once, with its greatest row (the `unique` check tells of it).
    """
    united = None
    for name, df in assignments.items():
        row = df.where(F.col("order_id").isNotNull()).select("order_id", F.struct(*(F.col(c) for c in ASSIGNED[name])).alias(name))
        united = row if united is None else united.unionByName(row, allowMissingColumns=True)
    rows = united.groupBy("order_id").agg(*(F.max(name).alias(name) for name in assignments))
    columns = [F.col(f"{name}.{c}").alias(c) for name in assignments for c in ASSIGNED[name]]
    return rows.select("order_id", *columns, *(F.col(name).isNotNull().alias(f"has_{name}") for name in assignments))


def assigned_orders(orders: DataFrame, customers: DataFrame, assignments: Mapping[str, DataFrame], needed: Iterable[str] = tuple(ASSIGNED)) -> DataFrame:
    """The wide orders from given assignments: those that all tables in `needed` list, with the customer's state. One join by order id."""
    merged = merged_assignments(assignments)
    for name in needed:
        merged = merged.where(f"has_{name}")
    kept = merged.drop(*(f"has_{name}" for name in assignments))
    return orders.join(customers.select("customer_id", "customer_state"), "customer_id", "left").join(kept, "order_id")


def _is_delivered() -> Column:
    return (
        F.col("order_purchase_timestamp").isNotNull()
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )


def _with_delivery_measures(delivered: DataFrame) -> DataFrame:
    """Dates, day counts and flags of delivered orders; a comparison with NULL is no breach."""
    dated = delivered.withColumns(
        {
            "shipment_id": F.concat(F.lit("ship_"), "order_id"),
            "order_purchase_date": F.col("order_purchase_timestamp").cast("date"),
            "delivered_customer_date": F.col("order_delivered_customer_date").cast("date"),
            "estimated_delivery_date": F.col("order_estimated_delivery_date").cast("date"),
            "sla_target_days": F.col("sla_target_days").cast("int"),
        }
    )
    bought, arrived, promised = F.col("order_purchase_date"), F.col("delivered_customer_date"), F.col("estimated_delivery_date")
    measured = dated.withColumns(
        {
            "actual_delivery_days": days_between(bought, arrived),
            "estimated_delivery_days": days_between(bought, promised),
            "delay_days": F.greatest(days_between(promised, arrived), F.lit(0)),
            "real_late_delivery_flag": F.coalesce(arrived > promised, F.lit(False)),
        }
    )
    return measured.withColumn(
        "sla_breach_flag", F.coalesce(F.col("actual_delivery_days") > F.col("sla_target_days"), F.lit(False))
    )


def stg_shipments(
    orders: DataFrame,
    customers: DataFrame,
    warehouse_assignments: DataFrame,
    carrier_assignments: DataFrame,
    sla_targets: DataFrame,
) -> DataFrame:
    """Delivered orders that have a warehouse, a carrier and an SLA target."""
    joined = (
        orders.where(_is_delivered())
        .join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .join(warehouse_assignments.select("order_id", "warehouse_id"), "order_id")
        .join(carrier_assignments.select("order_id", "carrier_id"), "order_id")
        .join(sla_targets.select("order_id", "sla_target_days"), "order_id")
    )
    return _with_delivery_measures(joined).select(*SHIPMENT_COLUMNS)


def quality_issue(issue_type: Column) -> Column:
    return F.coalesce(issue_type.isin(*config.QUALITY_ISSUE_TYPES), F.lit(False))


def stg_issues(issue_flags: DataFrame) -> DataFrame:
    return issue_flags.select(
        "order_id",
        "issue_type",
        "issue_source",
        F.col("synthetic_issue_probability").cast("decimal(6,4)").alias("synthetic_issue_probability"),
        "anomaly_flag",
        quality_issue(F.col("issue_type")).alias("quality_issue_flag"),
    )


def fct_shipments(shipments: DataFrame, sla_targets: DataFrame, issues: DataFrame) -> DataFrame:
    """Shipments with category, tier and issue; all three inputs are keyed by order id."""
    return (
        shipments.join(sla_targets.select("order_id", "category_name", "sla_tier"), "order_id", "left")
        .join(issues.select("order_id", "issue_type", "quality_issue_flag", "anomaly_flag"), "order_id", "left")
        .select(*FACT_COLUMNS)
    )


def shipments_of(enriched: DataFrame) -> DataFrame:
    """`stg_shipments` straight from the wide enriched orders."""
    return _with_delivery_measures(enriched.where(_is_delivered())).select(*SHIPMENT_COLUMNS)


def fact_of(enriched: DataFrame) -> DataFrame:
    """`fct_shipments` straight from the wide enriched orders."""
    measured = _with_delivery_measures(enriched.where(_is_delivered()))
    return measured.withColumn("quality_issue_flag", quality_issue(F.col("issue_type"))).select(*FACT_COLUMNS)
