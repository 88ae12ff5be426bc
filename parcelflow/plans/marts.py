"""Dimensions and aggregate marts over the shipment fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scalars import day_of_week, percentage, round_scaled, week_start

WEEKLY_KEYS = ("week_start_date", "warehouse_id", "carrier_id", "category_name", "issue_type")


def dim_warehouse(warehouse_assignments: DataFrame) -> DataFrame:
    return warehouse_assignments.where(F.col("warehouse_id").isNotNull()).select("warehouse_id", "warehouse_name").distinct()


def dim_carrier(carrier_assignments: DataFrame) -> DataFrame:
    return carrier_assignments.where(F.col("carrier_id").isNotNull()).select("carrier_id", "carrier_name").distinct()


def dim_category(sla_targets: DataFrame) -> DataFrame:
    return (
        sla_targets.where(F.col("category_name").isNotNull())
        .select("category_name", "sla_tier", F.col("sla_target_days").cast("int").alias("sla_target_days"))
        .distinct()
    )


def dim_date(shipments: DataFrame) -> DataFrame:
    """One row per day from the first to the last purchase date."""
    bounds = shipments.agg(F.min("order_purchase_date").alias("first_day"), F.max("order_purchase_date").alias("last_day"))
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_day"))
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.date_format("date_day", "yyyy-MM").alias("year_month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        day_of_week(F.col("date_day")).alias("day_of_week"),
    )


def agg_daily_sla(fact: DataFrame) -> DataFrame:
    """Shipments, breaches, attainment and delay per day, warehouse, carrier and tier."""
    breached = F.col("sla_breach_flag")
    counts = fact.groupBy("order_purchase_date", "warehouse_id", "carrier_id", "sla_tier").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        F.count_if(breached).alias("sla_breach_count"),
        F.count_if(~breached).alias("on_time_count"),
        F.avg("delay_days").alias("mean_delay"),
        F.count_if("real_late_delivery_flag").alias("real_late_delivery_count"),
    )
    return counts.select(
        "order_purchase_date", "warehouse_id", "carrier_id", "sla_tier", "shipment_count", "sla_breach_count",
        "on_time_count",
        percentage(F.col("on_time_count"), F.col("shipment_count")).alias("sla_attainment_pct"),
        round_scaled(F.col("mean_delay"), 2).alias("avg_delay_days"),
        "real_late_delivery_count",
    )


def weekly_flag_counts(fact: DataFrame) -> DataFrame:
    """Shipments and issues per weekly key and anomaly flag: the only pass over the fact for the weekly mart."""
    return (
        fact.withColumn("week_start_date", week_start(F.col("order_purchase_date")))
        .groupBy(*WEEKLY_KEYS, "anomaly_flag")
        .agg(F.count(F.lit(1)).alias("shipments"), F.count_if("quality_issue_flag").alias("issues"))
    )


def _keys_known():
    known = F.lit(True)
    for key in WEEKLY_KEYS:
        known = known & F.col(key).isNotNull()
    return known


def weekly_dominant_flag(flag_counts: DataFrame) -> DataFrame:
    """Most frequent known flag per weekly key, ties by name."""
    ranked = F.when(F.col("anomaly_flag") != "none", F.struct((-F.col("shipments")).alias("order"), "anomaly_flag", "shipments"))
    best = flag_counts.groupBy(*WEEKLY_KEYS).agg(F.min(ranked).alias("best")).where(F.col("best").isNotNull())
    return best.select(*WEEKLY_KEYS, F.col("best.anomaly_flag").alias("anomaly_flag"), F.col("best.shipments").alias("anomaly_flag_count"))


def agg_weekly_quality(flag_counts: DataFrame) -> DataFrame:
    """Weekly quality by segment with the dominant flag, both from the same counts.

    A key with a NULL part keeps the flag `none`, as an equality join on the key would leave it.
    """
    flagged = F.col("anomaly_flag") != "none"
    ranked = F.when(flagged, F.struct((-F.col("shipments")).alias("order"), "anomaly_flag"))
    totals = flag_counts.groupBy(*WEEKLY_KEYS).agg(
        F.sum("shipments").alias("shipment_count"),
        F.sum("issues").alias("issue_count"),
        F.sum(F.when(flagged, F.col("shipments")).otherwise(0)).alias("anomaly_count"),
        F.min(ranked).alias("best"),
    )
    return totals.select(
        *WEEKLY_KEYS,
        "shipment_count",
        "issue_count",
        percentage(F.col("issue_count"), F.col("shipment_count")).alias("issue_rate_pct"),
        "anomaly_count",
        F.coalesce(F.when(_keys_known(), F.col("best.anomaly_flag")), F.lit("none")).alias("dominant_anomaly_flag"),
    )


def weekly_quality_base(fact: DataFrame) -> DataFrame:
    """The weekly quality counts without the dominant flag, by direct aggregation."""
    return (
        fact.withColumn("week_start_date", week_start(F.col("order_purchase_date")))
        .groupBy(*WEEKLY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("shipment_count"),
            F.count_if("quality_issue_flag").alias("issue_count"),
            F.count_if(F.col("anomaly_flag") != "none").alias("anomaly_count"),
        )
        .withColumn("issue_rate_pct", percentage(F.col("issue_count"), F.col("shipment_count")))
    )
