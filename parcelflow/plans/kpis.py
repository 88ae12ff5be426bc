"""Dashboard queries over the exported tables.

`daily`, `weekly` and `fact` are the exports with names (`plans.exports`). Functions that end a worksheet
return its rows; averages and ratios are rounded to four digits. Worksheets that average or sum
percentages do so here too; the ratio-of-sums form stands beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.scalars import fixed_bin, rate, round_scaled, week_start



def filtered(df: DataFrame, date_column: str | None = None, date_from=None, date_to=None, **members) -> DataFrame:
    """Dashboard filters: a date range and, per column, a value or a list of values."""
    if date_column and date_from is not None:
        df = df.where(F.col(date_column) >= F.lit(date_from))
    if date_column and date_to is not None:
        df = df.where(F.col(date_column) <= F.lit(date_to))
    for column, values in members.items():
        if values is not None:
            df = df.where(F.col(column).isin(values if isinstance(values, (list, tuple, set)) else [values]))
    return df


def anomaly_label(flag: Column) -> Column:
    return F.when(flag == "none", "No injected anomaly").otherwise(flag)


def _ratio(part: Column, whole: Column) -> Column:
    return round_scaled(rate(part, whole), 4)


def _exact_sum(value: Column | str) -> Column:
    """Sum of values with two decimals, in decimals: the same whatever the order of the rows."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value.cast("decimal(18,2)")).cast("double")


def _exact_mean(value: str) -> Column:
    return round_scaled(_exact_sum(value) / F.count(value), 4)


def _attainment() -> Column:
    return _ratio(F.sum("on_time_count"), F.sum("shipment_count"))


def _issue_rate() -> Column:
    return _ratio(F.sum("issue_count"), F.sum("shipment_count"))


def distinct_shipments(unique: bool = False) -> Column:
    """Distinct shipments. With `unique` the ids are known to be unique and a plain count, which needs no
    shuffle of ids, gives the same."""
    return F.count("shipment_id") if unique else F.countDistinct("shipment_id")


# --- KPI cards -------------------------------------------------------------------------------------


def executive(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("shipment_count").alias("total_shipments"),
        _attainment().alias("sla_attainment"),
        F.sum("sla_breach_count").alias("sla_breach_count"),
        _exact_mean("avg_delay_days").alias("avg_delay_days"),
        F.sum("real_late_delivery_count").alias("real_late_delivery_count"),
    )


def ops(fact: DataFrame) -> DataFrame:
    whole = F.count("shipment_id")
    return fact.agg(
        whole.alias("shipment_count"),
        _ratio(F.count_if(~F.col("real_late_delivery_flag")), whole).alias("on_time_delivery"),
        _ratio(F.count_if("sla_breach_flag"), whole).alias("sla_breach_rate"),
        round_scaled(F.avg("delay_days"), 4).alias("avg_delay_days"),
        F.count_if("quality_issue_flag").alias("quality_issue_count"),
    )


def quality(weekly: DataFrame, summary: DataFrame) -> DataFrame:
    measures = ("shipment_count", "issue_count", "anomaly_count")
    nothing = F.lit(0).cast("long")
    weeks = weekly.select(*measures, nothing.alias("detected"))
    labels = summary.where("detected").select(*(nothing.alias(m) for m in measures), F.lit(1).cast("long").alias("detected"))
    return weeks.unionByName(labels).agg(
        F.sum("shipment_count").alias("shipment_count"),
        _issue_rate().alias("quality_issue_rate"),
        F.sum("issue_count").alias("issue_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
        F.sum("detected").alias("detected_known_anomalies"),
    )


# --- worksheets ------------------------------------------------------------------------------------


def avg_delay_by_carrier(daily: DataFrame) -> DataFrame:
    """Mean of the daily means, slowest carrier first."""
    by_pair = daily.groupBy("carrier_name", "warehouse_name").agg(
        _exact_sum("avg_delay_days").alias("delay_sum"), F.count("avg_delay_days").alias("delay_rows")
    )
    by_carrier = by_pair.groupBy("carrier_name").agg((F.sum("delay_sum") / F.sum("delay_rows")).alias("carrier_delay"))
    return (
        by_pair.join(by_carrier, "carrier_name")
        .orderBy(F.desc("carrier_delay"), "carrier_name", "warehouse_name")
        .select(
            "carrier_name",
            "warehouse_name",
            round_scaled(F.col("delay_sum") / F.col("delay_rows"), 4).alias("avg_delay_days"),
        )
    )


def damaged_spike(weekly: DataFrame, warehouse_name: str = "Southeast FC") -> DataFrame:
    kept = filtered(weekly, issue_type="damaged", warehouse_name=warehouse_name)
    return kept.groupBy(week_start(F.col("week_start_date")).alias("week_start_date"), "carrier_name").agg(
        round_scaled(_exact_sum("issue_rate_pct"), 4).alias("damaged_issue_signal")
    )


def delay_distribution(fact: DataFrame, unique: bool = False) -> DataFrame:
    return fact.groupBy(fixed_bin(F.col("delay_days"), 5).alias("delay_days_bin"), "warehouse_name").agg(
        distinct_shipments(unique).alias("shipments")
    )


def sla_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy(week_start(F.col("order_purchase_date")).alias("week_start_date"), "warehouse_name").agg(
        _exact_mean("sla_attainment_pct").alias("avg_sla_attainment_pct")
    )


def breach_by_category(fact: DataFrame, unique: bool = False) -> DataFrame:
    return fact.where("sla_breach_flag").groupBy("category_name", "sla_tier").agg(distinct_shipments(unique).alias("shipments"))


def breach_by_warehouse(daily: DataFrame) -> DataFrame:
    return daily.groupBy("warehouse_name", "carrier_name").agg(F.sum("sla_breach_count").alias("sla_breach_count"))


def breach_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy(week_start(F.col("order_purchase_date")).alias("week_start_date"), "warehouse_name").agg(
        F.sum("sla_breach_count").alias("sla_breach_count")
    )


def shipments_by_segment(fact: DataFrame, unique: bool = False, error: float | None = None) -> DataFrame:
    """Distinct shipments; with `error`, by a sketch of that relative standard error, without a shuffle of the ids."""
    shipments = distinct_shipments(unique) if error is None else F.approx_count_distinct("shipment_id", error)
    return fact.groupBy("warehouse_name", "carrier_name", "sla_breach_flag").agg(shipments.alias("shipments"))


# --- charts ----------------------------------------------------------------------------------------


def daily_attainment(daily: DataFrame) -> DataFrame:
    return daily.groupBy("order_purchase_date", "warehouse_name").agg(_attainment().alias("sla_attainment"))


def breaches_per_warehouse(daily: DataFrame) -> DataFrame:
    return daily.groupBy("warehouse_name").agg(F.sum("sla_breach_count").alias("sla_breach_count"))


def carrier_tier(daily: DataFrame) -> DataFrame:
    return daily.groupBy("carrier_name", "sla_tier").agg(_attainment().alias("sla_attainment"))


def daily_volume(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_purchase_date").agg(F.count("shipment_id").alias("shipments"))


def delay_bins(fact: DataFrame) -> DataFrame:
    return fact.groupBy(fixed_bin(F.col("delay_days"), 5).alias("delay_days_bin")).agg(F.count("shipment_id").alias("shipments"))


def _known_carriers(df: DataFrame, carrier_names, others: str | None = None) -> DataFrame:
    """`df` with every carrier outside `carrier_names`, or NULL, as `others`; without that name the job fails: a pivot would drop it without a word."""
    name = F.col("carrier_name")
    if others is not None:
        return df.withColumn("carrier_name", F.when(name.isin(list(carrier_names)), name).otherwise(F.lit(others)))
    unknown = F.raise_error(F.concat(F.lit("carrier outside the dimension: "), F.coalesce(name, F.lit("NULL")))).cast("string")
    return df.withColumn("carrier_name", F.when(name.isin(list(carrier_names)), name).otherwise(unknown))


def _columns(carrier_names, others: str | None) -> list[str]:
    return list(carrier_names) + ([others] if others is not None and others not in carrier_names else [])


def breach_pivot(fact: DataFrame, carrier_names, others: str | None = None) -> DataFrame:
    """Breach rate, warehouses by the carriers of the run's dimension, and a column `others` for shipments of none of them."""
    return _known_carriers(fact, carrier_names, others).groupBy("warehouse_name").pivot("carrier_name", _columns(carrier_names, others)).agg(
        _ratio(F.count_if("sla_breach_flag"), F.count("sla_breach_flag"))
    )


def category_view(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category_name").agg(
        F.count("shipment_id").alias("shipments"), round_scaled(F.avg("actual_delivery_days"), 4).alias("avg_delivery_days")
    )


def shipment_detail(fact: DataFrame) -> DataFrame:
    return fact.select(
        "order_id", "warehouse_name", "carrier_name", "category_name", "sla_tier", "actual_delivery_days", "sla_target_days",
        "issue_type", "anomaly_flag", anomaly_label(F.col("anomaly_flag")).alias("anomaly_label"),
    )


def weekly_issue_rate(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week_start_date", "issue_type").agg(_issue_rate().alias("quality_issue_rate"))


def quality_heatmap(weekly: DataFrame, carrier_names, others: str | None = None) -> DataFrame:
    """Issue rate, warehouses by the carriers of the run's dimension, and a column `others` for rows of none of them."""
    return _known_carriers(weekly, carrier_names, others).groupBy("warehouse_name").pivot("carrier_name", _columns(carrier_names, others)).agg(_issue_rate())


def category_issues(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("category_name", "issue_type").agg(F.sum("issue_count").alias("issue_count"))
