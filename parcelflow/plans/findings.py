"""Findings about the known windows, from the daily counts that the scores come from too.

Every finding is a small join of the windows with `scoring.daily_flag_counts`, all windows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.scalars import as_count_text, as_percent_text, rate, round_scaled
from parcelflow.operators.scoring import DAMAGED_METRIC, SLA_METRIC, top_segment


def _on_days(days: DataFrame, daily: DataFrame) -> DataFrame:
    """Window days with the rollup of their day, warehouse and, where named, carrier: an equality join."""
    same = (
        (F.col("w.day") == F.col("d.order_purchase_date"))
        & (F.col("w.affected_warehouse_id") == F.col("d.warehouse_id"))
        & (F.col("w.affected_carrier_id").isNull() | (F.col("w.affected_carrier_id") == F.col("d.carrier_id")))
    )
    return days.alias("w").join(daily.alias("d"), same, "left")


def _days_between(first: Column, last: Column) -> Column:
    """One row per day; a window that ends before it begins keeps one row without a day."""
    return F.explode_outer(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))))


def _rates(whole: Column, counted: Column, prefix: str, name: str) -> list[Column]:
    return [whole.alias(f"{prefix}shipments"), counted.alias(f"{prefix}{name}_count"), rate(counted, whole).alias(f"{prefix}{name}_rate")]


def _rates_where(keep: Column, part: str, prefix: str = "", as_name: str | None = None) -> list[Column]:
    """Shipments, counted part and their ratio over the rows in `keep`."""
    whole = F.coalesce(F.sum(F.when(keep, F.col("shipments"))), F.lit(0))
    return _rates(whole, F.sum(F.when(keep, F.col(part))), prefix, as_name or part)


def _spikes(windows: DataFrame) -> DataFrame:
    return windows.where(F.col("anomaly_type") == config.SPIKE_TYPE)


def spike_inside(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """Damage rate of each spike's segment inside its window."""
    days = _spikes(windows).withColumn("day", _days_between(F.col("start_date"), F.col("end_date")))
    return _on_days(days, daily).groupBy("anomaly_id").agg(*_rates_where(F.lit(True), "damages", as_name="damaged"))


def spike_outside(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """Damage rate of the same segment on all other days: the segment's total less what lies inside.

    Windows meet one row per segment and one per day of theirs, never all days.
    """
    totals = daily.groupBy("warehouse_id", "carrier_id").agg(F.sum("shipments").alias("shipments"), F.sum("damages").alias("damages"))
    same = (F.col("affected_warehouse_id") == F.col("warehouse_id")) & (F.col("affected_carrier_id").isNull() | (F.col("affected_carrier_id") == F.col("carrier_id")))
    whole = _spikes(windows).join(totals, same, "left").groupBy("anomaly_id").agg(F.coalesce(F.sum("shipments"), F.lit(0)).alias("all_shipments"), F.sum("damages").alias("all_damages"))
    left = whole.join(spike_inside(daily, windows).select("anomaly_id", "shipments", "damaged_count"), "anomaly_id")
    left = left.withColumn("outside", F.col("all_shipments") - F.col("shipments"))
    damaged = F.when(F.col("outside") > 0, F.col("all_damages") - F.coalesce("damaged_count", F.lit(0)))
    return left.select("anomaly_id", *_rates(F.col("outside"), damaged, "", "damaged"))


def spike_share(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """Share of the segment in all damages of the window's days; NULL without any damage.

    Windows join by day, an equality, so that no other days are paired with them.
    """
    days = windows.where(F.col("anomaly_type") == config.SPIKE_TYPE).withColumn(
        "order_purchase_date", F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    )
    mine = (F.col("warehouse_id") == F.col("affected_warehouse_id")) & (
        F.col("affected_carrier_id").isNull() | (F.col("carrier_id") == F.col("affected_carrier_id"))
    )
    return (
        days.join(daily, "order_purchase_date", "left")
        .groupBy("anomaly_id")
        .agg(
            F.sum(F.when(mine, F.col("damages"))).alias("segment_damaged_count"),
            F.coalesce(F.sum("damages"), F.lit(0)).alias("window_damaged_count"),
        )
        .withColumn("damaged_share", rate(F.col("segment_damaged_count"), F.col("window_damaged_count")))
    )


def drift_start_end(daily: DataFrame, windows: DataFrame, days: int = 7) -> DataFrame:
    """Breach rate of each drift's warehouse in the first and last `days` days of its window."""
    drifts = windows.where(F.col("anomaly_type") == config.DRIFT_TYPE).withColumn("affected_carrier_id", F.lit(None).cast("string"))
    first = drifts.withColumn("part", F.lit("start")).withColumn("day", _days_between(F.col("start_date"), F.date_add("start_date", days - 1)))
    last = drifts.withColumn("part", F.lit("end")).withColumn("day", _days_between(F.date_sub("end_date", days - 1), F.col("end_date")))
    return _on_days(first.unionByName(last), daily).groupBy("anomaly_id", "affected_warehouse_id").agg(
        *(c for part in ("start", "end") for c in _rates_where(F.col("part") == part, "breaches", f"{part}_", "breach"))
    )


def overview(daily: DataFrame, results: DataFrame) -> DataFrame:
    """Number and date range of the shipments, and the number of flagged segment-weeks.

    Both inputs go through one aggregation as a union, so that they share the daily counts behind them.
    """
    bought = daily.select("shipments", "order_purchase_date", F.lit(0).cast("long").alias("flagged"))
    flagged = results.where("anomaly_detected").select(
        F.lit(0).cast("long").alias("shipments"), F.lit(None).cast("date").alias("order_purchase_date"), F.lit(1).cast("long").alias("flagged")
    )
    return bought.unionByName(flagged).agg(
        F.coalesce(F.sum("shipments"), F.lit(0)).alias("total_shipments"),
        F.min("order_purchase_date").alias("date_start"),
        F.max("order_purchase_date").alias("date_end"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("total_flagged_segment_weeks"),
    )


def _named_segment(top: DataFrame, metric: str, label: str) -> Column:
    return F.concat(
        F.col("warehouse_name"), F.lit(" x "), F.col("carrier_name"), F.lit(" on "), F.col("week_start_date").cast("string"),
        F.lit(f" ({label} "), as_percent_text(F.col(metric)), F.lit(", z-score "),
        F.format_string("%.2f", round_scaled(F.col("z_score"), 2)), F.lit(")"),
    )


def findings_text(daily: DataFrame, windows: DataFrame, results: DataFrame, summary: DataFrame) -> DataFrame:
    """The findings as `section, item, text` rows, formatted for a report."""

    def rows(df: DataFrame, section, items: dict[str, Column]) -> DataFrame:
        section = F.lit(section) if isinstance(section, str) else section
        cells = F.array(*(F.struct(F.lit(name).alias("item"), text.alias("text")) for name, text in items.items()))
        return df.select(section.alias("section"), F.explode(cells).alias("cell")).select("section", "cell.item", "cell.text")

    def rated(prefix: str, name: str) -> Column:
        return F.concat(
            as_percent_text(F.col(f"{prefix}{name}_rate")), F.lit(" ("), as_count_text(F.col(f"{prefix}{name}_count")),
            F.lit(" of "), as_count_text(F.col(f"{prefix}shipments")), F.lit(")"),
        )

    parts = [
        rows(overview(daily, results), "overview", {
            "total shipments": as_count_text(F.col("total_shipments")),
            "date range": F.concat(F.col("date_start").cast("string"), F.lit(" to "), F.col("date_end").cast("string")),
            "flagged segment-weeks": as_count_text(F.col("total_flagged_segment_weeks")),
        }),
        rows(summary, F.col("anomaly_id"), {
            "detected": F.when(F.col("detected"), "yes").otherwise("no"),
            "first detected week": F.coalesce(F.col("first_detected_week").cast("string"), F.lit("n/a")),
        }),
        rows(top_segment(results, DAMAGED_METRIC), "top segments", {"damaged issue rate": _named_segment(results, DAMAGED_METRIC, "damaged issue rate")}),
        rows(top_segment(results, SLA_METRIC), "top segments", {"SLA breach rate": _named_segment(results, SLA_METRIC, "SLA breach rate")}),
        rows(spike_inside(daily, windows), F.col("anomaly_id"), {"damaged rate in window": rated("", "damaged")}),
        rows(spike_outside(daily, windows), F.col("anomaly_id"), {"damaged rate outside window": rated("", "damaged")}),
        rows(spike_share(daily, windows), F.col("anomaly_id"), {"share of damages in window": as_percent_text(F.col("damaged_share"))}),
        rows(drift_start_end(daily, windows), F.col("anomaly_id"), {
            "breach rate at start": rated("start_", "breach"),
            "breach rate at end": rated("end_", "breach"),
        }),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
