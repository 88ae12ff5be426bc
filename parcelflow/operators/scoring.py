"""Weekly segment scoring on two tracks, and validation against known labels.

The fact is read once, into counts per day, warehouse, carrier and flag. Scores, labels and findings all
come from those counts, so windows and joins see days x segments, whatever the size of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.scalars import has_member, rate, round_scaled, week_start

SEGMENT_KEYS = ("week_start_date", "warehouse_id", "carrier_id")
SLA_METRIC = "sla_breach_rate"
DAMAGED_METRIC = "damaged_issue_rate"


def daily_flag_counts(fact: DataFrame) -> DataFrame:
    """Shipments, breaches and damages per purchase date, warehouse, carrier and anomaly flag."""
    return fact.groupBy("order_purchase_date", "warehouse_id", "carrier_id", "anomaly_flag").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if("sla_breach_flag").alias("breaches"),
        F.count_if(F.col("issue_type") == "damaged").alias("damages"),
    )


def _by_segment(counts: DataFrame):
    """Counts grouped by segment-week. They are already few per segment, so they are placed by segment
    once, which serves this grouping and the windows over the segment alike."""
    placed = counts.repartition("warehouse_id", "carrier_id")
    return placed.withColumn("week_start_date", week_start(F.col("order_purchase_date"))).groupBy(*SEGMENT_KEYS)


def _totals():
    return (
        F.sum("shipments").alias("shipment_count"),
        F.sum("breaches").alias("sla_breach_count"),
        F.sum("damages").alias("damaged_issue_count"),
    )


def _label_columns(labels):
    known = F.col("anomaly_flag").isin(*labels)
    return (
        F.sum(F.when(known, F.col("shipments")).otherwise(0)).alias("known_anomaly_count"),
        # Distinct flags of the config: a bounded set per group.
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("anomaly_flag")))), ";").alias("known_anomaly_labels"),
    )


def _with_rates(segments: DataFrame) -> DataFrame:
    return segments.withColumns(
        {
            "sla_breach_rate": rate(F.col("sla_breach_count"), F.col("shipment_count")),
            "damaged_issue_rate": rate(F.col("damaged_issue_count"), F.col("shipment_count")),
        }
    )


def weekly_segment(daily_counts: DataFrame) -> DataFrame:
    """Counts and unrounded rates per segment-week."""
    return _with_rates(_by_segment(daily_counts).agg(*_totals()))


def label_rollup(daily_counts: DataFrame, labels=tuple(config.VALIDATION_METRICS)) -> DataFrame:
    """Labelled rows and distinct labels per segment-week that has any."""
    return _by_segment(daily_counts.where(F.col("anomaly_flag").isin(*labels))).agg(*_label_columns(labels))


def labelled_segment(daily_counts: DataFrame, labels=tuple(config.VALIDATION_METRICS)) -> DataFrame:
    """`weekly_segment` with its label rollup, in one aggregation instead of a join of two.

    A segment-week with a NULL key gets no labels, as an equality join would leave it.
    """
    rolled = _with_rates(_by_segment(daily_counts).agg(*_totals(), *_label_columns(labels)))
    joinable = F.lit(True)
    for key in SEGMENT_KEYS:
        joinable = joinable & F.col(key).isNotNull()
    has_label = joinable & (F.col("known_anomaly_count") > 0)
    return rolled.withColumns(
        {
            "known_anomaly_labels": F.when(has_label, F.col("known_anomaly_labels")).otherwise("none"),
            "known_anomaly_count": F.when(has_label, F.col("known_anomaly_count")).otherwise(F.lit(0)),
        }
    )


def _deviation(values: Column) -> Column:
    """Sample deviation of a short array, value by value in order; NULL below two values.

    `F.stddev_samp` sums the same squares in another way. Few shipments give round rates, so a z-score
    can lie exactly on the threshold, and there the last digit decides.
    """
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(state: Column, value: Column) -> Column:
        n = state["n"] + 1.0
        mean = state["mean"] + (value - state["mean"]) / n
        squares = state["squares"] + (value - mean) * (value - state["mean"])
        return F.struct(n.alias("n"), mean.alias("mean"), squares.alias("squares"))

    return F.aggregate(values, start, add, lambda s: F.when(s["n"] > 1, F.sqrt(s["squares"] / (s["n"] - 1.0))))


def with_sla_baseline(segments: DataFrame, weeks: int = 4) -> DataFrame:
    """Mean, deviation and number of the `weeks` previous present weeks of the same segment."""
    prior = Window.partitionBy("warehouse_id", "carrier_id").orderBy("week_start_date").rowsBetween(-weeks, -1)
    framed = segments.withColumns(
        {
            "prior_week_count": F.count("sla_breach_rate").over(prior),
            "sla_mean": F.avg("sla_breach_rate").over(prior),
            "prior_rates": F.collect_list("sla_breach_rate").over(prior),
        }
    )
    return framed.withColumn("sla_std", _deviation(F.col("prior_rates"))).drop("prior_rates")


def with_damaged_baseline(segments: DataFrame) -> DataFrame:
    """Mean and deviation over all weeks of the same segment, the current one included."""
    # Floating sums depend on the order of rows, so the frame is ordered.
    by_week = Window.partitionBy("warehouse_id", "carrier_id").orderBy("week_start_date")
    whole = by_week.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return segments.withColumns(
        {
            "damaged_mean": F.avg("damaged_issue_rate").over(whole),
            "damaged_std": F.stddev_samp("damaged_issue_rate").over(whole),
        }
    )


def _track(metric: str, value: Column, mean: Column, std: Column, ready: Column, enough: Column, threshold: float) -> Column:
    """One scored metric as a struct: z and flag come from unrounded values, only the output is rounded."""
    z = F.when(ready & (std > 0), (value - mean) / std)
    return F.struct(
        F.lit(metric).alias("detection_metric"),
        round_scaled(mean, 4).alias("trailing_4_week_mean"),
        round_scaled(std, 4).alias("trailing_4_week_std"),
        round_scaled(z, 4).alias("z_score"),
        F.coalesce(enough & (F.abs(z) >= threshold), F.lit(False)).alias("anomaly_detected"),
    )


def sla_track(threshold: float, min_shipments: int, min_prior: int) -> Column:
    return _track(
        SLA_METRIC, F.col("sla_breach_rate"), F.col("sla_mean"), F.col("sla_std"),
        F.col("prior_week_count") >= min_prior, F.col("shipment_count") >= min_shipments, threshold,
    )


def damaged_track(threshold: float, min_shipments: int) -> Column:
    return _track(
        DAMAGED_METRIC, F.col("damaged_issue_rate"), F.col("damaged_mean"), F.col("damaged_std"),
        F.lit(True), F.col("shipment_count") >= min_shipments, threshold,
    )


def _with_names(segments: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    """Names join the weekly counts, not the fact."""
    return segments.join(dim_warehouse, "warehouse_id", "left").join(dim_carrier, "carrier_id", "left")


def score(
    segments: DataFrame,
    dim_warehouse: DataFrame,
    dim_carrier: DataFrame,
    tracks: tuple[str, ...] = (SLA_METRIC, DAMAGED_METRIC),
    z_threshold: float = config.Z_SCORE_THRESHOLD,
    min_shipments: int = config.MIN_SHIPMENTS,
    min_prior: int = config.MIN_PRIOR_WEEKS,
    frame_weeks: int = 4,
) -> DataFrame:
    """Scored segment-weeks in long form, one row per metric.

    Both baselines share one partitioning and one sort; the metrics are unpivoted from one row.
    """
    scored = segments
    built = []
    if SLA_METRIC in tracks:
        scored = with_sla_baseline(scored, frame_weeks)
        built.append(sla_track(z_threshold, min_shipments, min_prior))
    if DAMAGED_METRIC in tracks:
        scored = with_damaged_baseline(scored)
        built.append(damaged_track(z_threshold, min_shipments))
    long = scored.withColumn("track", F.explode(F.array(*built)))
    named = _with_names(long, dim_warehouse, dim_carrier)
    return named.select(
        "track.detection_metric", "week_start_date", "warehouse_id", "warehouse_name", "carrier_id", "carrier_name",
        "shipment_count", "sla_breach_count", "damaged_issue_count",
        round_scaled(F.col("sla_breach_rate"), 4).alias("sla_breach_rate"),
        round_scaled(F.col("damaged_issue_rate"), 4).alias("damaged_issue_rate"),
        "track.trailing_4_week_mean", "track.trailing_4_week_std", "track.z_score", "track.anomaly_detected",
        "known_anomaly_count", "known_anomaly_labels",
    )


def anomaly_results(fact: DataFrame, dim_warehouse: DataFrame, dim_carrier: DataFrame, labels=tuple(config.VALIDATION_METRICS), **params) -> DataFrame:
    """The full result: both tracks for every segment-week, with its known labels."""
    return score(labelled_segment(daily_flag_counts(fact), labels), dim_warehouse, dim_carrier, **params)


# --- validation ------------------------------------------------------------------------------------


def flagged_by_metric(results: DataFrame) -> DataFrame:
    return results.where("anomaly_detected").groupBy("detection_metric").agg(F.count(F.lit(1)).alias("flagged_segment_weeks"))


def per_label(results: DataFrame) -> DataFrame:
    """Result rows once per known label they carry."""
    labelled = results.where(F.col("known_anomaly_labels") != "none")
    return labelled.withColumn("anomaly_id", F.explode(F.split("known_anomaly_labels", ";")))


# Strongest z first; ties by week, warehouse and carrier.
def _strongest() -> list[Column]:
    return [F.abs("z_score").desc(), F.col("week_start_date"), F.col("warehouse_id"), F.col("carrier_id")]


def _judged(results: DataFrame, label_metrics: DataFrame) -> DataFrame:
    """Flagged rows per label under the metric the label is judged by, ranked by strength.

    A label has few rows: the weeks of its window times the segments it touches.
    """
    wanted = label_metrics.withColumnRenamed("validation_metric", "detection_metric")
    judged = per_label(results.where("anomaly_detected")).join(wanted, ["anomaly_id", "detection_metric"])
    segment = F.concat(
        F.col("warehouse_id"), F.lit(" x "), F.col("carrier_id"), F.lit(" (z="), round_scaled(F.col("z_score"), 2).cast("string"), F.lit(")")
    )
    rank = F.row_number().over(Window.partitionBy("anomaly_id").orderBy(*_strongest()))
    return judged.select("anomaly_id", rank.alias("segment_rank"), segment.alias("segment"), "week_start_date", "z_score")


def top_flagged_segments(results: DataFrame, label_metrics: DataFrame, k: int = 3) -> DataFrame:
    """The `k` strongest flagged segment-weeks per label."""
    return _judged(results, label_metrics).where(F.col("segment_rank") <= k)


def anomaly_summary(results: DataFrame, label_metrics: DataFrame, k: int = 3) -> DataFrame:
    """One row per known label: whether, when and where its own metric found it."""
    best = F.when(F.col("segment_rank") <= k, F.struct("segment_rank", "segment"))
    found = _judged(results, label_metrics).groupBy("anomaly_id").agg(
        F.min("week_start_date").alias("first_detected_week"),
        F.count(F.lit(1)).alias("flagged_segment_weeks"),
        F.array_sort(F.collect_list(best)).alias("best"),
    )
    count = F.coalesce("flagged_segment_weeks", F.lit(0))
    return label_metrics.join(found, "anomaly_id", "left").select(
        "anomaly_id",
        "validation_metric",
        (count > 0).alias("detected"),
        "first_detected_week",
        count.alias("flagged_segment_weeks"),
        F.coalesce(F.array_join("best.segment", "; "), F.lit("")).alias("top_flagged_segments"),
    )


def spike_diagnostics(results: DataFrame, label: str) -> DataFrame:
    """Every result row that carries a label, under both metrics."""
    return results.where(has_member(F.col("known_anomaly_labels"), label)).select(
        "detection_metric", "warehouse_name", "carrier_name", "week_start_date", "shipment_count", "sla_breach_count",
        "sla_breach_rate", "damaged_issue_count", "damaged_issue_rate", "z_score", "anomaly_detected", "known_anomaly_count",
    )


def top_segment(results: DataFrame, metric: str) -> DataFrame:
    """The strongest flagged segment-week of one metric."""
    return (
        results.where(F.col("anomaly_detected") & (F.col("detection_metric") == metric))
        .orderBy(*_strongest())
        .limit(1)
        .select("warehouse_name", "carrier_name", "week_start_date", metric, "z_score")
    )
