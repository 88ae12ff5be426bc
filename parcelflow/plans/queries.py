"""Every operator as a named query over the star-schema tables.

All queries read the whole tables and keep the whole order history (`months=None`), except those about
the six-month window. `MIN_SHIPMENTS` is 3 instead of 20 because the test data has few shipments per
segment-week.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.scalars import round_scaled
from parcelflow.functions.scratch import scratch_path, stored
from parcelflow.operators import changes, enrich, payloads, quality, rollups, scoring, staging, timejoins
from parcelflow.plans import build, exports, findings, incremental, kpis, marts
from parcelflow.sources import schemas, star
from parcelflow.sources.tables import materialize, read_csv, read_csv_quarantined, row_counts, write_csv
from parcelflow.streaming import daily

MIN_SHIPMENTS = 3
SPIKE = "ANOM_SPIKE_001"
#: The day of the earlier of two loads in the queries on changes.
LOAD_DAY = "1998-07-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Lazy:
    """The frames of one data folder. They are lazy but for the routing table, and for the queries that write."""

    rules = star.RULES

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def source(self) -> dict[str, DataFrame]:
        return star.source_tables(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return star.read_star(self.spark, self.sf_dir, "events")["events"]

    @cached_property
    def earlier_orders(self) -> DataFrame:
        """The orders as a load of `LOAD_DAY` would hold them: none bought later, no delivery known that is later."""
        day, orders = F.lit(LOAD_DAY).cast("timestamp"), self.source["raw_orders"]
        later = ("order_delivered_carrier_date", "order_delivered_customer_date")
        return orders.where(F.col("order_purchase_timestamp") < day).withColumns({c: F.when(F.col(c) < day, F.col(c)) for c in later})

    @cached_property
    def routing(self) -> DataFrame:
        # Written, so that Spark knows its size and its own threshold decides on a broadcast.
        return stored(star.routing(self.spark, self.sf_dir), f"routing-{abs(hash(self.sf_dir))}")

    def enriched_over(self, months: int | None) -> DataFrame:
        s = self.source
        return enrich.enrich_orders(
            s["raw_orders"], s["raw_customers"], s["raw_order_items"], s["raw_products"], s["raw_reviews"],
            self.routing, self.rules, months, unique_keys=True,
        )

    @cached_property
    def enriched(self) -> DataFrame:
        return self.enriched_over(None)

    @cached_property
    def assigned(self) -> dict[str, DataFrame]:
        return enrich.assignment_tables(self.enriched)

    @cached_property
    def given(self) -> dict[str, DataFrame]:
        """The assignment tables as a user has them: stored, one pass of the enrichment for all."""
        return enrich.assignment_tables(stored(self._assignment_columns(self.enriched), "assigned"))

    @cached_property
    def recent(self) -> dict[str, DataFrame]:
        """Likewise over the last six complete months."""
        return enrich.assignment_tables(stored(self._assignment_columns(self.enriched_over(config.WINDOW_MONTHS)), "assigned-recent"))

    @staticmethod
    def _assignment_columns(enriched: DataFrame) -> DataFrame:
        return enriched.select(*dict.fromkeys(c for columns in enrich.ASSIGNMENT_COLUMNS.values() for c in columns))

    @cached_property
    def fact(self) -> DataFrame:
        return staging.fact_of(self.enriched)

    @cached_property
    def daily_counts(self) -> DataFrame:
        return scoring.daily_flag_counts(self.fact)

    @cached_property
    def segments(self) -> DataFrame:
        return scoring.labelled_segment(self.daily_counts)

    @property
    def carrier_names(self) -> list[str]:
        return [c.carrier_name for c in self.rules.carriers]

    @cached_property
    def names(self) -> tuple[DataFrame, DataFrame]:
        return config.warehouse_names(self.spark), config.carrier_names(self.spark)

    def scored(self, segments: DataFrame | None = None, **params) -> DataFrame:
        segments = self.segments if segments is None else segments
        return scoring.score(segments, *self.names, min_shipments=MIN_SHIPMENTS, **params)

    @cached_property
    def results(self) -> DataFrame:
        return self.scored()

    @cached_property
    def label_metrics(self) -> DataFrame:
        return config.label_metrics_df(self.spark, self.rules.validation_metrics)

    @cached_property
    def summary(self) -> DataFrame:
        return scoring.anomaly_summary(self.results, self.label_metrics)

    @cached_property
    def windows(self) -> DataFrame:
        return config.windows_df(self.spark, self.rules.windows)

    @cached_property
    def daily(self) -> DataFrame:
        return exports.daily_sla(marts.agg_daily_sla(self.fact), *self.names)

    @cached_property
    def weekly(self) -> DataFrame:
        return exports.weekly_quality(marts.agg_weekly_quality(marts.weekly_flag_counts(self.fact)), *self.names)

    @cached_property
    def named_fact(self) -> DataFrame:
        return exports.shipments(self.fact, *self.names)


@lru_cache(maxsize=4)
def _lazy(spark: SparkSession, application_id: str, sf_dir: str) -> Lazy:
    return Lazy(spark, sf_dir)


def query(fn: Callable[[Lazy], DataFrame]):
    """Register a function of the lazy frames under its own name.

    Queries of one session share the frames, that is the analysed plans; no data is kept.
    """
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(_lazy(spark, spark.sparkContext.applicationId, sf_dir))
    return fn


# --- sources ---------------------------------------------------------------------------------------


@query
def src_csv_scan(t):
    path = scratch_path(t.spark, "raw_orders_csv")
    write_csv(t.source["raw_orders"], path)
    return read_csv(t.spark, path, schemas.RAW_ORDERS)


@query
def bronze_row_counts(t):
    return row_counts({**t.source, **t.given})


@query
def scalar_casts(t):
    days = t.source["raw_orders"].select(
        "order_id",
        F.col("order_id").try_cast("int").alias("order_number"),
        F.col("order_purchase_timestamp").cast("date").alias("purchase_date"),
        F.col("order_purchase_timestamp").cast("string").alias("purchase_text"),
    )
    return days.select(
        "*",
        F.try_to_timestamp("purchase_text").cast("timestamp_ntz").alias("purchase_again"),
        (F.col("order_number") / F.lit(7.0)).cast("decimal(12,4)").alias("as_decimal"),
        round_scaled(F.col("order_number") / F.lit(8.0), 2).alias("as_rounded"),
        F.col("order_number").cast("double").alias("as_double"),
    )


# --- staging and marts -----------------------------------------------------------------------------


@query
def stg_orders(t):
    # Assignments cover the last six complete months, so older orders stay unassigned.
    tables = {name: t.recent[name] for name in ("raw_warehouse_assignments", "raw_carrier_assignments")}
    return staging.orders_of(t.source["raw_orders"], t.source["raw_customers"], staging.merged_assignments(tables))


@query
def stg_shipments(t):
    tables = {name: t.given[name] for name in ("raw_warehouse_assignments", "raw_carrier_assignments", "raw_sla_targets")}
    return staging.shipments_of(staging.assigned_orders(t.source["raw_orders"], t.source["raw_customers"], tables, needed=tables))


@query
def stg_issues(t):
    return staging.stg_issues(t.assigned["raw_issue_flags"])


@query
def fct_shipments(t):
    return t.fact


@query
def fct_shipments_joined(t):
    return staging.fact_of(staging.assigned_orders(t.source["raw_orders"], t.source["raw_customers"], t.given))


@query
def dim_warehouse(t):
    return marts.dim_warehouse(t.assigned["raw_warehouse_assignments"])


@query
def dim_carrier(t):
    return marts.dim_carrier(t.assigned["raw_carrier_assignments"])


@query
def dim_category(t):
    return marts.dim_category(t.assigned["raw_sla_targets"])


@query
def dim_date(t):
    return marts.dim_date(staging.shipments_of(t.enriched))


@query
def agg_daily_sla(t):
    return marts.agg_daily_sla(t.fact)


@query
def weekly_quality_base(t):
    return marts.weekly_quality_base(t.fact)


@query
def weekly_dominant_flag(t):
    return marts.weekly_dominant_flag(marts.weekly_flag_counts(t.fact))


@query
def agg_weekly_quality(t):
    return marts.agg_weekly_quality(marts.weekly_flag_counts(t.fact))


# --- scoring and validation ------------------------------------------------------------------------


@query
def weekly_segment(t):
    segments = scoring.weekly_segment(t.daily_counts)
    return segments.withColumns({c: round_scaled(F.col(c), 6) for c in ("sla_breach_rate", "damaged_issue_rate")})


@query
def scored_sla(t):
    return scoring.with_sla_baseline(scoring.weekly_segment(t.daily_counts)).select(
        "week_start_date", "warehouse_id", "carrier_id", "prior_week_count",
        round_scaled(F.col("sla_mean"), 4).alias("trailing_4_week_mean"), round_scaled(F.col("sla_std"), 4).alias("trailing_4_week_std"),
    )


@query
def scored_damaged(t):
    return scoring.with_damaged_baseline(scoring.weekly_segment(t.daily_counts)).select(
        "week_start_date", "warehouse_id", "carrier_id",
        round_scaled(F.col("damaged_mean"), 4).alias("damaged_segment_mean"), round_scaled(F.col("damaged_std"), 4).alias("damaged_segment_std"),
    )


@query
def label_rollup(t):
    return scoring.label_rollup(t.daily_counts)


@query
def anomaly_sla_track(t):
    return t.scored(tracks=(scoring.SLA_METRIC,))


@query
def anomaly_damaged_track(t):
    return t.scored(tracks=(scoring.DAMAGED_METRIC,))


@query
def anomaly_results(t):
    return t.results


@query
def flagged_by_metric(t):
    return scoring.flagged_by_metric(t.results)


@query
def anomaly_summary(t):
    return t.summary


@query
def top_flagged_segments(t):
    return scoring.top_flagged_segments(t.results, t.label_metrics)


@query
def spike_diagnostics(t):
    return scoring.spike_diagnostics(t.results, SPIKE)


@query
def top_damaged_segment(t):
    return scoring.top_segment(t.results, scoring.DAMAGED_METRIC)


@query
def top_sla_segment(t):
    return scoring.top_segment(t.results, scoring.SLA_METRIC)


# --- findings --------------------------------------------------------------------------------------


def _rounded_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: round_scaled(F.col(c), 6) for c in df.columns if c.endswith(("_rate", "_share"))})


@query
def findings_overview(t):
    # The overview and the scores need different columns of the counts: written, they are computed once.
    counts = materialize(t.daily_counts, scratch_path(t.spark, "daily_counts"))
    return findings.overview(counts, t.scored(scoring.labelled_segment(counts)))


@query
def finding_spike_inside(t):
    return _rounded_rates(findings.spike_inside(t.daily_counts, t.windows))


@query
def finding_spike_outside(t):
    return _rounded_rates(findings.spike_outside(t.daily_counts, t.windows))


@query
def finding_spike_share(t):
    return _rounded_rates(findings.spike_share(t.daily_counts, t.windows))


@query
def finding_drift_start_end(t):
    return _rounded_rates(findings.drift_start_end(t.daily_counts, t.windows))


@query
def findings_text(t):
    # Nine small parts read the counts, so they are written once.
    counts = materialize(t.daily_counts, scratch_path(t.spark, "daily_counts"))
    results = t.scored(scoring.labelled_segment(counts))
    return findings.findings_text(counts, t.windows, results, scoring.anomaly_summary(results, t.label_metrics))


# --- quality ---------------------------------------------------------------------------------------
# The sources hold real faults: undelivered orders, repeated line numbers, orders without lines, ship
# dates unrelated to order dates. The checks must find exactly those.


@query
def dq_not_null(t):
    return quality.null_counts(t.source["raw_orders"], schemas.RAW_ORDERS.names)


@query
def dq_unique(t):
    lines = star.read_star(t.spark, t.sf_dir, "lineitem")["lineitem"]
    return quality.duplicates(lines, "l_orderkey", "l_linenumber")


@query
def dq_relationships(t):
    return quality.orphans(t.source["raw_orders"], "order_id", t.source["raw_order_items"], "order_id")


@query
def dq_accepted_values(t):
    return quality.unaccepted_values(t.source["raw_products"], "product_category_name", ("SMALL", "LARGE", "PROMO", "ECONOMY"))


@query
def dq_date_order(t):
    tables = star.read_star(t.spark, t.sf_dir, "orders", "lineitem")
    orders, lines = tables["orders"], tables["lineitem"]
    arrived = F.col("l_shipdate").cast("date")
    shipments = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.concat(F.lit("ship_"), F.col("o_orderkey").cast("string")).alias("shipment_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_purchase_date"),
        F.when(F.col("l_linenumber") != 1, arrived).alias("delivered_customer_date"),
        F.date_add(arrived, 400).alias("estimated_delivery_date"),
    )
    return quality.bad_date_order(shipments)


@query
def dq_row_counts(t):
    return quality.row_count_status(row_counts({**t.source, **t.given}))


@query
def dq_expected_counts(t):
    # The expected number is that of the orders in the window; assignments over all orders exceed it.
    expected = enrich.in_recent_months(t.source["raw_orders"]).agg(F.count(F.lit(1)).alias("expected_rows"))
    counts = row_counts(
        {
            "raw_orders": t.source["raw_orders"],
            "raw_issue_flags": t.recent["raw_issue_flags"],
            "raw_warehouse_assignments": t.recent["raw_warehouse_assignments"],
            "raw_order_items": t.source["raw_order_items"],
        }
    )
    return quality.unexpected_counts(
        counts, expected, exact=("raw_issue_flags", "raw_warehouse_assignments", "raw_order_items"), larger=("raw_orders",)
    )


@query
def dq_blank_keys(t):
    blanked = t.source["raw_orders"].withColumn("order_id", F.when(F.col("order_status") != "canceled", F.col("order_id")).otherwise(" "))
    return quality.blank_keys({"raw_orders": blanked, "raw_payments": t.source["raw_payments"]}, "order_id")


@query
def dq_value_counts(t):
    return quality.value_counts(t.enriched, "issue_type")


@query
def dq_required_values(t):
    return quality.missing_values(t.enriched, "anomaly_flag", (*t.rules.labels, "ANOM_ABSENT"))


@query
def dq_detection_outcome(t):
    expected = t.label_metrics.unionByName(config.label_metrics_df(t.spark, {"ANOM_ABSENT": scoring.SLA_METRIC}))
    return quality.missed_labels(t.summary, expected)


@query
def dq_report(t):
    tables = build.build_marts(t.source, t.routing, scratch_path(t.spark, "marts"), t.rules, months=None)
    return quality.suite_report(tables, build.SUITE)


# --- exports ---------------------------------------------------------------------------------------


@query
def export_fct_shipments(t):
    return t.named_fact.orderBy(*exports.EXPORT_ORDER["fct_shipments_dashboard"])


@query
def export_daily_sla(t):
    return t.daily.orderBy(*exports.EXPORT_ORDER["daily_sla_performance"])


@query
def export_weekly_quality(t):
    return t.weekly.orderBy(*exports.EXPORT_ORDER["weekly_quality_by_segment"])


@query
def export_anomaly_summary(t):
    return exports.export_summary(t.summary, scratch_path(t.spark, "exports"))


# --- dashboards ------------------------------------------------------------------------------------


@query
def kpi_executive(t):
    return kpis.executive(t.daily)


@query
def kpi_ops(t):
    return kpis.ops(t.named_fact)


@query
def kpi_quality(t):
    return kpis.quality(t.weekly, t.summary)


@query
def kpi_avg_delay_by_carrier(t):
    return kpis.avg_delay_by_carrier(t.daily)


@query
def kpi_damaged_spike(t):
    return kpis.damaged_spike(t.weekly)


@query
def kpi_delay_distribution(t):
    return kpis.delay_distribution(t.named_fact)


@query
def kpi_sla_trend(t):
    return kpis.sla_trend(t.daily)


@query
def kpi_breach_by_category(t):
    return kpis.breach_by_category(t.named_fact)


@query
def kpi_breach_by_warehouse(t):
    return kpis.breach_by_warehouse(t.daily)


@query
def kpi_breach_trend(t):
    return kpis.breach_trend(t.daily)


@query
def kpi_shipments_by_segment(t):
    return kpis.shipments_by_segment(t.named_fact)


@query
def kpi_daily_attainment(t):
    return kpis.daily_attainment(t.daily)


@query
def kpi_breaches_per_warehouse(t):
    return kpis.breaches_per_warehouse(t.daily)


@query
def kpi_carrier_tier(t):
    return kpis.carrier_tier(t.daily)


@query
def kpi_daily_volume(t):
    return kpis.daily_volume(t.named_fact)


@query
def kpi_delay_bins(t):
    return kpis.delay_bins(t.named_fact)


@query
def kpi_breach_pivot(t):
    return kpis.breach_pivot(t.named_fact, t.carrier_names)


@query
def kpi_category_view(t):
    return kpis.category_view(t.named_fact)


@query
def kpi_shipment_detail(t):
    return kpis.shipment_detail(t.named_fact)


@query
def kpi_weekly_issue_rate(t):
    return kpis.weekly_issue_rate(t.weekly)


@query
def kpi_quality_heatmap(t):
    return kpis.quality_heatmap(t.weekly, t.carrier_names)


@query
def kpi_category_issues(t):
    return kpis.category_issues(t.weekly)


@query
def kpi_filtered_quality(t):
    kept = kpis.filtered(
        t.weekly, "week_start_date", "1998-01-05", "1998-12-28",
        warehouse_name=["Southeast FC", "South FC"], carrier_name="Carrier B", issue_type=["damaged", "missing"],
    )
    return kpis.weekly_issue_rate(kept)


# --- enrichment ------------------------------------------------------------------------------------


@query
def enrich_six_month_window(t):
    return enrich.in_recent_months(t.source["raw_orders"]).select("order_id", "order_purchase_timestamp")


@query
def enrich_warehouse(t):
    return t.enriched.select("order_id", "customer_state", "warehouse_id", "warehouse_name")


@query
def enrich_carrier_assignment(t):
    return t.enriched.select("order_id", "warehouse_id", "carrier_id", "carrier_name")


@query
def enrich_order_category(t):
    return enrich.order_category(t.source["raw_order_items"], t.source["raw_products"], unique_products=True)


@query
def enrich_sla_tier(t):
    return t.assigned["raw_sla_targets"]


@query
def enrich_min_review(t):
    return enrich.worst_review(t.source["raw_reviews"])


@query
def enrich_anomaly_window(t):
    return t.enriched.select("order_id", "anomaly_flag", "anomaly_type")


@query
def enrich_anomaly_window_join(t):
    tagged = enrich.tag_window_join(
        t.enriched.drop("anomaly_id", "anomaly_type", "window_start", "window_end"), config.ordered_windows_df(t.spark, t.rules.windows)
    )
    return tagged.select("order_id", F.coalesce("anomaly_id", F.lit("none")).alias("anomaly_flag"), "anomaly_type")


@query
def enrich_risk_score(t):
    return t.enriched.select("order_id", round_scaled(F.col("issue_probability"), 6).alias("issue_probability"), "synthetic_issue_probability")


@query
def enrich_risk_signals(t):
    return t.enriched.select("order_id", F.array_join(enrich.risk_signals(t.rules.carriers), ";").alias("signals"), "issue_source")


@query
def enrich_issue_type(t):
    return t.enriched.select("order_id", "issue_type", "issue_source")


@query
def enrich_order_count(t):
    return row_counts(t.given)


# --- time joins and changes ------------------------------------------------------------------------


@query
def asof_join(t):
    """Each event with the user's event before it, if that lies within a day."""
    joined = timejoins.asof_join(t.events, t.events, "ts", ["user_id"], ["event_id", "event_type"], strict=True, tolerance_seconds=86_400)
    apart = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("latest.ts").cast("timestamp"))
    return joined.select(
        "event_id", "user_id", F.col("latest.event_id").alias("prior_event_id"), F.col("latest.event_type").alias("prior_event_type"), apart.alias("micros_apart")
    )


@query
def asof_purchase(t):
    """Each error with the user's last purchase at or before it."""
    errors, bought = (t.events.where(F.col("event_type") == kind) for kind in ("error", "purchase"))
    joined = timejoins.asof_join(errors, bought, "ts", ["user_id"], ["event_id", "value"], order=["event_id"])
    return joined.select("event_id", "user_id", F.col("latest.event_id").alias("purchase_id"), F.col("latest.value").alias("purchase_value"))


@query
def overlap_join(t):
    """Visits (a click, for as many minutes as its value) that were open while an outage (an error, for its value in seconds, the large ones in minutes) lasted."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = F.when(F.col("event_type") == "click", 60).when(F.col("value") > 150, 60).otherwise(1)
    spans = t.events.select(
        "event_id", "event_type", F.timestamp_micros(start).alias("starts"), F.timestamp_micros(start + F.floor(F.col("value") * seconds * 1_000_000)).alias("ends")
    )
    kinds = (spans.where(F.col("event_type") == kind).drop("event_type") for kind in ("click", "error"))
    pairs = timejoins.overlap_join(*kinds, ("starts", "ends"), ("starts", "ends"))
    return pairs.select(F.col("l.event_id").alias("visit_id"), F.col("r.event_id").alias("outage_id"))


def _kept_orders(t) -> DataFrame:
    """The later load: all orders but the canceled ones, which are purged."""
    return t.source["raw_orders"].where(~F.col("order_status").eqNullSafe("canceled"))


@query
def dq_table_diff(t):
    return changes.table_diff(t.earlier_orders, _kept_orders(t), ["order_id"])


@query
def table_diff_applied(t):
    old, new = t.earlier_orders, _kept_orders(t)
    return changes.apply_changes(old, stored(changes.change_set(old, new, ["order_id"]), "change-set"), ["order_id"])


@query
def incremental_weekly_quality(t):
    """The weekly mart of the earlier load, refreshed to the whole one."""
    out = scratch_path(t.spark, "weeks")
    old = {**t.source, "raw_orders": t.earlier_orders}
    incremental.build_weeks(old, t.routing, out, t.rules)
    incremental.refresh_weeks(old, t.source, t.routing, out, t.rules, changed=["raw_orders"])
    return incremental.read_weeks(t.spark, out, "agg_weekly_quality_by_segment").select(*marts.agg_weekly_quality(marts.weekly_flag_counts(t.fact)).columns)


# --- streams, subtotals, sketches, calendars, islands ----------------------------------------------


@query
def stream_daily_flag_counts(t):
    """The daily counts of the fact, arriving as a stream of files."""
    arrivals, root = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "daily-stream")
    schema = materialize(t.fact, arrivals).schema
    daily.accept(t.spark, arrivals, schema, root)
    daily.close_days(t.spark, schema, root)
    return daily.current_counts(t.spark, schema, root)


@query
def sla_subtotals(t):
    return rollups.sla_subtotals(t.fact)


@query
def sketch_weekly_delay(t):
    """Weekly distinct shipments and delay quantiles per warehouse, merged from daily sketches, held against the exact figures."""
    fact, keys = stored(t.fact, "sketch-fact"), ["week_start_date", "warehouse_id"]
    days = stored(rollups.daily_sketches(fact, "shipment_id", "delay_days", ["order_purchase_date", "warehouse_id", "carrier_id"]), "sketch-days")
    weeks = rollups.estimated(rollups.merged(days, [F.trunc("order_purchase_date", "week").alias(keys[0]), keys[1]]), keys)
    rows = fact.withColumn(keys[0], F.trunc("order_purchase_date", "week")).join(weeks, keys)
    below = [f(F.col("delay_days"), F.col(p)).cast("int") for p in ("p50", "p90") for f in (lambda a, b: a < b, lambda a, b: a <= b)]
    exact = rows.groupBy(*keys, "rows", "distinct_ids").agg(F.count_distinct("shipment_id").alias("exact_ids"), *(F.avg(b).alias(f"b{i}") for i, b in enumerate(below)))
    near = F.abs(F.col("distinct_ids") - F.col("exact_ids")) <= F.greatest(F.lit(1), F.col("exact_ids") * 0.06)
    # a quantile's own value has a share of the rows: its ranks must enclose the wanted one
    ranks = [(F.col(f"b{2 * i}") <= share + 0.03) & (F.col(f"b{2 * i + 1}") >= share - 0.03) for i, share in enumerate((0.5, 0.9))]
    return exact.select(*keys, "rows", near.alias("distinct_near"), (ranks[0] & ranks[1]).alias("quantiles_near"))


@query
def kpi_shipments_by_segment_approx(t):
    """The approximate count of distinct shipments, held against the exact one."""
    exact = kpis.shipments_by_segment(t.named_fact).withColumnRenamed("shipments", "exact")
    both = kpis.shipments_by_segment(t.named_fact, error=0.01).join(exact, ["warehouse_name", "carrier_name", "sla_breach_flag"])
    near = F.abs(F.col("shipments") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    return both.select("warehouse_name", "carrier_name", "sla_breach_flag", near.alias("shipments_near"))


@query
def calendar_baseline(t):
    return rollups.calendar_baseline(scoring.weekly_segment(t.daily_counts))


@query
def event_sessions(t):
    """Runs of a user's events at most six hours apart."""
    found = rollups.sessions(t.events, ["user_id"], "ts", 6 * 3600, [F.count_if(F.col("event_type") == "purchase").alias("purchases")])
    length = F.unix_micros(F.col("ends").cast("timestamp")) - F.unix_micros(F.col("starts").cast("timestamp"))
    return found.select("user_id", "session", "event_count", "purchases", length.alias("length_micros"))


@query
def flagged_streaks(t):
    return rollups.flagged_streaks(t.results, ["detection_metric", "warehouse_id", "carrier_id"], flag="anomaly_detected")


# --- payloads, quarantine, multisets ---------------------------------------------------------------


@query
def event_payloads(t):
    typed = payloads.with_payload(t.events, "props", {"k": "int"})
    return typed.select("event_id", "event_type", "k", F.array_join("further_keys", ",").alias("further_keys"), "payload_fault")


@query
def src_csv_quarantine(t):
    """Lines of orders of which those in work lack their last values and canceled ones have no day: good rows, and bad lines by reason."""
    path, orders = scratch_path(t.spark, "orders-lines"), t.source["raw_orders"]
    bought = F.when(F.col("order_status") == "canceled", "unknown").otherwise(F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
    values = [F.col("order_id"), F.col("customer_id"), F.col("order_status"), bought]
    rest = [F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")) for c in schemas.RAW_ORDERS.names[4:]]
    line = F.when(F.col("order_status") == "shipped", F.concat_ws(",", *values)).otherwise(F.concat_ws(",", *values, *rest))
    orders.select(line.alias("line")).write.text(path)
    good, bad = read_csv_quarantined(t.spark, path, schemas.RAW_ORDERS, names=schemas.RAW_ORDERS.names)
    kept = good.select(F.lit("good").alias("outcome"), F.coalesce("order_status", F.lit("")).alias("order_status"))
    set_aside = bad.select(F.col("reason").alias("outcome"), F.split("line", ",")[2].alias("order_status"))
    return kept.unionByName(set_aside).groupBy("outcome", "order_status").agg(F.count(F.lit(1)).alias("lines"))


@query
def dq_multiset_diff(t):
    """Combinations of customer, status and promised day whose numbers of orders differ between the earlier load and the later one."""
    columns = ["customer_id", "order_status", "order_estimated_delivery_date"]
    both = changes.multiset_diff(t.earlier_orders.select(*columns), _kept_orders(t).select(*columns))
    return both.where(F.col("left_count") != F.col("right_count"))
