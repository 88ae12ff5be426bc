"""The run from source tables to written marts, results and exports.

Staging stays lazy; assignments, fact, dimensions, aggregates and results are written tables. Each is
computed once from the tables before it, and a lost executor costs no more than its own stage.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.lookups import unique_lookup
from parcelflow.operators import quality, scoring, staging
from parcelflow.operators.enrich import ASSIGNMENT_COLUMNS, assignment_tables, enrich_orders, in_recent_months, warehouse_routing
from parcelflow.plans import exports, findings, marts
from parcelflow.sources import schemas
from parcelflow.sources.tables import load_bronze, materialize, read_config, read_tables, row_counts, write_csv

ACCEPTED_ISSUES = {"issue_type": config.ISSUE_TYPES}

SUITE = {
    "stg_orders": quality.TableChecks(not_null=("order_id",), unique=("order_id",)),
    "stg_shipments": quality.TableChecks(
        not_null=("shipment_id", "order_id"),
        unique=("shipment_id",),
        relationships=(
            ("order_id", "stg_orders", "order_id"),
            ("warehouse_id", "raw_warehouse_assignments", "warehouse_id"),
            ("carrier_id", "raw_carrier_assignments", "carrier_id"),
        ),
        date_order=True,
    ),
    "stg_issues": quality.TableChecks(accepted=ACCEPTED_ISSUES),
    "fct_shipments": quality.TableChecks(
        not_null=("shipment_id",),
        unique=("shipment_id",),
        relationships=(
            ("warehouse_id", "dim_warehouse", "warehouse_id"),
            ("carrier_id", "dim_carrier", "carrier_id"),
            ("category_name", "dim_category", "category_name"),
        ),
    ),
    "dim_warehouse": quality.TableChecks(not_null=("warehouse_id",), unique=("warehouse_id",)),
    "dim_carrier": quality.TableChecks(not_null=("carrier_id",), unique=("carrier_id",)),
    "dim_category": quality.TableChecks(not_null=("category_name",), unique=("category_name",)),
    "dim_date": quality.TableChecks(not_null=("date_day",), unique=("date_day",)),
    "agg_daily_sla_performance": quality.TableChecks(
        not_null=("order_purchase_date", "warehouse_id", "carrier_id", "sla_tier"),
        relationships=(("warehouse_id", "dim_warehouse", "warehouse_id"), ("carrier_id", "dim_carrier", "carrier_id")),
    ),
    "agg_weekly_quality_by_segment": quality.TableChecks(
        not_null=("week_start_date", "warehouse_id", "carrier_id", "category_name", "issue_type"),
        accepted=ACCEPTED_ISSUES,
        relationships=(("warehouse_id", "dim_warehouse", "warehouse_id"), ("carrier_id", "dim_carrier", "carrier_id")),
    ),
}


def build_marts(
    sources: Mapping[str, DataFrame],
    routing: DataFrame | None,
    out_dir: str,
    rules: config.Rules = config.Rules(),
    months: int | None = config.WINDOW_MONTHS,
    windows: DataFrame | None = None,
    assignments: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Enrich, write the marts, and return all tables by name.

    With `assignments` (the four tables by name), warehouses, carriers, targets and issues are those given, and only orders that
    all four list are enriched; without, they are routed and drawn by the rules.

    The enriched orders are written once as one wide table; the assignment tables are projections of it,
    so the fact needs no join by order id. `windows` is a window table of any length, joined in place of the
    list in `rules`.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, f"{out_dir}/{name}")

    orders, customers = sources["raw_orders"], sources["raw_customers"]
    # Lookups as written tables: the orders of a hot customer and the items of a hot product are then split.
    states = write("customer_states", unique_lookup(customers, "customer_id", "customer_state"))
    if assignments:
        enriched = write("enriched_orders", staging.assigned_orders(orders.where(F.col("order_purchase_timestamp").isNotNull()), states, assignments))
    else:
        categories = write("product_categories", unique_lookup(sources["raw_products"], "product_id", "product_category_name"))
        wide = enrich_orders(
            orders, states, sources["raw_order_items"], categories, sources["raw_reviews"], routing, rules, months, unique_keys=True, windows=windows
        )
        enriched = write("enriched_orders", wide)
    assigned = assignment_tables(enriched)
    tables = dict(assigned)
    # written, as three checks and every reader use it
    tables["stg_orders"] = write("stg_orders", staging.orders_of(orders, customers, enriched))
    tables["stg_shipments"] = staging.shipments_of(enriched)
    tables["stg_issues"] = staging.stg_issues(assigned["raw_issue_flags"])

    # Sorted files let a date filter skip row groups; the sort is within tasks and shuffles nothing.
    fact = write("fct_shipments", staging.fact_of(enriched).sortWithinPartitions("order_purchase_date"))
    tables["fct_shipments"] = fact
    tables["dim_warehouse"] = write("dim_warehouse", marts.dim_warehouse(assigned["raw_warehouse_assignments"]))
    tables["dim_carrier"] = write("dim_carrier", marts.dim_carrier(assigned["raw_carrier_assignments"]))
    tables["dim_category"] = write("dim_category", marts.dim_category(assigned["raw_sla_targets"]))
    tables["dim_date"] = write("dim_date", marts.dim_date(fact))
    tables["agg_daily_sla_performance"] = write("agg_daily_sla_performance", marts.agg_daily_sla(fact))
    tables["agg_weekly_quality_by_segment"] = write(
        "agg_weekly_quality_by_segment", marts.agg_weekly_quality(marts.weekly_flag_counts(fact))
    )
    return tables


def detect(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str, rules: config.Rules = config.Rules(), **params) -> dict[str, DataFrame]:
    """Score the segments of the written marts and judge the known labels."""
    results = materialize(
        scoring.anomaly_results(
            tables["fct_shipments"], tables["dim_warehouse"], tables["dim_carrier"], tuple(rules.validation_metrics), **params
        ),
        f"{out_dir}/anomaly_results",
    )
    summary = scoring.anomaly_summary(results, config.label_metrics_df(spark, rules.validation_metrics))
    return {"anomaly_results": results, "anomaly_validation_summary": materialize(summary, f"{out_dir}/anomaly_validation_summary")}


def validation_report(
    spark: SparkSession, sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], rules: config.Rules, months: int | None, drawn: bool = True
) -> DataFrame:
    """The checks of a whole run besides `SUITE`, in the same columns.

    No table is empty, no source key is blank; the drawn assignments have as many rows as orders in the window; every known label occurs in the
    issue flags, is detected, and by its own metric.
    """
    counts = row_counts({**sources, **{name: tables[name] for name in (*ASSIGNMENT_COLUMNS, *SUITE)}})
    parts = [quality.reported("row_count", "all tables", None, quality.empty_tables(counts))]
    keyed = {name: df for name, df in sources.items() if "order_id" in df.columns}
    parts.append(quality.reported("blank_key", "all sources", "order_id", quality.blank_keys(keyed, "order_id")))
    if drawn:
        orders = sources["raw_orders"]
        kept = in_recent_months(orders, months) if months else orders.where(F.col("order_purchase_timestamp").isNotNull())
        expected = kept.agg(F.count(F.lit(1)).alias("expected_rows"))
        parts.append(quality.reported("exact_count", "assignments", None, quality.unexpected_counts(counts, expected, exact=ASSIGNMENT_COLUMNS, larger=())))
    flags = tables["raw_issue_flags"]
    parts.append(quality.reported("required_values", "raw_issue_flags", "anomaly_flag", quality.missing_values(flags, "anomaly_flag", rules.labels)))
    expected = config.label_metrics_df(spark, rules.validation_metrics)
    parts.append(quality.reported("detection", "anomaly_validation_summary", "anomaly_id", quality.missed_labels(tables["anomaly_validation_summary"], expected)))
    return reduce(DataFrame.unionByName, parts)


def export_all(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, int]:
    """Write the four dashboard exports; returns their row counts."""
    names = tables["dim_warehouse"], tables["dim_carrier"]
    frames = {
        "fct_shipments_dashboard": exports.shipments(tables["fct_shipments"], *names),
        "daily_sla_performance": exports.daily_sla(tables["agg_daily_sla_performance"], *names),
        "weekly_quality_by_segment": exports.weekly_quality(tables["agg_weekly_quality_by_segment"], *names),
    }
    counts = {name: exports.export_sorted(df, name, out_dir) for name, df in frames.items()}
    counts["anomaly_summary"] = exports.export_summary(tables["anomaly_validation_summary"], out_dir).count()
    return counts


def export_assignments(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, int]:
    """Write the four assignment tables as CSV; returns their row counts."""
    return {name: write_csv(tables[name].select(*columns), f"{out_dir}/{name}") for name, columns in ASSIGNMENT_COLUMNS.items()}


def run(
    spark: SparkSession,
    source_paths: Mapping[str, str],
    config_dir: str,
    out_dir: str,
    months: int | None = config.WINDOW_MONTHS,
    multi_line: tuple[str, ...] = (),
    assignment_paths: Mapping[str, str] | None = None,
    **params,
) -> dict[str, DataFrame]:
    """The whole run: load the source CSVs, enrich, build, detect, export, check.

    Windows are joined as a table, so there may be any number. Source tables named in `multi_line` may hold
    line breaks inside quoted values, but then each of their files is one task. `assignment_paths` names CSVs of the four
    assignment tables, which are then used instead of drawn ones. Returns all tables, with the check report as
    `quality_report`, and the findings as `findings`.
    """
    load_bronze(spark, source_paths, f"{out_dir}/bronze", multi_line=multi_line)
    bronze = read_tables(spark, f"{out_dir}/bronze", source_paths)
    frames = read_config(spark, config_dir)
    rules = config.rules_from(frames)
    routing = materialize(warehouse_routing(frames["warehouses"], config.overrides_df(spark)), f"{out_dir}/marts/routing")
    windows = materialize(frames["anomaly_windows"].withColumn("position", F.monotonically_increasing_id()), f"{out_dir}/marts/windows")
    assignments = None
    if assignment_paths:
        load_bronze(spark, assignment_paths, f"{out_dir}/bronze", schema_of=schemas.ASSIGNMENT_TABLES)
        assignments = read_tables(spark, f"{out_dir}/bronze", assignment_paths)
    tables = build_marts(bronze, routing, f"{out_dir}/marts", rules, months, windows, assignments)
    tables |= detect(spark, tables, f"{out_dir}/results", rules, **params)
    counts = materialize(scoring.daily_flag_counts(tables["fct_shipments"]), f"{out_dir}/results/daily_flag_counts")
    text = findings.findings_text(counts, windows, tables["anomaly_results"], tables["anomaly_validation_summary"])
    tables["findings"] = materialize(text, f"{out_dir}/results/findings")
    export_assignments(tables, f"{out_dir}/assignments")
    export_all(tables, f"{out_dir}/exports")
    checks = quality.suite_report(tables, SUITE).unionByName(validation_report(spark, bronze, tables, rules, months, drawn=assignments is None))
    report = materialize(checks, f"{out_dir}/results/quality_report")
    return {**bronze, **tables, "quality_report": report}
