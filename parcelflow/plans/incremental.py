"""Marts by week, and their refresh from the difference of two loads: only weeks with changes are built again.

The fact and both aggregates are tables partitioned by purchase week. A refresh compares the loads, follows each change to the
orders that it reaches and these to their weeks before and after, builds those weeks from the new load, and swaps their
partitions. Files of other weeks are not touched. It can be run again after a failure: it reads the loads only, and
a week is swapped whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.lookups import unique_lookup
from parcelflow.functions.scalars import week_start
from parcelflow.functions.scratch import discard, stored
from parcelflow.operators import staging
from parcelflow.operators.changes import table_diff
from parcelflow.operators.enrich import enrich_orders
from parcelflow.plans import marts

WEEK = "week_start_date"
#: What identifies a row of each source that the marts depend on.
SOURCE_KEYS = {"raw_orders": "order_id", "raw_order_items": "order_id", "raw_reviews": "order_id", "raw_customers": "customer_id", "raw_products": "product_id"}
TABLES = ("fct_shipments", "agg_daily_sla_performance", "agg_weekly_quality_by_segment")


def _purchase_week() -> Column:
    return week_start(F.col("order_purchase_timestamp").cast("date"))


def touched_weeks(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], changed: Iterable[str] = tuple(SOURCE_KEYS)) -> list[date]:
    """The purchase weeks, before or after, of all orders that a change in the tables named in `changed` reaches.

    Only distinct weeks come to the driver: 52 a year of history.
    """
    orders = old["raw_orders"].select("order_id", "customer_id", _purchase_week().alias(WEEK))
    orders = orders.unionByName(new["raw_orders"].select("order_id", "customer_id", _purchase_week().alias(WEEK)))
    reached = []
    for name in changed:
        key = SOURCE_KEYS[name]
        keys = stored(table_diff(old[name], new[name], [key]).select(key), f"changed-{name}")
        if name == "raw_products":
            items = old["raw_order_items"].unionByName(new["raw_order_items"]).select("order_id", key)
            keys, key = items.join(keys, key, "left_semi").select("order_id").distinct(), "order_id"
        reached.append(orders.join(keys, key, "left_semi").select(WEEK))
    weeks = reached[0]
    for part in reached[1:]:
        weeks = weeks.unionByName(part)
    return sorted(r[0] for r in weeks.where(F.col(WEEK).isNotNull()).distinct().collect())


def _built(sources: Mapping[str, DataFrame], routing: DataFrame, rules: config.Rules, weeks: list[date] | None) -> dict[str, DataFrame]:
    """The three tables with their week, over all orders or those of some weeks."""
    orders = sources["raw_orders"]
    if weeks is not None:
        # the bounds reach the scan as a filter on the timestamp, the weeks cut the rest
        bought = F.col("order_purchase_timestamp")
        orders = orders.where((bought >= F.lit(weeks[0])) & (bought < F.date_add(F.lit(weeks[-1]), 7)) & _purchase_week().isin(weeks))
    states = stored(unique_lookup(sources["raw_customers"], "customer_id", "customer_state"), "week-states")
    categories = stored(unique_lookup(sources["raw_products"], "product_id", "product_category_name"), "week-categories")
    enriched = enrich_orders(orders, states, sources["raw_order_items"], categories, sources["raw_reviews"], routing, rules, None, unique_keys=True)
    fact = stored(staging.fact_of(enriched), "week-fact")
    week = week_start(F.col("order_purchase_date"))
    return {
        "fct_shipments": fact.withColumn(WEEK, week),
        "agg_daily_sla_performance": stored(marts.agg_daily_sla(fact).withColumn(WEEK, week), "week-daily"),
        "agg_weekly_quality_by_segment": stored(marts.agg_weekly_quality(marts.weekly_flag_counts(fact)), "week-quality"),
    }


def swap_weeks(df: DataFrame, path: str, weeks: Iterable[date] | None = None) -> None:
    """Replace the partitions of `weeks` in the table at `path` by the rows of `df`, a written table; without `weeks` the whole table.

    Weeks with rows are overwritten in one commit, those without any are deleted after it.
    """
    writer = df.hint("rebalance", WEEK).sortWithinPartitions(WEEK).write.mode("overwrite").partitionBy(WEEK)
    writer.option("partitionOverwriteMode", "static" if weeks is None else "dynamic").parquet(path)
    if weeks is not None:
        for week in set(weeks) - {r[0] for r in df.select(WEEK).distinct().collect()}:
            discard(df.sparkSession, f"{path}/{WEEK}={week}")


def build_weeks(sources: Mapping[str, DataFrame], routing: DataFrame, out_dir: str, rules: config.Rules = config.Rules()) -> None:
    """All weeks of the three tables, from one load."""
    for name, df in _built(sources, routing, rules, None).items():
        swap_weeks(df, f"{out_dir}/{name}")


def refresh_weeks(
    old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], routing: DataFrame, out_dir: str,
    rules: config.Rules = config.Rules(), changed: Iterable[str] = tuple(SOURCE_KEYS),
) -> list[date]:
    """Bring the tables in `out_dir`, built from the load `old`, to the load `new`; returns the weeks that were built again."""
    weeks = touched_weeks(old, new, changed)
    if weeks:
        for name, df in _built(new, routing, rules, weeks).items():
            swap_weeks(df, f"{out_dir}/{name}", weeks)
    return weeks


def read_weeks(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table by weeks; a filter on the week prunes partitions."""
    return spark.read.parquet(f"{out_dir}/{name}")
