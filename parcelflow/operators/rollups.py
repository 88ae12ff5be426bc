"""Subtotals in one pass, mergeable sketches, value frames over a calendar, and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scalars import percentage
from parcelflow.functions.scratch import stored
from parcelflow.operators.timejoins import CHUNK_POINTS, chunk_micros

#: A HyperLogLog sketch of 2^LOG_REGISTERS registers has a relative standard error of 1.04 / sqrt(2^LOG_REGISTERS), 1.6 % here; a
#: KLL sketch with this k has ranks within 1.7 % for 99 of 100 quantiles.
LOG_REGISTERS, KLL_K = 12, 200
SLA_KEYS = ("warehouse_id", "carrier_id", "sla_tier")


def sla_subtotals(fact: DataFrame, keys: Sequence[str] = SLA_KEYS) -> DataFrame:
    """Shipments and SLA attainment by every subset of `keys`, in one pass: each row is expanded once per subset and combined before the shuffle.

    `grouping_id` has a bit for each key, the first key's the highest, set where the row is a subtotal over it. So a subtotal
    is told from a key that is NULL.
    """
    breached = F.col("sla_breach_flag")
    counts = fact.cube(*keys).agg(F.grouping_id().alias("grouping_id"), F.count(F.lit(1)).alias("shipment_count"), F.count_if(breached).alias("sla_breach_count"))
    met = percentage(F.col("shipment_count") - F.col("sla_breach_count"), F.col("shipment_count"))
    return counts.select(*keys, F.col("grouping_id").cast("int").alias("grouping_id"), "shipment_count", "sla_breach_count", met.alias("sla_attainment_pct"))


# --- sketches --------------------------------------------------------------------------------------


def daily_sketches(fact: DataFrame, distinct: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Per `keys` the rows, a HyperLogLog sketch of the ids in `distinct` and a KLL sketch of `value`, both as binary columns of bounded size."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(LOG_REGISTERS)).alias("ids"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("quantiles"),
    )


def merged(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches of coarser keys from finer ones, without the rows they were made of; the order of merging does not matter for the ids."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("quantiles").alias("quantiles")
    )


def estimated(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Estimated number of distinct ids and quantiles of merged sketches."""
    quantiles = [F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(s))).alias(f"p{round(100 * s)}") for s in shares]
    return sketches.select(*keys, "rows", F.hll_sketch_estimate("ids").alias("distinct_ids"), *quantiles)


# --- calendar --------------------------------------------------------------------------------------


def with_all_weeks(segments: DataFrame, keys: Sequence[str], week: str = "week_start_date", zeros: Sequence[str] = ()) -> DataFrame:
    """`segments` with a row for every week between the first and the last of their keys; the counts in `zeros` are 0 in added weeks, other columns NULL."""
    spans = segments.groupBy(*keys).agg(F.min(week).alias("first_week"), F.max(week).alias("last_week"))
    weeks = spans.select(*keys, F.explode(F.sequence("first_week", "last_week", F.expr("interval 7 days"))).alias(week))
    full = weeks.join(segments, [*keys, week], "left")
    return full.withColumns({c: F.coalesce(c, F.lit(0)) for c in zeros})


def calendar_baseline(segments: DataFrame, keys: Sequence[str] = ("warehouse_id", "carrier_id"), days: int = 28) -> DataFrame:
    """For each week the pooled breach rate of its segment over the `days` calendar days before it, and how many of these weeks had no shipment.

    A value frame over the date: present weeks that lie further back do not count, unlike in a frame of so many present rows.
    """
    number = F.datediff(F.col("week_start_date"), F.lit("1970-01-01").cast("date"))
    full = with_all_weeks(segments, keys, zeros=("shipment_count", "sla_breach_count")).withColumn("day_number", number)
    frame = Window.partitionBy(*keys).orderBy("day_number").rangeBetween(-days, -1)
    rows = Window.partitionBy(*keys).orderBy("day_number").rowsBetween(-days // 7, -1)
    framed = full.withColumns(
        {
            "baseline_shipments": F.coalesce(F.sum("shipment_count").over(frame), F.lit(0)),
            "baseline_breaches": F.coalesce(F.sum("sla_breach_count").over(frame), F.lit(0)),
            "empty_weeks": F.count_if(F.col("shipment_count") == 0).over(rows),
        }
    )
    rate = percentage(F.col("baseline_breaches"), F.col("baseline_shipments"), 4)
    return framed.where(F.col("shipment_count") > 0).select(
        "week_start_date", *keys, "shipment_count", "sla_breach_count", "baseline_shipments", "baseline_breaches", "empty_weeks", rate.alias("baseline_breach_pct")
    )


# --- islands ---------------------------------------------------------------------------------------


def sessions(events: DataFrame, by: Sequence[str], on: str, gap_seconds: float, measures: Sequence[Column] = (), points_each: int = CHUNK_POINTS) -> DataFrame:
    """`by`, `session` (from 1), `starts`, `ends`, `event_count` and `measures` of each run of events that lie at most `gap_seconds` apart.

    Rows with a NULL key or time belong to no session. A key's events fall into chunks of time, so a hot key is spread over tasks: a
    chunk looks back inside itself, and the seams are mended from the last moment and the number of starts of each
    chunk, of which a key has few. Sessions are combined before they are shuffled, so one that crosses chunks is summed.
    """
    by, micros = list(by), F.unix_micros(F.col(on).cast("timestamp"))
    rows = events
    for c in (*by, on):
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.withColumn("at", micros)
    width = chunk_micros(rows.select(*by, "at"), by, points_each)
    chunked = rows.withColumn("chunk", F.floor(F.col("at") / F.lit(width)).cast("long"))
    inside = Window.partitionBy(*by, "chunk").orderBy("at")
    limit = F.lit(int(gap_seconds * 1_000_000))
    looked = chunked.withColumn("before", F.lag("at").over(inside))
    # the first event of a chunk starts nothing yet: that is decided at the seam
    looked = looked.withColumn("starts_here", F.coalesce((F.col("at") - F.col("before") > limit).cast("long"), F.lit(0)))
    looked = stored(looked.withColumn("nth", F.sum("starts_here").over(inside)), "session-events")
    chunks = looked.groupBy(*by, "chunk").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.sum("starts_here").alias("started"))
    order = Window.partitionBy(*by).orderBy("chunk")
    apart = F.col("first_at") - F.lag("last_at").over(order)
    seams = chunks.withColumn("fresh", F.coalesce((apart > limit).cast("long"), F.lit(1)))
    earlier = F.sum(F.col("fresh") + F.col("started")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("started")
    numbered = looked.join(seams.select(*by, "chunk", earlier.alias("earlier")), [*by, "chunk"])
    numbered = numbered.withColumn("session", F.col("earlier") + F.col("nth"))
    return numbered.groupBy(*by, "session").agg(F.min(on).alias("starts"), F.max(on).alias("ends"), F.count(F.lit(1)).alias("event_count"), *measures)


def flagged_streaks(results: DataFrame, keys: Sequence[str], week: str = "week_start_date", flag: str = "is_flagged", step_days: int = 7) -> DataFrame:
    """`keys`, `first_week`, `last_week`, `weeks` of each run of consecutive flagged weeks: their date less their place among them is constant."""
    flagged = results.where(F.col(flag)).select(*keys, week).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(week))
    island = F.date_sub(F.col(week), (place * step_days).cast("int"))
    runs = flagged.withColumn("island", island).groupBy(*keys, "island")
    return runs.agg(F.min(week).alias("first_week"), F.max(week).alias("last_week"), F.count(F.lit(1)).alias("weeks")).drop("island")
