"""Order enrichment: warehouse, carrier, category, SLA tier, risk and issue of every order.

The joins are one lookup by customer, one by state and two by order id. Everything else is column
arithmetic on the joined row. Draws are stable hashes of the order id, so a retried or repeated task
gives the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.lookups import unique_lookup
from parcelflow.functions.scalars import days_between, hash_unit, is_blank, pick_weighted
from parcelflow.functions.scratch import stored


def order_date() -> Column:
    return F.col("order_purchase_timestamp").cast("date")


# --- six complete months ---------------------------------------------------------------------------


def recent_months(orders: DataFrame, months: int = config.WINDOW_MONTHS, complete_day: int = config.COMPLETE_MONTH_DAY) -> DataFrame:
    """One row: first and last day of the last `months` complete months.

    The latest month counts as complete from its `complete_day` on.
    """
    last = F.max(order_date())
    bounds = orders.agg(last.alias("last_day"))
    latest = F.trunc("last_day", "month")
    latest = F.when(F.dayofmonth("last_day") >= complete_day, latest).otherwise(F.add_months(latest, -1))
    return bounds.select(F.add_months(latest, 1 - months).alias("start_date"), F.last_day(latest).alias("end_date"))


def in_recent_months(orders: DataFrame, months: int = config.WINDOW_MONTHS) -> DataFrame:
    """Orders bought in the last complete months; the bounds are scalar subqueries, so nothing is joined."""
    bounds = recent_months(orders, months)
    return orders.where(order_date().between(bounds.select("start_date").scalar(), bounds.select("end_date").scalar()))


# --- warehouse -------------------------------------------------------------------------------------


def warehouse_routing(warehouses: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per state: its warehouse by the state lists, unless an override names another.

    `warehouses` holds ';'-separated `assigned_states`; `overrides` holds `customer_state, warehouse_id`.
    """
    listed = warehouses.select(
        F.explode(F.split("assigned_states", ";")).alias("customer_state"), "warehouse_id", F.lit(0).alias("priority")
    )
    forced = overrides.select("customer_state", "warehouse_id", F.lit(1).alias("priority"))
    return (
        listed.unionByName(forced)
        .groupBy("customer_state")
        .agg(F.max_by("warehouse_id", F.struct("priority", "warehouse_id")).alias("warehouse_id"))
        .join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
        .select("customer_state", "warehouse_id", "warehouse_name")
    )


def route_warehouse(orders: DataFrame, routing: DataFrame, default: tuple[str, str]) -> DataFrame:
    """Add the warehouse of `customer_state`; an unknown state goes to the default warehouse.

    Give `routing` as a written table: Spark then knows how small it is and does not shuffle the orders by
    a few states.
    """
    routed = orders.join(routing, "customer_state", "left")
    return routed.withColumns(
        {
            "warehouse_id": F.coalesce("warehouse_id", F.lit(default[0])),
            "warehouse_name": F.coalesce("warehouse_name", F.lit(default[1])),
        }
    )


# --- carrier ---------------------------------------------------------------------------------------


def is_exception(carrier_id: Column, warehouse_id: Column, carriers) -> Column:
    """Whether the carrier is flagged as weak in that warehouse."""
    flagged = F.lit(False)
    for c in carriers:
        if c.warehouse_exception:
            flagged = flagged | ((carrier_id == c.carrier_id) & (warehouse_id == c.warehouse_exception))
    return flagged


def assign_carrier(orders: DataFrame, carriers, salt: str = "c") -> DataFrame:
    """Weighted carrier choice; a flagged carrier gets a larger share of its exception warehouse."""

    def weight(c: config.Carrier):
        if not c.warehouse_exception:
            return c.weight
        at_exception = F.col("warehouse_id") == c.warehouse_exception
        return F.when(at_exception, c.weight + config.EXCEPTION_WEIGHT).otherwise(c.weight)

    picked = pick_weighted(hash_unit(F.col("order_id"), salt), [(c.carrier_id, weight(c)) for c in carriers])
    with_id = orders.withColumn("carrier_id", picked)
    name = F.lit(None).cast("string")
    for c in carriers:
        name = F.when(F.col("carrier_id") == c.carrier_id, c.carrier_name).otherwise(name)
    return with_id.withColumn("carrier_name", name)


# --- category and SLA tier -------------------------------------------------------------------------


def order_category(items: DataFrame, products: DataFrame, unique_products: bool = False) -> DataFrame:
    """Most frequent non-blank category per order, ties by name; orders without one are absent.

    `mode` combines on the map side into one small count map per order, so a single shuffle by order id
    does and copies of a hot order or product collapse before it. Unless `unique_products`, repeated product
    ids are removed first, and the lookup is written to the scratch folder: a join with a written table has
    plain exchanges on both sides, so the items of a hot product are split.
    """
    known = products if unique_products else stored(unique_lookup(products, "product_id", "product_category_name"), "product-categories")
    known = known.where(~is_blank(F.col("product_category_name")))
    return (
        items.join(known, "product_id")
        .groupBy("order_id")
        .agg(F.mode("product_category_name", True).alias("category_name"))
    )


def sla_tier(category: Column, bulky_keywords, fast_keywords) -> Column:
    """Tier by keyword in the category name; bulky wins over fast."""
    name = F.lower(category)

    def holds_any(keywords):
        found = F.lit(False)
        for keyword in keywords:
            found = found | F.contains(name, F.lit(keyword))
        return found

    return F.when(holds_any(bulky_keywords), "bulky").when(holds_any(fast_keywords), "fast").otherwise("standard")


def assign_sla(orders: DataFrame, rules: config.Rules) -> DataFrame:
    """Add tier and target days of `category_name`."""
    tiered = orders.withColumn("sla_tier", sla_tier(F.col("category_name"), rules.bulky_keywords, rules.fast_keywords))
    days = F.lit(None).cast("int")
    for target in rules.sla_targets:
        days = F.when(F.col("sla_tier") == target.sla_tier, F.lit(target.target_days)).otherwise(days)
    return tiered.withColumn("sla_target_days", days)


def worst_review(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.min("review_score").alias("review_score"))


# --- known windows, risk and issue -----------------------------------------------------------------


def in_window(w: config.AnomalyWindow) -> Column:
    """Whether the order lies in the window: date range, warehouse, and carrier unless it is open."""
    hit = order_date().between(F.lit(w.start_date), F.lit(w.end_date)) & (F.col("warehouse_id") == w.affected_warehouse_id)
    return hit & (F.col("carrier_id") == w.affected_carrier_id) if w.affected_carrier_id else hit


def tag_window(orders: DataFrame, windows) -> DataFrame:
    """Add id, type, start and end of the first window, in config order, that holds the order.

    For a short list: each window is a branch of one expression and nothing is joined.
    """
    found = F.lit(None).cast("struct<anomaly_id:string,anomaly_type:string,window_start:date,window_end:date>")
    for w in reversed(windows):
        window = F.struct(
            F.lit(w.anomaly_id).alias("anomaly_id"), F.lit(w.anomaly_type).alias("anomaly_type"),
            F.lit(w.start_date).alias("window_start"), F.lit(w.end_date).alias("window_end"),
        )
        found = F.when(in_window(w), window).otherwise(found)
    return orders.withColumn("window", found).select(
        *orders.columns, "window.anomaly_id", "window.anomaly_type", "window.window_start", "window.window_end"
    )


def tag_window_join(orders: DataFrame, windows: DataFrame) -> DataFrame:
    """`tag_window` for a window table of any length; `windows` has a `position` that gives their order.

    Windows are spread over their days and reduced to the first one per day, warehouse and carrier, and
    likewise for those open to any carrier. Both are equality joins on unique keys: no order is paired
    with a window that does not hold it, and no order is repeated.
    """
    daily = windows.where(F.col("start_date") <= F.col("end_date")).select(
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("order_day"),
        F.col("affected_warehouse_id").alias("warehouse_id"),
        F.col("affected_carrier_id").alias("carrier_id"),
        F.struct("position", "anomaly_id", "anomaly_type", "start_date", "end_date").alias("window"),
    )

    def first(rows: DataFrame, name: str, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min("window").alias(name))

    named = first(daily.where(F.col("carrier_id").isNotNull()), "named", "order_day", "warehouse_id", "carrier_id")
    opened = first(daily.where(F.col("carrier_id").isNull()), "opened", "order_day", "warehouse_id")
    joined = (
        orders.withColumn("order_day", order_date())
        .join(named, ["order_day", "warehouse_id", "carrier_id"], "left")
        .join(opened, ["order_day", "warehouse_id"], "left")
        .withColumn("window", F.least("named", "opened"))
    )
    return joined.select(
        *orders.columns, "window.anomaly_id", "window.anomaly_type",
        F.col("window.start_date").alias("window_start"), F.col("window.end_date").alias("window_end"),
    )


def window_risk() -> Column:
    """Extra risk in a window: a constant in a spike, growing with the elapsed share in a drift."""
    span = F.greatest(days_between(F.col("window_start"), F.col("window_end")), F.lit(1))
    elapsed = days_between(F.col("window_start"), order_date()) / span
    return (
        F.when(F.col("anomaly_type") == config.SPIKE_TYPE, config.SPIKE_RISK)
        .when(F.col("anomaly_type") == config.DRIFT_TYPE, F.lit(config.DRIFT_RISK) + F.lit(config.DRIFT_SLOPE) * elapsed)
        .otherwise(0.0)
    )


def _signals(carriers) -> list[tuple[str, Column]]:
    """Reasons that raise the risk of an order, in the order in which they are recorded."""
    late = F.col("order_delivered_customer_date").cast("date") > F.col("order_estimated_delivery_date").cast("date")
    return [
        ("late_delivery", late),
        ("low_review", F.col("review_score") <= config.LOW_REVIEW_SCORE),
        ("carrier_reliability", F.col("carrier_id") == config.WEAK_CARRIER),
        ("warehouse_carrier_weakness", is_exception(F.col("carrier_id"), F.col("warehouse_id"), carriers)),
        ("injected_anomaly", F.col("anomaly_id").isNotNull()),
        ("order_canceled", F.col("order_status") == "canceled"),
    ]


def risk_signals(carriers) -> Column:
    """Array of the signals that hold, in recorded order."""
    return F.array_compact(F.array(*(F.when(holds, name) for name, holds in _signals(carriers))))


def risk_score(carriers) -> Column:
    holds = dict(_signals(carriers))

    def add(name: str, amount: float) -> Column:
        return F.when(holds[name], amount).otherwise(0.0)

    score = (
        F.lit(config.BASE_RISK)
        + add("late_delivery", config.LATE_RISK)
        + add("low_review", config.LOW_REVIEW_RISK)
        + add("carrier_reliability", config.WEAK_CARRIER_RISK)
        + add("warehouse_carrier_weakness", config.EXCEPTION_RISK)
        + window_risk()
    )
    score = F.when(holds["order_canceled"], F.greatest(score, F.lit(config.CANCELED_RISK))).otherwise(score)
    return F.least(score, F.lit(config.MAX_RISK))


def score_risk(orders: DataFrame, rules: config.Rules) -> DataFrame:
    """Add `issue_probability`, unrounded; needs the tagged window and `review_score`."""
    return orders.withColumn("issue_probability", risk_score(rules.carriers))


def draw_issue(orders: DataFrame, rules: config.Rules, salt: str = "i", type_salt: str = "t") -> DataFrame:
    """Add `issue_type` and `issue_source`: canceled orders, then a draw against the risk."""
    unit = hash_unit(F.col("order_id"), salt)
    type_unit = hash_unit(F.col("order_id"), type_salt)
    issue = (
        F.when(F.col("order_status") == "canceled", "cancelled")
        .when(unit >= F.col("issue_probability"), "none")
        .when(F.col("anomaly_type") == config.SPIKE_TYPE, pick_weighted(type_unit, config.SPIKE_ISSUES))
        .when(F.col("anomaly_type") == config.DRIFT_TYPE, pick_weighted(type_unit, config.DRIFT_ISSUES))
        .otherwise(pick_weighted(type_unit, [(name, 0.2) for name in config.BASE_ISSUES]))
    )
    last_signal = F.coalesce(
        *(F.when(holds, name) for name, holds in reversed(_signals(rules.carriers))), F.lit(config.BASELINE_SOURCE)
    )
    source = F.when(F.col("issue_type") == "none", "none").otherwise(last_signal)
    return orders.withColumn("issue_type", issue).withColumn("issue_source", source)


# --- the whole row ---------------------------------------------------------------------------------


def with_customer_state(orders: DataFrame, customers: DataFrame, unique_customers: bool = False) -> DataFrame:
    """Add the state of the customer. The orders side of the join is split where one customer is hot.

    Unless `unique_customers`, repeated customer ids are removed first, and the lookup is written to the
    scratch folder, as in `order_category`.
    """
    states = customers if unique_customers else stored(unique_lookup(customers, "customer_id", "customer_state"), "customer-states")
    return orders.join(states.select("customer_id", "customer_state"), "customer_id", "left")


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    routing: DataFrame,
    rules: config.Rules = config.Rules(),
    months: int | None = config.WINDOW_MONTHS,
    unique_keys: bool = False,
    windows: DataFrame | None = None,
) -> DataFrame:
    """One wide row per order with everything the assignment tables hold.

    `months=None` keeps the whole history instead of the last complete months; orders without a purchase
    time are dropped in both cases. `unique_keys` states that customer and product ids are known to be
    unique (`quality.duplicates` tells); else two lookups without repeated ids are written first. `windows` is a window table to join
    in place of the short list in `rules`.
    """
    kept = in_recent_months(orders, months) if months else orders.where(F.col("order_purchase_timestamp").isNotNull())
    routed = route_warehouse(with_customer_state(kept, customers, unique_keys), routing, rules.default_warehouse)
    with_carrier = assign_carrier(routed, rules.carriers)
    joined = with_carrier.join(order_category(items, products, unique_keys), "order_id", "left").join(worst_review(reviews), "order_id", "left")
    tiered = assign_sla(joined.withColumn("category_name", F.coalesce("category_name", F.lit(config.UNKNOWN_CATEGORY))), rules)
    tagged = tag_window(tiered, rules.windows) if windows is None else tag_window_join(tiered, windows)
    issued = draw_issue(score_risk(tagged, rules), rules)
    return issued.withColumns(
        {
            "synthetic_issue_probability": F.col("issue_probability").cast("decimal(6,4)"),
            "anomaly_flag": F.coalesce("anomaly_id", F.lit("none")),
        }
    )


ASSIGNMENT_COLUMNS = {
    "raw_warehouse_assignments": ("order_id", "warehouse_id", "warehouse_name", "customer_state"),
    "raw_carrier_assignments": ("order_id", "carrier_id", "carrier_name"),
    "raw_sla_targets": ("order_id", "category_name", "sla_tier", "sla_target_days"),
    "raw_issue_flags": ("order_id", "issue_type", "issue_source", "synthetic_issue_probability", "anomaly_flag"),
}


def assignment_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    """The four assignment tables as projections of the wide row."""
    return {name: enriched.select(*columns) for name, columns in ASSIGNMENT_COLUMNS.items()}
