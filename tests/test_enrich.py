from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import ts, values
from parcelflow import config
from parcelflow.operators import enrich
from parcelflow.sources import schemas


def orders(spark, rows):
    """Orders from `(id, status, purchased, delivered, estimated)`; the customer id equals the order id."""
    full = [(i, i, status, ts(bought), None, None, ts(arrived), ts(promised)) for i, status, bought, arrived, promised in rows]
    return spark.createDataFrame(full, schemas.RAW_ORDERS)


def routing(spark):
    overrides = spark.createDataFrame([(state, config.OVERRIDE_WAREHOUSE) for state in config.OVERRIDE_STATES], "customer_state string, warehouse_id string")
    return enrich.warehouse_routing(config.warehouses_df(spark), overrides)


@pytest.mark.parametrize(
    "latest, first, last",
    [("2018-10-17", date(2018, 4, 1), date(2018, 9, 30)), ("2018-10-28", date(2018, 5, 1), date(2018, 10, 31)), ("2018-03-05", date(2017, 9, 1), date(2018, 2, 28))],
)
def test_recent_months(spark, latest, first, last):
    frame = orders(spark, [("1", "delivered", "2016-01-01", None, None), ("2", "delivered", latest, None, None), ("3", "delivered", None, None, None)])
    assert values(enrich.recent_months(frame)) == [(first, last)]


def test_in_recent_months_keeps_both_ends_and_drops_missing_times(spark):
    frame = orders(
        spark,
        [("a", "x", "2018-03-31 23:59:59", None, None), ("b", "x", "2018-04-01", None, None), ("c", "x", "2018-09-30 23:00:00", None, None),
         ("d", "x", "2018-10-17", None, None), ("e", "x", None, None, None)],
    )
    assert values(enrich.in_recent_months(frame), "order_id") == [("b",), ("c",)]


def test_routing_by_list_override_and_default(spark):
    states = spark.createDataFrame([("1", "AM"), ("2", "SP"), ("3", "BA"), ("4", "GO"), ("5", "XX"), ("6", None)], "order_id string, customer_state string")
    routed = enrich.route_warehouse(states, routing(spark), config.Rules().default_warehouse)
    assert values(routed, "order_id", "warehouse_id") == [
        ("1", "WH_NORTH"), ("2", "WH_SOUTHEAST"), ("3", "WH_SOUTHEAST"), ("4", "WH_CENTRAL_WEST"), ("5", "WH_CENTRAL_WEST"), ("6", "WH_CENTRAL_WEST"),
    ]


def test_override_beats_the_state_list(spark):
    warehouses = config.local_table(spark, [("W1", "One", "A;B", ""), ("W2", "Two", "C", "")], schemas.WAREHOUSES)
    overrides = spark.createDataFrame([("B", "W2")], "customer_state string, warehouse_id string")
    assert values(enrich.warehouse_routing(warehouses, overrides)) == [("A", "W1", "One"), ("B", "W2", "Two"), ("C", "W2", "Two")]


@pytest.mark.parametrize("unique", [True, False])
def test_modal_category(spark, unique):
    products = spark.createDataFrame([("p1", "b"), ("p2", "a"), ("p3", ""), ("p4", None)], "product_id string, product_category_name string")
    items = spark.createDataFrame(
        [("1", "p1"), ("1", "p1"), ("1", "p2"), ("2", "p1"), ("2", "p2"), ("3", "p3"), ("3", "p4"), ("3", "p1"), ("4", "p3"), ("5", "p9")],
        "order_id string, product_id string",
    )
    assert values(enrich.order_category(items, products, unique)) == [("1", "b"), ("2", "a"), ("3", "b")]


def test_modal_category_of_a_hot_order(spark):
    items = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"), (F.col("id") % 7).cast("string").alias("product_id")
    )
    products = spark.range(7).select(F.col("id").cast("string").alias("product_id"), F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("product_category_name"))
    found = enrich.order_category(items, products)
    assert found.where("order_id = 'hot'").first().category_name == "c0"
    assert found.count() == 20_001


@pytest.mark.parametrize(
    "category, tier", [("MOVEIS_decoracao", "bulky"), ("beleza_saude", "fast"), ("eletrodomesticos", "bulky"), ("eletronicos", "fast"), ("unknown", "standard"), ("moveis_fashion", "bulky")]
)
def test_sla_tier(spark, category, tier):
    rules = config.Rules()
    frame = spark.createDataFrame([(category,)], "category_name string")
    days = {"fast": 3, "standard": 5, "bulky": 8}[tier]
    assert values(enrich.assign_sla(frame, rules)) == [(category, tier, days)]


def test_carrier_shares(spark):
    frame = spark.range(20_000).select(F.col("id").cast("string").alias("order_id"), F.when(F.col("id") % 2 == 0, "WH_SOUTH").otherwise("WH_CENTRAL_WEST").alias("warehouse_id"))
    counted = enrich.assign_carrier(frame, config.CARRIERS).groupBy("warehouse_id", "carrier_id").count()
    share = {(r.warehouse_id, r.carrier_id): r["count"] / 10_000 for r in counted.collect()}
    assert share["WH_SOUTH", "CAR_D"] == pytest.approx(0.12, abs=0.02)
    assert share["WH_CENTRAL_WEST", "CAR_D"] == pytest.approx(0.35 / 1.23, abs=0.02)
    assert share["WH_CENTRAL_WEST", "CAR_A"] == pytest.approx(0.33 / 1.23, abs=0.02)


def scored(spark, rows, windows=config.ANOMALY_WINDOWS):
    """Risk of `(id, status, day, late, review, warehouse, carrier)` rows."""
    rules = config.Rules(windows=windows)
    frame = spark.createDataFrame(
        [(i, status, ts(day), ts("2020-01-09" if late else "2020-01-01"), ts("2020-01-05"), review, wh, car) for i, status, day, late, review, wh, car in rows],
        "order_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz, review_score int, warehouse_id string, carrier_id string",
    )
    return enrich.draw_issue(enrich.score_risk(enrich.tag_window(frame, windows), rules), rules)


def risk(spark, *row):
    return scored(spark, [("1", *row)]).first().issue_probability


def test_risk_sums_the_signals(spark):
    assert risk(spark, "delivered", "2018-04-01", False, None, "WH_SOUTH", "CAR_A") == pytest.approx(0.03)
    assert risk(spark, "canceled", "2018-04-01", False, 5, "WH_SOUTH", "CAR_A") == pytest.approx(0.95)
    assert risk(spark, "delivered", "2018-04-01", True, 1, "WH_SOUTH", "CAR_C") == pytest.approx(0.03 + 0.12 + 0.15 + 0.05)
    assert risk(spark, "delivered", "2018-04-14", True, 1, "WH_SOUTHEAST", "CAR_B") == pytest.approx(0.65)
    assert risk(spark, "delivered", "2018-01-01", False, 3, "WH_CENTRAL_WEST", "CAR_D") == pytest.approx(0.15)


def test_spike_with_weak_carrier_and_all_signals(spark):
    window = config.AnomalyWindow("S", "sharp_spike", "CAR_C", "WH_SOUTH", "damaged", date(2020, 1, 1), date(2020, 1, 2))
    row = scored(spark, [("1", "delivered", "2020-01-02", True, 1, "WH_SOUTH", "CAR_C")], (window,)).first()
    assert row.issue_probability == pytest.approx(0.70)


def test_drift_grows_over_the_window(spark):
    assert risk(spark, "delivered", "2018-07-01", False, None, "WH_CENTRAL_WEST", "CAR_A") == pytest.approx(0.08)
    assert risk(spark, "delivered", "2018-07-28", False, None, "WH_CENTRAL_WEST", "CAR_A") == pytest.approx(0.26)


def test_window_ends_wildcard_and_order(spark):
    rows = [
        ("1", "delivered", "2018-07-01 00:00:00", False, 5, "WH_CENTRAL_WEST", "CAR_A"),
        ("2", "delivered", "2018-07-28 23:59:59", False, 5, "WH_CENTRAL_WEST", "CAR_D"),
        ("3", "delivered", "2018-07-29 00:00:00", False, 5, "WH_CENTRAL_WEST", "CAR_D"),
        ("4", "delivered", "2018-04-05 00:00:00", False, 5, "WH_SOUTHEAST", "CAR_A"),
    ]
    assert values(scored(spark, rows), "order_id", "anomaly_id") == [("1", "ANOM_DRIFT_001"), ("2", "ANOM_DRIFT_001"), ("3", None), ("4", None)]
    both = tuple(config.AnomalyWindow(name, "sharp_spike", None, "WH_SOUTH", "damaged", date(2018, 1, 1), date(2018, 1, 31)) for name in ("second", "first"))
    assert values(scored(spark, [("1", "delivered", "2018-01-05", False, 5, "WH_SOUTH", "CAR_A")], both), "anomaly_id") == [("second",)]


def test_window_join_equals_the_expression(spark):
    def window(name, carrier, warehouse, first, last):
        return config.AnomalyWindow(name, "sharp_spike", carrier, warehouse, "damaged", date(2020, 1, first), date(2020, 1, last))

    windows = (
        window("a", "CAR_A", "W1", 3, 5), window("b", None, "W1", 1, 4), window("c", "CAR_A", "W1", 1, 9), window("d", None, "W2", 4, 4),
        window("e", None, "W1", 2, 8), window("f", "CAR_B", "W2", 1, 9), window("g", "CAR_B", "W2", 9, 1),
    )
    rows = [
        (f"{day}{wh}{car}", ts(f"2020-01-{day:02d} 12:00:00"), wh, car) for day in range(1, 11) for wh in ("W1", "W2", None) for car in ("CAR_A", "CAR_B", None)
    ]
    frame = spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp_ntz, warehouse_id string, carrier_id string")
    by_rule = enrich.tag_window(frame, windows)
    by_join = enrich.tag_window_join(frame, config.ordered_windows_df(spark, windows))
    assert by_join.columns == by_rule.columns and values(by_join) == values(by_rule)
    assert {r.anomaly_id for r in by_rule.collect()} == {"a", "b", "c", "d", "e", "f", None}


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "20",
}


@pytest.fixture
def splitting(spark):
    before = {key: spark.conf.get(key, None) for key in SPLITTING}
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_frame(spark, key):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(0, 60_000, numPartitions=8).select(F.col("id").cast("string").alias("order_id"), hot.alias(key), F.md5(F.col("id").cast("string")).alias("payload"))


def lookup_frame(spark, key, name, value):
    return spark.range(60_000).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias(key), F.lit(value).alias(name))


@pytest.mark.parametrize("unique", [True, False])
def test_hot_customers_are_split(spark, splitting, unique):
    customers = lookup_frame(spark, "customer_id", "customer_state", "SP")
    joined = enrich.with_customer_state(hot_frame(spark, "customer_id"), customers, unique_customers=unique)
    assert len(joined.collect()) == 60_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("unique", [True, False])
def test_hot_products_are_split(spark, splitting, unique):
    products = lookup_frame(spark, "product_id", "product_category_name", "toys")
    found = enrich.order_category(hot_frame(spark, "product_id"), products, unique_products=unique)
    assert len(found.collect()) == 60_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_issue_source_is_the_last_signal(spark):
    rows = [(str(i), "delivered", "2018-04-05", True, 1, "WH_SOUTHEAST", "CAR_B") for i in range(200)]
    rows += [(str(i), "delivered", "2019-01-01", False, 5, "WH_SOUTH", "CAR_A") for i in range(200, 1200)]
    rows += [(str(i), "canceled", "2018-04-05", True, 1, "WH_SOUTHEAST", "CAR_B") for i in range(1200, 1210)]
    found = {(r.issue_type == "none", r.order_status, r.issue_source, r.anomaly_id) for r in scored(spark, rows).collect()}
    assert found == {
        (True, "delivered", "none", "ANOM_SPIKE_001"), (False, "delivered", "injected_anomaly", "ANOM_SPIKE_001"),
        (True, "delivered", "none", None), (False, "delivered", "synthetic_baseline", None),
        (False, "canceled", "order_canceled", "ANOM_SPIKE_001"),
    }


def test_signals_in_recorded_order(spark):
    frame = scored(spark, [("1", "canceled", "2018-07-05", True, 2, "WH_CENTRAL_WEST", "CAR_D")])
    assert frame.select(enrich.risk_signals(config.CARRIERS).alias("s")).first().s == [
        "late_delivery", "low_review", "warehouse_carrier_weakness", "injected_anomaly", "order_canceled",
    ]


def enriched(spark, unique_keys=False, repeat=1):
    frame = orders(spark, [("1", "delivered", "2018-04-05", "2018-04-09", "2018-04-08"), ("2", "canceled", "2018-09-28", None, "2018-10-01"), ("3", "shipped", "2017-01-01", None, None)])
    customers = spark.createDataFrame([("1", "SP"), ("2", "AM")] * repeat, schemas.RAW_CUSTOMERS)
    items = spark.createDataFrame([("1", "p")], schemas.RAW_ORDER_ITEMS)
    products = spark.createDataFrame([("p", "moveis")] * repeat, schemas.RAW_PRODUCTS)
    reviews = spark.createDataFrame([("1", 4), ("1", 2)], schemas.RAW_REVIEWS)
    return enrich.enrich_orders(frame, customers, items, products, reviews, routing(spark), unique_keys=unique_keys)


def test_enriched_rows_and_assignment_schemas(spark):
    wide = enriched(spark)
    assert values(wide, "order_id", "warehouse_id", "category_name", "sla_target_days", "review_score") == [
        ("1", "WH_SOUTHEAST", "moveis", 8, 2), ("2", "WH_NORTH", "unknown", 5, None),
    ]
    tables = enrich.assignment_tables(wide)
    for name, schema in schemas.ASSIGNMENT_TABLES.items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]
    assert tables["raw_issue_flags"].where("order_id = '2'").first().synthetic_issue_probability == Decimal("0.9500")


def test_repeated_lookup_keys_do_not_multiply_orders(spark):
    assert enriched(spark, repeat=3).count() == 2
    assert values(enriched(spark, repeat=3)) == values(enriched(spark, unique_keys=True))
