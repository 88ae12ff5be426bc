"""Bronze tables derived from a star schema of orders, line items, parts, customers and nations.

Any order/line-item schema of that shape can feed the library. What the star schema lacks (states,
reviews, delivery dates) is derived from its keys, so that every rule has input to work on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.operators.enrich import warehouse_routing

# Warehouse per region; the remaining region is routed by override.
REGION_WAREHOUSES = {0: "WH_NORTH", 1: "WH_SOUTHEAST", 2: "WH_SOUTH", 3: "WH_CENTRAL_WEST"}
OVERRIDE_REGION = 4

RULES = config.Rules(
    windows=(
        config.AnomalyWindow("ANOM_SPIKE_001", "sharp_spike", "CAR_B", "WH_SOUTHEAST", "damaged", date(1998, 4, 1), date(1998, 4, 14)),
        config.AnomalyWindow("ANOM_DRIFT_001", "gradual_drift", None, "WH_CENTRAL_WEST", "sla_breach", date(1998, 7, 1), date(1998, 7, 28)),
    ),
    bulky_keywords=("large", "economy"),
    fast_keywords=("small", "promo"),
)


def read_star(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def _plus_days(ts: Column, days: Column | int) -> Column:
    return F.timestamp_add("DAY", (F.lit(days) if isinstance(days, int) else days).cast("int"), ts)


def raw_orders(orders: DataFrame) -> DataFrame:
    key, purchased, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    delivered = F.when(~((status == "P") & (key % 5 == 0)), _plus_days(purchased, key * 7 % 13))
    return orders.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").when(status == "P", "canceled").alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        _plus_days(purchased, 1).alias("order_approved_at"),
        _plus_days(delivered, -1).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _plus_days(purchased, key % 6 + 5).alias("order_estimated_delivery_date"),
    )


def raw_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("n_name").alias("customer_state")
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"))


def raw_products(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_type").alias("product_category_name"))


def raw_reviews(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").cast("string").alias("order_id"), (F.col("l_suppkey") % 5 + 1).cast("int").alias("review_score"))


def raw_payments(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("payment_value"))


def raw_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select(
        F.col("s_suppkey").cast("string").alias("seller_id"), F.col("n_name").alias("seller_state")
    )


def raw_geolocation(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_name").alias("geolocation_state"), F.col("r_name").alias("geolocation_region")
    )


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight source tables of the bronze layer."""
    t = read_star(spark, sf_dir, "orders", "lineitem", "part", "customer", "supplier", "nation", "region")
    return {
        "raw_orders": raw_orders(t["orders"]),
        "raw_order_items": raw_order_items(t["lineitem"]),
        "raw_products": raw_products(t["part"]),
        "raw_customers": raw_customers(t["customer"], t["nation"]),
        "raw_reviews": raw_reviews(t["lineitem"]),
        "raw_payments": raw_payments(t["orders"]),
        "raw_sellers": raw_sellers(t["supplier"], t["nation"]),
        "raw_geolocation": raw_geolocation(t["nation"], t["region"]),
    }


def warehouses(spark: SparkSession, nation: DataFrame) -> DataFrame:
    """The warehouse config, with the nations of each region as its assigned states."""
    regions = config.local_table(spark, list(REGION_WAREHOUSES.items()), "n_regionkey int, warehouse_id string")
    states = (
        nation.join(regions, "n_regionkey")
        .groupBy("warehouse_id")
        .agg(F.array_join(F.array_sort(F.collect_set("n_name")), ";").alias("assigned_states"))
    )
    return config.warehouses_df(spark).drop("assigned_states").join(states, "warehouse_id", "left")


def routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_star(spark, sf_dir, "nation")["nation"]
    overrides = nation.where(F.col("n_regionkey") == OVERRIDE_REGION).select(
        F.col("n_name").alias("customer_state"), F.lit(config.OVERRIDE_WAREHOUSE).alias("warehouse_id")
    )
    return warehouse_routing(warehouses(spark, nation), overrides)
