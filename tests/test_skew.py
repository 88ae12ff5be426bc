"""Whole queries on data where one customer, one order and one product hold a third of all rows each."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from compare import connect, difference

# Shuffle joins only, and thresholds small enough for the test data to count as skewed.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "12",
}
TABLES = {
    "region": "SELECT i::INTEGER AS r_regionkey, 'REGION_' || i AS r_name FROM range(5) t(i)",
    "nation": "SELECT i::INTEGER AS n_nationkey, 'NATION_' || i AS n_name, (i % 5)::INTEGER AS n_regionkey FROM range(25) t(i)",
    "customer": "SELECT i AS c_custkey, (i % 26)::INTEGER AS c_nationkey FROM range(500) t(i)",
    "supplier": "SELECT i AS s_suppkey, (i % 25)::INTEGER AS s_nationkey FROM range(50) t(i)",
    "part": """SELECT i AS p_partkey, CASE i % 7 WHEN 0 THEN 'SMALL' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'PROMO' WHEN 3 THEN 'ECONOMY'
               WHEN 4 THEN 'MEDIUM' WHEN 5 THEN ' ' END AS p_type FROM range(300) t(i)""",
    "orders": """SELECT i AS o_orderkey, CASE WHEN i % 3 = 0 THEN 7 WHEN i % 50 = 1 THEN NULL ELSE i % 600 END AS o_custkey,
                 ['F', 'O', 'P'][1 + (i // 3) % 3] AS o_orderstatus, (i % 977)::DOUBLE AS o_totalprice,
                 TIMESTAMP '1997-09-01' + to_days((i * 37 % 400)::INTEGER) AS o_orderdate FROM range(6000) t(i)""",
    "lineitem": """SELECT CASE WHEN i % 3 = 0 THEN 5 ELSE i % 6100 END AS l_orderkey, CASE WHEN i % 3 = 1 THEN 3 ELSE i % 310 END AS l_partkey,
                   i % 50 AS l_suppkey, (1 + i % 4)::INTEGER AS l_linenumber, TIMESTAMP '1998-01-01' + to_days((i % 300)::INTEGER) AS l_shipdate
                   FROM range(30000) t(i)""",
}
QUERIES = (
    "fct_shipments", "stg_orders", "stg_shipments", "anomaly_results", "anomaly_summary", "agg_weekly_quality", "enrich_order_category",
    "enrich_min_review", "enrich_anomaly_window_join", "dq_unique", "dq_relationships", "kpi_shipments_by_segment", "export_fct_shipments",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name, sql in TABLES.items():
        duckdb.sql(sql).write_parquet(str(folder / f"{name}.parquet"))
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield str(folder)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_skewed_data(spark, skewed, name):
    found = entry_point.queries()[name](spark, skewed)
    assert difference(found, connect(skewed), entry_point.oracle_sql()[name]) is None
