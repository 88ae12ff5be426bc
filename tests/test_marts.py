from datetime import date

from frames import fact, shipment, values
from parcelflow.plans import marts

DAY = date(2024, 1, 3)


def weekly(spark, rows):
    return marts.agg_weekly_quality(marts.weekly_flag_counts(fact(spark, rows)))


def test_dominant_flag_ties_by_name(spark):
    flags = ["A2", "A1", "A2", "A1"] + ["none"] * 9
    rows = [shipment(i, DAY, flag=f) for i, f in enumerate(flags)]
    assert values(weekly(spark, rows), "shipment_count", "anomaly_count", "dominant_anomaly_flag") == [(13, 4, "A1")]
    assert values(marts.weekly_dominant_flag(marts.weekly_flag_counts(fact(spark, rows))), "anomaly_flag", "anomaly_flag_count") == [("A1", 2)]


def test_dominant_flag_without_any(spark):
    rows = [shipment(i, DAY, flag=f) for i, f in enumerate(["none", "none", "none", None])]
    assert values(weekly(spark, rows), "shipment_count", "anomaly_count", "dominant_anomaly_flag") == [(4, 0, "none")]


def test_null_key_gets_no_dominant_flag(spark):
    assert values(weekly(spark, [shipment(1, DAY, category=None, flag="A1")]), "anomaly_count", "dominant_anomaly_flag") == [(1, "none")]


def test_weekly_rates(spark):
    rows = [shipment(i, DAY, issue="damaged") for i in range(3)] + [shipment(9, DAY, issue="none")]
    assert values(weekly(spark, rows), "issue_type", "issue_count", "issue_rate_pct") == [("damaged", 3, 100.0), ("none", 0, 0.0)]
    base = marts.weekly_quality_base(fact(spark, rows))
    assert values(base, "issue_type", "shipment_count") == [("damaged", 3), ("none", 1)]


def test_daily(spark):
    rows = [shipment(i, DAY, breach=i == 0, delay=d) for i, d in enumerate([0, 0, 1])]
    assert values(marts.agg_daily_sla(fact(spark, rows))) == [(DAY, "W", "C", "fast", 3, 1, 2, 66.67, 0.33, 1)]


def test_dim_date_is_inclusive(spark):
    rows = [shipment(1, date(2023, 12, 30)), shipment(2, date(2024, 1, 2))]
    found = values(marts.dim_date(fact(spark, rows)))
    assert len(found) == 4
    assert found[1] == (date(2023, 12, 31), 2023, 4, 12, "2023-12", 31, 0)


def test_dimensions_are_distinct_and_known(spark):
    assigned = spark.createDataFrame([("1", "W", "N"), ("2", "W", "N"), ("3", None, "X")], "order_id string, warehouse_id string, warehouse_name string")
    assert values(marts.dim_warehouse(assigned)) == [("W", "N")]
    targets = spark.createDataFrame([("a", "fast", "3"), ("a", "fast", "3"), (None, "fast", "3")], "category_name string, sla_tier string, sla_target_days string")
    assert values(marts.dim_category(targets)) == [("a", "fast", 3)]
