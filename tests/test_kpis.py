from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import fact, names, shipment, values
from parcelflow.plans import exports, kpis, marts

D1, D2 = date(2024, 1, 3), date(2024, 1, 4)


@pytest.fixture
def frames(spark):
    rows = [shipment(i, D1, breach=i < 3, delay=i % 2 * 6, issue="damaged" if i == 0 else "none") for i in range(4)]
    rows += [shipment(10 + i, D2, issue="missing", flag="A") for i in range(1)]
    f = fact(spark, rows)
    dims = names(spark)
    return {
        "fact": exports.shipments(f, *dims),
        "daily": exports.daily_sla(marts.agg_daily_sla(f), *dims),
        "weekly": exports.weekly_quality(marts.agg_weekly_quality(marts.weekly_flag_counts(f)), *dims),
    }


def test_cards(frames):
    # Attainment is a ratio of sums, the delay card a mean of daily means.
    assert values(kpis.executive(frames["daily"])) == [(5, 0.4, 3, 1.5, 2)]
    assert values(kpis.ops(frames["fact"])) == [(5, 0.6, 0.6, 2.4, 2)]


def test_means_of_percentages_differ_from_ratios(frames):
    assert values(kpis.sla_trend(frames["daily"]), "avg_sla_attainment_pct") == [(62.5,)]
    assert values(kpis.daily_attainment(frames["daily"]), "sla_attainment") == [(0.25,), (1.0,)]


def test_distribution_counts_distinct_shipments(frames):
    doubled = frames["fact"].unionByName(frames["fact"])
    assert values(kpis.delay_distribution(doubled)) == [(0, "Warehouse", 3), (5, "Warehouse", 2)]
    assert values(kpis.delay_distribution(frames["fact"], unique=True)) == values(kpis.delay_distribution(doubled))


def test_pivots(frames):
    assert values(kpis.breach_pivot(frames["fact"], ["Carrier", "Nobody"])) == [("Warehouse", 0.6, None)]
    with pytest.raises(Exception, match="outside the dimension"):
        kpis.breach_pivot(frames["fact"], ["Nobody"]).collect()
    assert values(kpis.quality_heatmap(frames["weekly"], ["Carrier"])) == [("Warehouse", 0.4)]


def test_pivots_with_unknown_carriers(frames):
    """A NULL name (no such carrier in the dimension) and one outside the list share a column; the others are as before."""
    nameless = frames["fact"].withColumn("carrier_name", F.when(F.col("sla_breach_flag"), F.lit(None)).otherwise(F.col("carrier_name")))
    assert values(kpis.breach_pivot(nameless, ["Carrier"], others="unknown")) == [("Warehouse", 0.0, 1.0)]
    assert values(kpis.breach_pivot(frames["fact"], ["Nobody"], others="unknown")) == [("Warehouse", None, 0.6)]
    assert values(kpis.quality_heatmap(frames["weekly"], ["Carrier"], others="unknown")) == [("Warehouse", 0.4, None)]


def test_labels_and_detail(frames):
    assert values(kpis.shipment_detail(frames["fact"]), "anomaly_label") == [("A",)] + [("No injected anomaly",)] * 4


def test_filters(frames):
    assert kpis.filtered(frames["fact"], "order_purchase_date", D2, D2).count() == 1
    assert kpis.filtered(frames["fact"], issue_type=["damaged", "missing"], warehouse_name="Warehouse").count() == 2
    assert kpis.filtered(frames["fact"], carrier_name=None).count() == 5


def test_carriers_slowest_first(spark):
    rows = [shipment(1, D1, carrier="slow", delay=9), shipment(2, D1, carrier="quick", delay=1), shipment(3, D2, carrier="slow", warehouse="V", delay=3)]
    dims = (
        spark.createDataFrame([("W", "W"), ("V", "V")], "warehouse_id string, warehouse_name string"),
        spark.createDataFrame([("slow", "slow"), ("quick", "quick")], "carrier_id string, carrier_name string"),
    )
    found = kpis.avg_delay_by_carrier(exports.daily_sla(marts.agg_daily_sla(fact(spark, rows)), *dims))
    assert [tuple(r) for r in found.collect()] == [("slow", "V", 3.0), ("slow", "W", 9.0), ("quick", "W", 1.0)]
