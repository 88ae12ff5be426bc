from datetime import date

import pytest

from frames import fact, shipment, values
from parcelflow import config
from parcelflow.operators import scoring
from parcelflow.plans import findings

WINDOWS = (
    config.AnomalyWindow("S", "sharp_spike", "C", "W", "damaged", date(2024, 1, 1), date(2024, 1, 14)),
    config.AnomalyWindow("T", "sharp_spike", "C", "Z", "damaged", date(2024, 6, 1), date(2024, 6, 2)),
    config.AnomalyWindow("D", "gradual_drift", None, "W", "sla_breach", date(2024, 3, 1), date(2024, 3, 28)),
)


@pytest.fixture
def inputs(spark):
    rows = [
        shipment(1, date(2024, 1, 1), issue="damaged"), shipment(2, date(2024, 1, 14)), shipment(3, date(2024, 1, 15), issue="damaged"),
        shipment(4, date(2024, 1, 2), carrier="other", issue="damaged"), shipment(5, date(2023, 12, 31)), shipment(6, date(2024, 1, 3), issue=None),
        shipment(10, date(2024, 3, 1), breach=True), shipment(11, date(2024, 3, 7), carrier="other"), shipment(12, date(2024, 3, 8), breach=True),
        shipment(13, date(2024, 3, 21)), shipment(14, date(2024, 3, 22), breach=True), shipment(15, date(2024, 3, 28), breach=True),
    ]
    return scoring.daily_flag_counts(fact(spark, rows)), config.windows_df(spark, WINDOWS)


def test_inside_and_outside(inputs):
    assert values(findings.spike_inside(*inputs)) == [("S", 3, 1, 1 / 3), ("T", 0, None, None)]
    # Outside: 15 January, 31 December and the March shipments of the same segment.
    assert values(findings.spike_outside(*inputs), "anomaly_id", "shipments", "damaged_count") == [("S", 7, 1), ("T", 0, None)]


def test_share(inputs):
    assert values(findings.spike_share(*inputs)) == [("S", 1, 2, 0.5), ("T", None, 0, None)]


def test_start_and_end(inputs):
    assert values(findings.drift_start_end(*inputs)) == [("D", "W", 2, 1, 0.5, 2, 2, 1.0)]


def test_a_thousand_windows(spark, inputs):
    """Windows join by day and segment, so a long table is no product with all days."""
    from pyspark.sql import functions as F

    daily, windows = inputs
    many = windows.join(spark.range(500)).withColumn("anomaly_id", F.concat("anomaly_id", F.lit("-"), F.col("id"))).drop("id")
    for finding in (findings.spike_inside, findings.spike_outside, findings.drift_start_end):
        once, often = finding(daily, windows), finding(daily, many)
        assert often.count() == 500 * once.count()
        assert sorted(map(str, set(values(often.drop("anomaly_id"))))) == sorted(map(str, set(values(once.drop("anomaly_id")))))
