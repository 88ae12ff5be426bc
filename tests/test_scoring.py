from datetime import date, timedelta

import pytest

from frames import fact, mondays, names, segment_weeks, shipment, values
from parcelflow import config
from parcelflow.operators import scoring


def results(spark, frame, labels=tuple(config.VALIDATION_METRICS), **params):
    return scoring.anomaly_results(frame, *names(spark), labels=labels, **params)


def by_week(df, metric):
    return {r.week_start_date: r for r in df.where(df.detection_metric == metric).collect()}


def test_result_columns_and_types(spark):
    from parcelflow.sources.schemas import ANOMALY_RESULTS

    found = results(spark, segment_weeks(spark, [(mondays(1)[0], 2, 1, 0)]))
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in ANOMALY_RESULTS]


def test_equal_prior_rates_give_no_z(spark):
    weeks = mondays(5)
    found = by_week(results(spark, segment_weeks(spark, [(w, 30, 3, 0) for w in weeks[:4]] + [(weeks[4], 30, 30, 0)])), "sla_breach_rate")
    assert found[weeks[4]].trailing_4_week_std == 0.0
    assert found[weeks[4]].z_score is None and found[weeks[4]].anomaly_detected is False


def test_history_guard_only_on_the_sla_track(spark):
    weeks = mondays(4)
    found = results(spark, segment_weeks(spark, [(w, 30, b, b) for w, b in zip(weeks, (1, 2, 3, 30))]))
    assert by_week(found, "sla_breach_rate")[weeks[3]].z_score is None
    assert by_week(found, "damaged_issue_rate")[weeks[3]].z_score is not None


def test_frame_counts_present_weeks(spark):
    weeks = mondays(9)
    present = weeks[:4] + [weeks[8]]
    found = by_week(results(spark, segment_weeks(spark, [(w, 20, b, 0) for w, b in zip(present, (2, 4, 6, 8, 20))])), "sla_breach_rate")
    assert found[weeks[8]].trailing_4_week_mean == 0.25
    assert found[weeks[8]].anomaly_detected is True


def test_low_rates_are_flagged_too(spark):
    weeks = mondays(5)
    found = by_week(results(spark, segment_weeks(spark, [(w, 20, b, 0) for w, b in zip(weeks, (16, 17, 18, 17, 0))])), "sla_breach_rate")
    assert found[weeks[4]].z_score < -2 and found[weeks[4]].anomaly_detected is True


@pytest.mark.parametrize("shipments, flagged", [(19, False), (20, True)])
def test_volume_guard(spark, shipments, flagged):
    weeks = mondays(5)
    rows = [(w, 20, b, 0) for w, b in zip(weeks, (2, 3, 2, 3))] + [(weeks[4], shipments, shipments, 0)]
    row = by_week(results(spark, segment_weeks(spark, rows)), "sla_breach_rate")[weeks[4]]
    assert abs(row.z_score) > 3 and row.anomaly_detected is flagged


def test_a_z_score_on_the_threshold_is_judged_by_its_unrounded_value(spark):
    # Rates 2/3, 1/2, 1/2, 2/3 then 1/4: z is -2 but for the last digit of the deviation.
    weeks = mondays(5)
    rows = [(w, n, b, 0) for w, (n, b) in zip(weeks, ((3, 2), (4, 2), (4, 2), (3, 2), (4, 1)))]
    row = by_week(results(spark, segment_weeks(spark, rows), min_shipments=3), "sla_breach_rate")[weeks[4]]
    prior = [2 / 3, 0.5, 0.5, 2 / 3]
    n = mean = squares = 0.0
    for value in prior:
        n += 1
        old, mean = mean, mean + (value - mean) / n
        squares += (value - mean) * (value - old)
    z = (0.25 - sum(prior) / 4) / (squares / 3) ** 0.5
    assert row.anomaly_detected is (abs(z) >= 2)


def test_single_week_segment(spark):
    week = mondays(1)[0]
    found = results(spark, segment_weeks(spark, [(week, 30, 30, 30)])).collect()
    assert len(found) == 2
    assert all(r.trailing_4_week_std is None and r.z_score is None and not r.anomaly_detected for r in found)


def test_labels_do_not_change_scores(spark):
    weeks = mondays(5)
    rows = [(w, 20, b, b) for w, b in zip(weeks, (2, 3, 2, 3, 15))]
    plain = results(spark, segment_weeks(spark, rows))
    labelled = results(spark, segment_weeks(spark, rows, flags={weeks[4]: "ANOM_SPIKE_001"}))
    keep = ("detection_metric", "week_start_date", "z_score", "anomaly_detected")
    assert values(plain, *keep) == values(labelled, *keep)
    assert by_week(labelled, "sla_breach_rate")[weeks[4]].known_anomaly_labels == "ANOM_SPIKE_001"
    assert by_week(labelled, "sla_breach_rate")[weeks[4]].known_anomaly_count == 20


def test_fused_labels_equal_the_join(spark):
    day = date(2024, 1, 3)
    flags = ["ANOM_SPIKE_001", "ANOM_DRIFT_001", "ANOM_DRIFT_001", "none", "other", None]
    frame = fact(spark, [shipment(i, day, flag=f) for i, f in enumerate(flags)] + [shipment(9, day, warehouse=None, flag="ANOM_DRIFT_001")])
    counts = scoring.daily_flag_counts(frame)
    fused = scoring.labelled_segment(counts)
    joined = scoring.weekly_segment(counts).join(scoring.label_rollup(counts), list(scoring.SEGMENT_KEYS), "left").fillna({"known_anomaly_count": 0, "known_anomaly_labels": "none"})
    columns = (*scoring.SEGMENT_KEYS, "shipment_count", "known_anomaly_count", "known_anomaly_labels")
    assert values(fused, *columns) == values(joined, *columns)
    assert (day - timedelta(days=2), "W", "C", 6, 3, "ANOM_DRIFT_001;ANOM_SPIKE_001") in values(fused, *columns)


RESULT_ROWS = [
    # metric, week, warehouse, carrier, z, detected, labels
    ("damaged_issue_rate", 0, "W1", "C1", 2.5, True, "ANOM_1;ANOM_2"),
    ("damaged_issue_rate", 1, "W1", "C1", -3.5, True, "ANOM_1"),
    ("damaged_issue_rate", 2, "W1", "C2", 2.5, True, "ANOM_1"),
    ("damaged_issue_rate", 3, "W1", "C2", 2.2, True, "ANOM_1"),
    ("damaged_issue_rate", 4, "W1", "C2", 9.0, True, "ANOM_10"),
    ("damaged_issue_rate", 5, "W1", "C2", 1.0, False, "ANOM_1"),
    ("sla_breach_rate", 0, "W1", "C1", 8.0, True, "ANOM_1"),
    ("sla_breach_rate", 1, "W1", "C1", None, False, "none"),
]


@pytest.fixture
def judged(spark):
    weeks = mondays(6)
    rows = [(m, weeks[w], wh, "N" + wh, c, "N" + c, 20, 1, 1, 0.1, 0.2, 0.1, 0.1, z, hit, 1, labels) for m, w, wh, c, z, hit, labels in RESULT_ROWS]
    from parcelflow.sources.schemas import ANOMALY_RESULTS

    metrics = spark.createDataFrame([("ANOM_1", "damaged_issue_rate"), ("ANOM_2", "sla_breach_rate")], "anomaly_id string, validation_metric string")
    return spark.createDataFrame(rows, ANOMALY_RESULTS), metrics


def test_summary(judged):
    weeks = mondays(6)
    assert values(scoring.anomaly_summary(*judged)) == [
        ("ANOM_1", "damaged_issue_rate", True, weeks[0], 4, "W1 x C1 (z=-3.5); W1 x C1 (z=2.5); W1 x C2 (z=2.5)"),
        ("ANOM_2", "sla_breach_rate", False, None, 0, ""),
    ]


def test_diagnostics_and_top_segment(judged):
    frame, _ = judged
    assert scoring.spike_diagnostics(frame, "ANOM_1").count() == 6
    assert values(scoring.top_segment(frame, "damaged_issue_rate"), "z_score") == [(9.0,)]
    assert values(scoring.flagged_by_metric(frame)) == [("damaged_issue_rate", 5), ("sla_breach_rate", 1)]
