"""Subtotals, sketches, value frames and islands on small frames."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import fact, mondays, segment_weeks, shipment, values
from parcelflow.operators import rollups, scoring

START = datetime(2024, 1, 1)


def test_subtotals_keep_null_keys_apart(spark):
    day = mondays(1)[0]
    rows = [shipment(1, day, None, "C", breach=True), shipment(2, day, None, "C"), shipment(3, day, "W", None), shipment(4, day, "W", "C", tier=None)]
    frame = fact(spark, rows)
    found = rollups.sla_subtotals(frame)
    got = {tuple(r)[:4]: (r.shipment_count, r.sla_breach_count) for r in found.collect()}
    assert got[None, None, None, 7] == (4, 1) and got[None, None, None, 3] == (2, 1) and got["W", None, None, 3] == (2, 0)
    assert got["W", None, None, 1] == (1, 0) and got["W", None, "fast", 0] == (1, 0) and got[None, "C", None, 1] == (2, 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and "Union" not in plan and "Join" not in plan


def test_sketches_merge_in_any_order(spark):
    frame = spark.range(40_000).selectExpr("id % 30 AS day", "CAST(id % 9000 AS STRING) AS item", "CAST(id % 1000 AS DOUBLE) AS value")
    frame = frame.withColumn("value", F.when(F.col("day") != 7, F.col("value")))
    days = rollups.daily_sketches(frame, "item", "value", ["day"])
    whole = rollups.estimated(rollups.daily_sketches(frame.withColumn("all", F.lit(1)), "item", "value", ["all"]), ["all"]).first()
    found = []
    for seed in (1, 2):
        halves = rollups.merged(days.withColumn("half", F.xxhash64("day", F.lit(seed)) % 2).orderBy(F.rand(seed)), ["half"])
        found.append(rollups.estimated(rollups.merged(halves.withColumn("all", F.lit(1)), ["all"]), ["all"]).first())
    assert found[0].distinct_ids == found[1].distinct_ids == whole.distinct_ids and found[0].rows == whole.rows == 40_000
    assert abs(whole.distinct_ids - 9000) < 3 * 0.0163 * 9000
    assert all(abs(f.p50 - 500) < 30 and abs(f.p90 - 900) < 30 for f in (*found, whole))
    lone = rollups.estimated(days.where("day = 7"), ["day"]).first()
    assert lone.p50 is None and lone.distinct_ids > 0


def test_calendar_frame_differs_from_present_weeks(spark):
    weeks = mondays(12)
    segments = scoring.weekly_segment(scoring.daily_flag_counts(segment_weeks(spark, [(w, 10, i, 0) for i, w in enumerate(weeks) if i not in (5, 6, 7)])))
    found = {r.week_start_date: r for r in rollups.calendar_baseline(segments).collect()}
    present = {r.week_start_date: r for r in scoring.with_sla_baseline(segments).collect()}
    r = found[weeks[8]]
    assert (r.baseline_shipments, r.baseline_breaches, r.empty_weeks, r.baseline_breach_pct) == (10, 4, 3, 40.0)
    assert present[weeks[8]].prior_week_count == 4 and abs(present[weeks[8]].sla_mean - 0.25) < 1e-9
    assert found[weeks[0]].baseline_breach_pct is None and found[weeks[4]].empty_weeks == 0
    assert set(found) == {w for i, w in enumerate(weeks) if i not in (5, 6, 7)}
    full = rollups.with_all_weeks(segments, ["warehouse_id", "carrier_id"], zeros=["shipment_count"])
    assert full.count() == 12 and full.where("shipment_count = 0 AND sla_breach_rate IS NULL").count() == 3


@pytest.mark.parametrize("points_each", [1_000_000, 40, 7])
def test_sessions_across_chunks(spark, points_each):
    """One user holds half of all rows; with small chunks their sessions cross seams."""
    draw, rows = random.Random(2), []
    for user, n in (("hot", 600), ("a", 200), ("b", 300), (None, 5)):
        at = 0
        for _ in range(n):
            at += draw.choice([0, 1, 30, 60, 61, 500, 5000])
            rows.append((user, START + timedelta(seconds=at)))
    rows.append(("a", None))
    wanted = []
    for user in ("hot", "a", "b"):
        times, run, number = sorted(t for u, t in rows if u == user and t), [], 0
        for t in [*times, None]:
            if run and (t is None or (t - run[-1]).total_seconds() > 60):
                number += 1
                wanted.append((user, number, run[0], run[-1], len(run)))
                run = []
            run.append(t)
    frame = spark.createDataFrame(rows, "user string, ts timestamp").repartition(3)
    found = rollups.sessions(frame, ["user"], "ts", 60, points_each=points_each)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_streaks_of_weeks(spark):
    weeks = mondays(9)
    rows = [("A", w, i in (0, 1, 2, 4, 7, 8)) for i, w in enumerate(weeks)] + [("B", weeks[3], True), ("B", weeks[3], True), ("C", weeks[1], None)]
    frame = spark.createDataFrame(rows, "key string, week_start_date date, is_flagged boolean")
    assert values(rollups.flagged_streaks(frame, ["key"])) == [("A", weeks[0], weeks[2], 3), ("A", weeks[4], weeks[4], 1), ("A", weeks[7], weeks[8], 2), ("B", weeks[3], weeks[3], 1)]
