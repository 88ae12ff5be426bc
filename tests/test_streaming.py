"""The stream of shipments against a batch over the same rows."""

from collections import Counter
from datetime import date, timedelta

from frames import FACT_SCHEMA, fact, shipment
from parcelflow.operators import scoring
from parcelflow.sources import tables
from parcelflow.streaming import daily

FIRST = date(2024, 1, 1)


def day(n):
    return FIRST + timedelta(days=n)


def counts(df):
    return Counter(tuple(r) for r in df.select("order_purchase_date", "warehouse_id", "carrier_id", "anomaly_flag", "shipments", "breaches", "damages").collect())


def arrive(spark, folder, name, rows):
    fact(spark, rows).write.parquet(f"{folder}/{name}")


def test_stream_equals_batch_after_restarts(spark, tmp_path):
    """Three arrivals with repeats inside and across them, a run after each; two rows arrive after their day was closed."""
    folder, root = str(tmp_path / "arrivals"), str(tmp_path / "stream")
    rows = [shipment(i, day(i // 5), "W" if i % 3 else "V", breach=i % 4 == 0, issue=["none", "damaged", None][i % 3], flag="A" if i % 7 == 0 else "none") for i in range(200)]
    late = [shipment(1000, day(1)), shipment(1001, day(3), issue="damaged")]
    unknown = [shipment(2000, day(38))]
    unknown = [(None, *unknown[0][1:]), (*unknown[0][:6], None, *unknown[0][7:])]
    batches = [rows[:80] + rows[:10], rows[70:150], [*rows[150:], *late, *unknown, rows[3], rows[199]]]
    schema, closed = spark.createDataFrame([], FACT_SCHEMA).schema, []
    for i, batch in enumerate(batches):
        arrive(spark, f"{folder}", f"part{i}", batch)
        taken = daily.accept(spark, f"{folder}/*", schema, root)
        daily.close_days(spark, schema, root)
        # what arrived so far, without repeats and late rows
        known = {r[0]: r for b in batches[: i + 1] for r in b if r[0] and r[6] and r not in late}
        assert counts(daily.current_counts(spark, schema, root)) == counts(scoring.daily_flag_counts(fact(spark, list(known.values()))))
        closed.append(counts(daily.closed_days(spark, root)))
        assert taken["late"] >= (2 if i == 2 else 0)
    # a closed day is never written again, and days near the end stay open
    assert closed[0] <= closed[1] <= closed[2] and sum(closed[0].values()) < sum(closed[1].values()) < sum(closed[2].values())
    assert max(c[0] for c in closed[2]) < day(39 - 6)
    found = daily.late_rows(spark, f"{folder}/*", schema, root).collect()
    assert sorted(r.shipment_id or "" for r in found) == ["", "ship_1000", "ship_1001", "ship_2000"]


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    folder, root = str(tmp_path / "arrivals"), str(tmp_path / "stream")
    schema = spark.createDataFrame([], FACT_SCHEMA).schema
    rows = fact(spark, [shipment(i, day(i)) for i in range(30)])
    tables.materialize(rows.repartition(6), folder)
    daily.accept(spark, folder, schema, root, files_each=2, delay="60 days")
    daily.close_days(spark, schema, root, delay="60 days")
    before = counts(daily.current_counts(spark, schema, root))
    assert before == counts(scoring.daily_flag_counts(rows)) and daily.closed_days(spark, root).count() == 0
    daily.accept(spark, folder, schema, root, files_each=2, delay="60 days")
    daily.close_days(spark, schema, root, delay="60 days")
    assert counts(daily.current_counts(spark, schema, root)) == before and daily.late_rows(spark, folder, schema, root).count() == 0
