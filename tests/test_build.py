from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import connect, sql_rows
from frames import values
from parcelflow import config
from parcelflow.operators import staging
from parcelflow.oracles import ORACLES
from parcelflow.plans import build
from parcelflow.sources import schemas, star
from parcelflow.sources.tables import read_csv, write_csv

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    sources = star.source_tables(spark, SF)
    tables = build.build_marts(sources, star.routing(spark, SF), out, star.RULES, months=None)
    tables |= build.detect(spark, tables, out, star.RULES, min_shipments=3)
    return sources, tables


def test_written_results_equal_the_oracle(built):
    names, wanted = sql_rows(connect(SF), ORACLES["anomaly_results"])
    assert values(built[1]["anomaly_results"], *names) == sorted(wanted, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_planted_windows_are_found(built):
    found = {r.anomaly_id: r for r in built[1]["anomaly_validation_summary"].collect()}
    assert found["ANOM_SPIKE_001"].detected and found["ANOM_DRIFT_001"].detected
    # The window starts on a Wednesday: the first flagged week starts before it.
    assert str(found["ANOM_SPIKE_001"].first_detected_week) == "1998-03-30"


def test_joined_models_equal_the_wide_row(built):
    sources, t = built
    joined = staging.stg_shipments(
        sources["raw_orders"], sources["raw_customers"], t["raw_warehouse_assignments"], t["raw_carrier_assignments"], t["raw_sla_targets"]
    )
    assert joined.exceptAll(t["stg_shipments"]).isEmpty() and t["stg_shipments"].exceptAll(joined).isEmpty()
    fact = staging.fct_shipments(joined, t["raw_sla_targets"], t["stg_issues"])
    assert fact.exceptAll(t["fct_shipments"]).isEmpty() and t["fct_shipments"].exceptAll(fact).isEmpty()


def test_exports(spark, built, tmp_path):
    tables = built[1]
    counts = build.export_all(tables, str(tmp_path))
    assert counts == {
        "fct_shipments_dashboard": tables["fct_shipments"].count(),
        "daily_sla_performance": tables["agg_daily_sla_performance"].count(),
        "weekly_quality_by_segment": tables["agg_weekly_quality_by_segment"].count(),
        "anomaly_summary": 2,
    }
    header = next(Path(tmp_path / "anomaly_summary").glob("part-*")).read_text().splitlines()[0]
    assert header.split(",") == schemas.ANOMALY_SUMMARY.names
    again = read_csv(spark, str(tmp_path / "anomaly_summary"), schemas.ANOMALY_SUMMARY)
    assert values(again, "anomaly_id", "detected") == [("ANOM_DRIFT_001", True), ("ANOM_SPIKE_001", True)]


def test_whole_run_from_csv(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    sources = star.source_tables(spark, small)
    for name, df in sources.items():
        write_csv(df, str(tmp_path / "in" / name))
    frames = {
        "warehouses": star.warehouses(spark, star.read_star(spark, small, "nation")["nation"]).select(*schemas.WAREHOUSES.names),
        "carriers": config.carriers_df(spark),
        "sla_targets": config.sla_targets_df(spark),
        "anomaly_windows": config.windows_df(spark, star.RULES.windows),
    }
    for name, df in frames.items():
        write_csv(df, str(tmp_path / "config" / f"{name}.csv"), single_file=True)
    tables = build.run(spark, {name: str(tmp_path / "in" / name) for name in sources}, str(tmp_path / "config"), str(tmp_path / "out"))
    # Only the last six complete months are assigned; every order is staged.
    window = tables["raw_issue_flags"].count()
    assert 0 < window < tables["stg_orders"].count() == sources["raw_orders"].count()
    report = tables["quality_report"]
    assert report.count() == 42 and report.where("status <> 'pass' AND check_name NOT IN ('required_values', 'detection')").isEmpty()
    # the known windows lie before the last six months
    assert {r.check_name: r.violations for r in report.where("status <> 'pass'").collect()} == {"required_values": 2, "detection": 2}
    again = read_csv(spark, str(tmp_path / "out" / "assignments" / "raw_issue_flags"), schemas.RAW_ISSUE_FLAGS)
    assert again.exceptAll(tables["raw_issue_flags"]).isEmpty() and again.count() == window


def test_run_from_given_assignments(spark, built, tmp_path):
    """Given tables are used as they are: a changed carrier arrives in the fact, an order that a table lacks does not, a repeated one once."""
    sources, drawn = built
    given = {name: drawn[name] for name in staging.ASSIGNED}
    carrier = given["raw_carrier_assignments"]
    keys = [r.order_id for r in drawn["fct_shipments"].orderBy("order_id").select("order_id").take(2)]
    moved = carrier.withColumn("carrier_id", F.when(F.col("order_id") == keys[0], "OWN").otherwise(F.col("carrier_id"))).where(F.col("order_id") != keys[1])
    given["raw_carrier_assignments"] = moved.unionByName(moved.where(F.col("order_id") == keys[0]))
    tables = build.build_marts(sources, None, str(tmp_path), star.RULES, assignments=given)
    wanted = drawn["fct_shipments"].where(F.col("order_id") != keys[1]).withColumn("carrier_id", F.when(F.col("order_id") == keys[0], "OWN").otherwise(F.col("carrier_id")))
    assert tables["fct_shipments"].exceptAll(wanted).isEmpty() and wanted.exceptAll(tables["fct_shipments"]).isEmpty()


def test_every_fault_is_reported(spark, built):
    sources, tables = built
    names = ["raw_orders", "raw_payments"]

    def found(**changed):
        own = {name: changed.get(name, df) for name, df in {**{n: sources[n] for n in names}, **tables}.items()}
        rows = build.validation_report(spark, {n: own[n] for n in names}, own, star.RULES, None).collect()
        return {r.check_name: r.violations for r in rows if r.status == "fail"}

    assert found() == {}
    blank = sources["raw_payments"].withColumn("order_id", F.when(F.col("order_id") != "7", F.col("order_id")).otherwise(" "))
    assert found(raw_payments=blank) == {"blank_key": 1}
    assert found(dim_date=tables["dim_date"].where("false")) == {"row_count": 1}
    assert found(raw_issue_flags=tables["raw_issue_flags"].where("anomaly_flag <> 'ANOM_DRIFT_001'")) == {"exact_count": 1, "required_values": 1}
    missed = tables["anomaly_validation_summary"].withColumn("detected", F.col("anomaly_id") != "ANOM_SPIKE_001")
    assert found(anomaly_validation_summary=missed) == {"detection": 1}
