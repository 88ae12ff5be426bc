"""`python -m parcelflow SOURCE CONFIG OUT`: the whole run over folders of `<table>.csv` files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parcelflow.plans import build
from parcelflow.sources import schemas


def main() -> int:
    parser = argparse.ArgumentParser(prog="parcelflow", description="Load, enrich, score, export and check fulfilment data.")
    parser.add_argument("source", help="folder with one CSV per source table")
    parser.add_argument("config", help="folder with warehouses, carriers, sla_targets and anomaly_windows CSVs")
    parser.add_argument("out", help="folder for all written tables")
    parser.add_argument("--min-shipments", type=int, default=None, help="least shipments of a flagged segment-week")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("parcelflow").getOrCreate()
    paths = {name: f"{args.source}/{name}.csv" for name in schemas.SOURCE_TABLES}
    params = {} if args.min_shipments is None else {"min_shipments": args.min_shipments}
    tables = build.run(spark, paths, args.config, args.out, **params)
    tables["anomaly_validation_summary"].show(truncate=False)
    failed = tables["quality_report"].where("status = 'fail'")
    failed.show(truncate=False)
    return 0 if failed.isEmpty() else 1


if __name__ == "__main__":
    raise SystemExit(main())
