"""Data-quality checks: each returns the violations, so no row means the check passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.config import local_table
from parcelflow.functions.scalars import is_blank


def _unpivot_counts(df: DataFrame, counts: Mapping[tuple[str, str], Column], names=("check_name", "column_name")) -> DataFrame:
    """All conditions counted in one pass over `df`, then one row per condition."""
    totals = df.agg(*(F.count_if(c).alias(f"c{i}") for i, c in enumerate(counts.values())))
    cells = [
        F.struct(F.lit(key[0]).alias(names[0]), F.lit(key[1]).alias(names[1]), F.col(f"c{i}").alias("violations"))
        for i, key in enumerate(counts)
    ]
    return totals.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`column_name, violations` for each column that holds NULLs; one pass for all columns."""
    counts = {("not_null", c): F.col(c).isNull() for c in columns}
    return _unpivot_counts(df, counts).where(F.col("violations") > 0).select("column_name", "violations")


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their count."""
    known = df
    for column in key:
        known = known.where(F.col(column).isNotNull())
    return known.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent row, with their number of rows.

    Both sides are reduced to distinct keys first: copies of a hot key collapse before the join.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key_value")).agg(F.count(F.lit(1)).alias("row_count"))
    parents = parent.select(F.col(parent_column).alias("key_value")).distinct()
    return keys.join(parents, "key_value", "left_anti")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def unaccepted_values(df: DataFrame, column: str, accepted: Iterable[str]) -> DataFrame:
    """Values outside the accepted list, with their count; NULL is not judged."""
    return value_counts(df, column).where(~F.col("value").isin(*accepted))


def missing_values(df: DataFrame, column: str, required: Iterable[str]) -> DataFrame:
    """Required values that do not occur."""
    wanted = local_table(df.sparkSession, [(v,) for v in required], "value string")
    present = df.where(F.col(column).isin(*required)).select(F.col(column).alias("value")).distinct()
    return wanted.join(present, "value", "left_anti")


def bad_date_order(shipments: DataFrame) -> DataFrame:
    """Shipments delivered, or promised, before they were bought."""
    bought = F.col("order_purchase_date")
    early = (F.col("delivered_customer_date").isNotNull() & (F.col("delivered_customer_date") < bought)) | (
        F.col("estimated_delivery_date") < bought
    )
    return shipments.where(early).select(
        "shipment_id", "order_id", "order_purchase_date", "delivered_customer_date", "estimated_delivery_date"
    )


def blank_keys(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """`table_name, violations` for tables whose key is NULL or blank somewhere."""
    parts = [
        df.agg(F.count_if(is_blank(F.col(column))).alias("violations")).select(F.lit(name).alias("table_name"), "violations")
        for name, df in tables.items()
    ]
    return _union(parts).where(F.col("violations") > 0)


def empty_tables(counts: DataFrame) -> DataFrame:
    """Tables without rows, from `table_name, row_count`."""
    return counts.where(F.col("row_count") <= 0)


def row_count_status(counts: DataFrame) -> DataFrame:
    """`table_name, row_count, status`: a table without rows fails."""
    return counts.select("table_name", "row_count", F.when(F.col("row_count") > 0, "pass").otherwise("fail").alias("status"))


def unexpected_counts(counts: DataFrame, expected: DataFrame, exact: Iterable[str], larger: Iterable[str]) -> DataFrame:
    """Tables whose row count is not the expected one, or not above it.

    `expected` is one row with `expected_rows`, computed from the orders rather than fixed.
    """
    wanted = expected.select("expected_rows").scalar()
    judged = counts.withColumn("expected_rows", wanted)
    must_equal = F.col("table_name").isin(*exact) & (F.col("row_count") != F.col("expected_rows"))
    must_exceed = F.col("table_name").isin(*larger) & (F.col("row_count") <= F.col("expected_rows"))
    return judged.where(must_equal | must_exceed)


def missed_labels(summary: DataFrame, label_metrics: DataFrame) -> DataFrame:
    """Expected labels that were not found, or judged by another metric."""
    expected = label_metrics.withColumnRenamed("validation_metric", "expected_metric")
    joined = expected.join(summary.select("anomaly_id", "validation_metric", "detected"), "anomaly_id", "left")
    passed = (F.col("validation_metric") == F.col("expected_metric")) & F.col("detected")
    return joined.where(~F.coalesce(passed, F.lit(False))).select(
        "anomaly_id", "expected_metric", "validation_metric", F.coalesce("detected", F.lit(False)).alias("detected")
    )


# --- structure -------------------------------------------------------------------------------------


def missing_columns(df: DataFrame, required: StructType | Iterable[str]) -> set[str]:
    names = required.names if isinstance(required, StructType) else required
    return set(names) - set(df.columns)


def missing_tables(spark: SparkSession, expected: Iterable[str], database: str | None = None) -> set[str]:
    return set(expected) - {t.name for t in spark.catalog.listTables(database)}


def config_faults(frames: Mapping[str, DataFrame], specs: Mapping[str, StructType], rows: Mapping[str, int]) -> DataFrame:
    """`table_name, column_name, fault, expected, found`: one row per fault, none if the config is sound.

    Wanted and present columns are compared as tables; row counts are exact, and `found` reports them.
    """
    spark = next(iter(frames.values())).sparkSession
    wanted = local_table(spark, [(t, c) for t, schema in specs.items() for c in schema.names], "table_name string, column_name string")
    there = local_table(spark, [(t, c) for t, df in frames.items() for c in df.columns], "table_name string, column_name string")
    lacking = wanted.join(there, ["table_name", "column_name"], "left_anti").select("*", F.lit("absent column").alias("fault"), F.lit(1).alias("expected"), F.lit(0).cast("long").alias("found"))
    sizes = _union([df.agg(F.count(F.lit(1)).alias("found")).select(F.lit(t).alias("table_name"), "found") for t, df in frames.items()])
    judged = local_table(spark, list(rows.items()), "table_name string, expected int").join(sizes, "table_name", "left")
    uneven = judged.where(~F.col("found").eqNullSafe(F.col("expected"))).select(
        "table_name", F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("found").isNull(), "absent table").otherwise("row count").alias("fault"), "expected", F.coalesce("found", F.lit(0).cast("long")).alias("found"),
    )
    return lacking.unionByName(uneven)


# --- suite -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """The column checks of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] | None = None
    relationships: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)
    date_order: bool = False


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def suite_report(tables: Mapping[str, DataFrame], checks: Mapping[str, TableChecks]) -> DataFrame:
    """`check_name, table_name, column_name, violations, status`, one row per check.

    Row checks of a table (NULLs, accepted values, date order) share one pass over it.
    """
    parts = []
    for name, spec in checks.items():
        df = tables[name]
        row_checks = {("not_null", c): F.col(c).isNull() for c in spec.not_null}
        for column, values in (spec.accepted or {}).items():
            row_checks["accepted_values", column] = ~F.col(column).isin(*values)
        if spec.date_order:
            bought = F.col("order_purchase_date")
            row_checks["date_order", "order_purchase_date"] = (F.col("delivered_customer_date") < bought) | (
                F.col("estimated_delivery_date") < bought
            )
        if row_checks:
            parts.append(_unpivot_counts(df, row_checks).withColumn("table_name", F.lit(name)))
        for column in spec.unique:
            parts.append(_counted("unique", name, column, duplicates(df, column)))
        for column, parent, parent_column in spec.relationships:
            found = orphans(df, column, tables[parent], parent_column)
            parts.append(_counted("relationships", name, column, found, F.coalesce(F.sum("row_count"), F.lit(0))))
    return _with_status(_union(parts))


def reported(check: str, table: str, column: str | None, found: DataFrame) -> DataFrame:
    """A check whose violations are the rows of `found`, as a row of the report."""
    return _with_status(_counted(check, table, column, found))


def _with_status(parts: DataFrame) -> DataFrame:
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return parts.select("check_name", "table_name", "column_name", "violations", status.alias("status"))


def _counted(check: str, table: str, column: str | None, found: DataFrame, measure: Column | None = None) -> DataFrame:
    counted = found.agg((F.count(F.lit(1)) if measure is None else measure).alias("violations"))
    return counted.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"), "violations")
