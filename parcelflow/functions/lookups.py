"""Lookup tables: one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, so that a left join on it never multiplies rows.

    Map-side combine leaves one row per key and task, whatever the number of copies. Write the
    result before joining it: adaptive execution does not split a join whose side ends in an aggregate.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
