"""The difference of two loads of a table: by key, as a change set that turns the one into the other, or row by row with multiplicities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored

ADD, REMOVE = "add", "remove"


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """64 bits of the named columns. A NULL alone would leave the hash as it was, so it is hashed as a flag."""
    return F.xxhash64(F.lit(seed), *(x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())))


def _same_columns(old: DataFrame, new: DataFrame) -> list[str]:
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    return old.columns


def _signatures(df: DataFrame, key: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Per key its rows and, whatever their order, two sums of their hashes."""
    hashed = df.select(*key, *(row_hash(columns, seed).cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)))
    return hashed.groupBy(*(F.col(c).alias(f"{name}_{i}") for i, c in enumerate(key))).agg(
        F.count(F.lit(1)).alias(f"{name}_rows"), F.struct(F.sum("h1"), F.sum("h2")).alias(f"{name}_hash")
    )


def _all_equal(left: list[Column], right: list[Column]) -> Column:
    """NULL-safe; equality of columns, so a sort-merge or hash join."""
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same &= a.eqNullSafe(b)
    return same


def table_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """`key, change, old_rows, new_rows` for every key whose rows differ: `added`, `removed` or `changed`.

    A full outer join of keys with the number and the hashes of their rows: texts and other wide columns are read
    and hashed where they are, never shuffled. Values are compared NULL-safe, NULL being a key like any other. A repeated key stands for the
    multiset of its rows, combined before the shuffle. Both tables need the same columns, in any order, none of them a map.
    """
    key, columns = list(key), _same_columns(old, new)
    before, after = _signatures(old, key, columns, "old"), _signatures(new, key, columns, "new")
    numbers = range(len(key))
    joined = before.join(after, _all_equal([before[f"old_{i}"] for i in numbers], [after[f"new_{i}"] for i in numbers]), "full_outer")
    change = F.when(F.col("old_rows").isNull(), "added").when(F.col("new_rows").isNull(), "removed")
    change = change.when((F.col("old_rows") != F.col("new_rows")) | (F.col("old_hash") != F.col("new_hash")), "changed")
    value = [F.when(F.col("old_rows").isNull(), F.col(f"new_{i}")).otherwise(F.col(f"old_{i}")).alias(c) for i, c in enumerate(key)]
    counts = [F.coalesce(f"{name}_rows", F.lit(0).cast("long")).alias(f"{name}_rows") for name in ("old", "new")]
    return joined.select(*value, change.alias("change"), *counts).where(F.col("change").isNotNull())


def _at(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    named = keys.select(*(F.col(c).alias(f"changed_{i}") for i, c in enumerate(key)))
    return df.join(named, _all_equal([df[c] for c in key], [named[f"changed_{i}"] for i in range(len(key))]), how)


def change_set(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows to take from `old` (`op` is `remove`) and those to put there (`add`) to get `new`; all rows of a key that changes are replaced."""
    columns = _same_columns(old, new)
    differing = stored(table_diff(old, new, key), "table-diff")
    parts = [_at(df.select(*columns), differing, key, "left_semi").select(F.lit(op).alias("op"), *columns) for op, df in ((REMOVE, old), (ADD, new))]
    return parts[0].unionByName(parts[1])


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """`old` after a change set."""
    kept = _at(old, changes.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(changes.where(F.col("op") == ADD).drop("op"))


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of both tables with `left_count`, `right_count`, `common` (INTERSECT ALL), `left_surplus` and `right_surplus` (EXCEPT ALL either way).

    One union and one aggregation, combined before the shuffle, so a row that is repeated any number of times is no hot key; NULLs are
    equal to each other, as in set operations.
    """
    columns = _same_columns(left, right)
    sides = [df.select(*columns, F.lit(int(i == 0)).alias("in_left"), F.lit(int(i == 1)).alias("in_right")) for i, df in enumerate((left, right))]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("in_left").alias("left_count"), F.sum("in_right").alias("right_count"))
    more = F.col("left_count") - F.col("right_count")
    return counted.select(
        "*", F.least("left_count", "right_count").alias("common"), F.greatest(more, F.lit(0)).alias("left_surplus"), F.greatest(-more, F.lit(0)).alias("right_surplus")
    )


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as the column `times` says, in two steps, so that no row becomes one array of all its copies."""
    run = 1_000_000
    runs = rows.where(F.col(times) > 0).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / run))))
    size = F.least(F.lit(run), F.col(times) - F.col("_run") * run)
    return runs.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("_run", "_copy", times)
