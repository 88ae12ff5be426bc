"""Table differences and the refresh of weeks."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import changes
from parcelflow.plans import incremental
from parcelflow.sources import star

SCHEMA = "a int, b string, c double"


def load(n, seed):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(40)]), draw.choice([None, "x", "y"]), draw.choice([None, 0.0, 1.5])) for _ in range(n)]


def by_key(rows):
    found = {}
    for row in rows:
        found.setdefault(row[:2], Counter())[row] += 1
    return found


def test_diff_of_repeated_and_null_keys(spark):
    """Whatever the order of rows; the rows of a key are a multiset."""
    old, new = load(150, 1), load(150, 2)
    new[:60] = old[:60]
    left, right = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).select("c", "b", "a").repartition(3)
    before, after = by_key(old), by_key(new)
    wanted = {k: ("added" if k not in before else "removed" if k not in after else "changed", sum(before.get(k, {}).values()), sum(after.get(k, {}).values())) for k in before | after if before.get(k) != after.get(k)}
    found = changes.table_diff(left, right, ["a", "b"]).collect()
    assert {(r.a, r.b): (r.change, r.old_rows, r.new_rows) for r in found} == wanted and len(found) == len(wanted)
    assert {x[0] for x in wanted.values()} == {"added", "removed", "changed"}
    made = changes.apply_changes(left, changes.change_set(left, right, ["a", "b"]), ["a", "b"])
    assert Counter(tuple(r) for r in made.select("a", "b", "c").collect()) == Counter(new)


def test_diff_tells_nulls_apart_and_pairs_from_pairs(spark):
    old = [(1, None, 1.0), (2, "x", None), (3, "x", 1.0), (3, "x", 1.0), (4, "x", 1.0)]
    new = [(1, "x", None), (2, None, None), (3, "y", 1.0), (3, "y", 1.0), (4, "x", 1.0)]
    found = changes.table_diff(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["a"]).collect()
    assert sorted((r.a, r.change) for r in found) == [(1, "changed"), (2, "changed"), (3, "changed")]
    same = spark.createDataFrame(old, SCHEMA)
    assert changes.table_diff(same, same, ["a"]).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        changes.table_diff(same, same.drop("c"), ["a"])


def weeks_of(path):
    return {p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")) for p in Path(path).glob("week_start_date=*")}


def test_refresh_equals_a_full_build(spark, tmp_path):
    """Inserts, deletes, a late row, an emptied week, and changes of a customer and a product; other weeks keep their files."""
    sf = "/root/testdata/sf0.001"
    old, routing = star.source_tables(spark, sf), star.routing(spark, sf)
    orders = old["raw_orders"]
    day = F.to_date("order_purchase_timestamp")
    week = F.trunc(day, "week")
    moved = F.col("order_id") == orders.where("order_status = 'delivered'").agg(F.min("order_id")).first()[0]
    changed = orders.where(week != F.lit("1997-03-03")).withColumn("order_delivered_customer_date", F.when(moved, F.date_add("order_delivered_customer_date", 9)).otherwise(F.col("order_delivered_customer_date")).cast("timestamp"))
    late = orders.where(week == F.lit("1998-04-06")).limit(1).withColumn("order_id", F.lit("late"))
    customer = old["raw_customers"].agg(F.max("customer_id")).first()[0]
    new = {
        **old,
        "raw_orders": changed.unionByName(late.select(*orders.columns)),
        "raw_customers": old["raw_customers"].withColumn("customer_state", F.when(F.col("customer_id") == customer, "NATION_0").otherwise(F.col("customer_state"))),
    }
    new = {name: spark.createDataFrame(df.collect(), df.schema) if name in ("raw_orders", "raw_customers") else df for name, df in new.items()}
    out, full = str(tmp_path / "refreshed"), str(tmp_path / "full")
    incremental.build_weeks(old, routing, out, star.RULES)
    before = {name: weeks_of(f"{out}/{name}") for name in incremental.TABLES}
    rebuilt = incremental.refresh_weeks(old, new, routing, out, star.RULES)
    incremental.build_weeks(new, routing, full, star.RULES)
    touched = {f"week_start_date={w}" for w in rebuilt}
    assert "week_start_date=1997-03-03" in touched and "week_start_date=1998-04-06" in touched
    for name in incremental.TABLES:
        a, b = (incremental.read_weeks(spark, path, name) for path in (out, full))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count()
        after = weeks_of(f"{out}/{name}")
        assert before[name].keys() - after.keys() == {"week_start_date=1997-03-03"}
        assert len(before[name].keys() - touched) > 50
        assert all(after[w] == files for w, files in before[name].items() if w not in touched)
    assert incremental.refresh_weeks(new, new, routing, out, star.RULES) == []
