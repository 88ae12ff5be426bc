"""Run a query and its SQL side by side and report differences."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value):
    """Type of a value as the comparison sees it: engines may differ in integer width only."""
    return "int" if isinstance(value, int) and not isinstance(value, bool) else type(value).__name__


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(r[n] for n in names) for r in df.collect()]


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], [tuple(r[i] for i in order) for r in cursor.fetchall()]


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and the same rows, else what differs."""
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} against {wanted_names}"
    left, right = Counter(map(_key, got)), Counter(map(_key, wanted))
    if left == right:
        return None
    return (
        f"{len(got)} against {len(wanted)} rows; {names}\n only Spark: {list((left - right).elements())[:3]}"
        f"\n only SQL:   {list((right - left).elements())[:3]}"
    )


def _key(row):
    return tuple((kind(v), str(v) if isinstance(v, Decimal) else v) for v in row)
