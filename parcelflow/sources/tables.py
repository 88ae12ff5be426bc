"""CSV and Parquet sources and sinks, and the bronze load."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelflow.config import local_table
from parcelflow.functions.scalars import blank_to_null
from parcelflow.functions.scratch import stored
from parcelflow.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Scan headed CSV files; blank text becomes NULL.

    With a schema, its columns must be in the header, in any order, and get their types; further columns are
    kept as text, and a malformed row or value fails the job. Without one, types are inferred over the whole
    input, which costs a second scan. `multi_line` allows line breaks inside
    quoted values, but then a file is one task: leave it off for large inputs without such values.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
    )
    df = reader.option("inferSchema", schema is None).csv(path)
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    if absent := sorted(set(types) - set(df.columns)):
        raise ValueError(f"{path} has no columns {', '.join(absent)}")
    if schema:
        df = df.select(*(F.trim(F.col(f"`{c}`")).cast(types[c]).alias(c) if c in types and types[c] != StringType() else F.col(f"`{c}`") for c in df.columns))
    return df.select(
        *(
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def read_csv_quarantined(
    spark: SparkSession, path: str, schema: StructType, max_bad_share: float = 1.0, names: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scan headed CSV files without line breaks in values: the good rows typed by `schema`, and the bad lines as `file, line, reason`.

    A line is bad if it has too few or too many values, a quote that is not closed, or a value that does not cast to its type (blank text is NULL, not bad). Columns of
    the header that the schema lacks are kept as text; all its own must be there. Lines equal to the header are headers; with `names` of the columns there are none. Every other line is in exactly
    one of both results. Lines are parsed once, into a scratch table; a share of bad lines above `max_bad_share` fails the load.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    header = None if names else lines.first()
    names = names or next(csv.reader([header.line]), []) if header or names else []
    types = {f.name: f.dataType for f in schema.fields}
    if absent := sorted(set(types) - set(names)):
        raise ValueError(f"{path} has no columns {', '.join(absent)}")
    text = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))] + [StructField("corrupt", StringType())])
    body = lines.where(F.col("line") != header.line) if header else lines
    cells = body.withColumn("cells", F.from_csv("line", text.simpleString()[7:-1].replace(":", " "), {"escape": '"', "columnNameOfCorruptRecord": "corrupt", "mode": "PERMISSIVE"}))
    value = {n: blank_to_null(F.trim(f"cells.c{i}") if types.get(n, StringType()) != StringType() else F.col(f"cells.c{i}")) for i, n in enumerate(names)}
    typed = {n: v.try_cast(types[n]) if n in types else v for n, v in value.items()}
    reason = F.when(F.col("cells.corrupt").isNotNull() | F.col("cells").isNull(), "wrong number of values")
    for n in types:
        reason = reason.when(value[n].isNotNull() & typed[n].isNull(), f"no {types[n].simpleString()} in {n}")
    parsed = stored(cells.select("file", "line", reason.alias("reason"), F.struct(*(typed[n].alias(n) for n in names)).alias("row")), "csv-lines")
    bad, every = parsed.agg(F.count("reason"), F.count(F.lit(1))).first()
    if bad > max_bad_share * every:
        raise ValueError(f"{path}: {bad} of {every} lines are bad")
    return parsed.where("reason IS NULL").select("row.*"), parsed.where("reason IS NOT NULL").select("file", "line", "reason")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Write headed CSV and return the number of rows, counted while writing.

    The order of `df` is kept across the numbered part files. `single_file` gives one file through one
    task: only for small results.
    """
    counted, written = _observed(df)
    out = written.coalesce(1) if single_file else written
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return counted.get["row_count"]


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Create or replace a Parquet table and return its number of rows, counted while writing.

    With `partition_by`, rows are first rebalanced by those columns: few files per value, and adaptive
    execution splits a value that holds too much for one task.
    """
    counted, written = _observed(df.hint("rebalance", *partition_by) if partition_by else df)
    writer = written.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return counted.get["row_count"]


def _observed(df: DataFrame) -> tuple[Observation, DataFrame]:
    counted = Observation()
    return counted, df.observe(counted, F.count(F.lit(1)).alias("row_count"))


def materialize(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` as a table and return the table: a cut in the lineage that survives lost executors."""
    write_table(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def load_bronze(
    spark: SparkSession,
    paths: Mapping[str, str],
    out_dir: str,
    schema_of: Mapping[str, StructType] = schemas.BRONZE_TABLES,
    multi_line: tuple[str, ...] = (),
) -> DataFrame:
    """Load the headed CSVs at `paths` (table name to path) into Parquet; returns `table_name, row_count`.

    Tables named in `multi_line` may hold line breaks inside quoted values.
    """
    counts = []
    for name, path in paths.items():
        df = read_csv(spark, path, schema_of[name], multi_line=name in multi_line)
        counts.append((name, write_table(df, f"{out_dir}/{name}")))
    return local_table(spark, counts, "table_name string, row_count bigint")


def read_config(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four config tables from `<name>.csv` in a folder."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.CONFIG_TABLES.items()}


def read_tables(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`table_name, row_count` of every table, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
