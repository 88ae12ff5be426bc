"""Daily flag counts of shipments as they arrive, by event time and exactly once.

Two streams, each run over what has arrived (`availableNow`) and then ended, so that a run can be started again at any time:

1. `accept` lands new files of shipments: of rows with one `shipment_id` the first is accepted, as long as the watermark has not passed its
   purchase day; ids are forgotten with their day, so state is bounded by the delay. Accepted rows go to a file sink.
2. `close_days` counts accepted rows by day and segment. A day is written once, when the watermark has passed it.

Both sinks record the files of each batch and both streams their progress in a checkpoint; a run that dies is repeated without loss or
double counting. The second stream never is ahead of the first, so nothing that was accepted is late for it. `current_counts` adds the days
that are still open, from accepted rows, and `late_rows` finds what arrived and was neither accepted nor a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

DELAY = "7 days"
KEY, DAY = "shipment_id", "order_purchase_date"
GROUPS = ("warehouse_id", "carrier_id", "anomaly_flag")
EVENT_TIME = "event_time"
DAILY = "event_time timestamp, warehouse_id string, carrier_id string, anomaly_flag string, shipments long, breaches long, damages long"


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("shipments"),
        F.count_if("sla_breach_flag").alias("breaches"),
        F.count_if(F.coalesce(F.col("issue_type") == "damaged", F.lit(False))).alias("damages"),
    ]


def _run(frame: DataFrame, out: str, checkpoint: str) -> dict:
    """One run over all that is there; returns the rows that stateful operators dropped as late."""
    writer = frame.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()
    return {"late": sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])}


def accept(spark: SparkSession, arrivals: str, schema: StructType, root: str, delay: str = DELAY, files_each: int | None = None) -> dict:
    """Accept new files of the folder `arrivals` into `root`/accepted. A row without id or day is never accepted."""
    reader = spark.readStream.schema(schema)
    if files_each:
        reader = reader.option("maxFilesPerTrigger", files_each)
    rows = reader.parquet(arrivals).where(F.col(KEY).isNotNull() & F.col(DAY).isNotNull())
    timed = rows.withColumn(EVENT_TIME, F.col(DAY).cast("timestamp")).withWatermark(EVENT_TIME, delay)
    return _run(timed.dropDuplicatesWithinWatermark([KEY]), f"{root}/accepted", f"{root}/checkpoints/accept")


def _accepted(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(EVENT_TIME, TimestampType())])


def close_days(spark: SparkSession, schema: StructType, root: str, delay: str = DELAY) -> dict:
    """Count newly accepted rows; days that the watermark has passed are appended to `root`/daily."""
    rows = spark.readStream.schema(_accepted(schema)).parquet(f"{root}/accepted").withWatermark(EVENT_TIME, delay)
    return _run(rows.groupBy(EVENT_TIME, *GROUPS).agg(*_measures()), f"{root}/daily", f"{root}/checkpoints/daily")


def closed_days(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DAILY).parquet(f"{root}/daily").select(F.col(EVENT_TIME).cast("date").alias(DAY), *GROUPS, "shipments", "breaches", "damages")


def current_counts(spark: SparkSession, schema: StructType, root: str) -> DataFrame:
    """Counts of all days: closed ones as written, and those after the last closed day from the accepted rows."""
    closed = closed_days(spark, root)
    last = closed.agg(F.max(DAY).alias("last")).select("last").scalar()
    still_open = spark.read.schema(_accepted(schema)).parquet(f"{root}/accepted").where(last.isNull() | (F.col(DAY) > last))
    return closed.unionByName(still_open.groupBy(DAY, *GROUPS).agg(*_measures()))


def late_rows(spark: SparkSession, arrivals: str, schema: StructType, root: str) -> DataFrame:
    """Arrived rows whose id was never accepted: they came after their day was closed, or lack an id or a day."""
    landed = spark.read.schema(schema).parquet(arrivals)
    return landed.join(spark.read.schema(_accepted(schema)).parquet(f"{root}/accepted").select(KEY), KEY, "left_anti")
