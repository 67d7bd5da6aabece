"""Resends told apart however late they come, by an index of the readings seen so far.

State of a stream ends with its watermark; the index is a table by day, so it may hold years and
costs no memory. A batch reads only the days that its own readings fall on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEY = ("machine_id", "event_timestamp")
ROWS, SEEN = "rows", "seen"


def seen_before(spark: SparkSession, folder: str, days: list[date], batch_id: int) -> DataFrame:
    """Machine and instant of the readings that earlier batches brought for these days.

    Days and batches are partitions: the others are not read. A batch that is run again does not
    find its own readings.
    """
    index = spark.read.schema("machine_id STRING, event_timestamp TIMESTAMP, batch BIGINT, day DATE")
    known = index.parquet(f"{folder}/{SEEN}")
    return known.filter(F.col("day").isin(days) & (F.col("batch") < batch_id)).select(*KEY)


def stream_first_readings(
    readings: DataFrame, folder: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Store each reading the first time it comes; resends of any age are left out.

    Machine and instant identify a reading; those that lack either are all kept. Of copies inside
    one batch one stays, as ``dedupe_stream`` does it. The index is made from the rows that were
    stored, and a batch that is run again replaces both, so they agree after a restart. Only the
    days of a batch reach the driver, the names of the partitions it touches.
    """
    named = F.col("machine_id").isNotNull() & F.col("event_timestamp").isNotNull()
    day = F.to_date("event_timestamp").alias("day")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            first = rows.filter(named).dropDuplicates(list(KEY))
            days = [row.day for row in rows.filter(named).select(day).distinct().collect()]
            if batch_id > 0 and days:
                known = seen_before(spark, folder, days, batch_id)
                first = first.join(known, list(KEY), "left_anti").select(*batch.columns)
            kept = first.unionByName(rows.filter(~named))
            kept.write.mode("overwrite").parquet(f"{folder}/{ROWS}/batch={batch_id}")
        finally:
            rows.unpersist()
        stored = spark.read.schema(batch.schema).parquet(f"{folder}/{ROWS}/batch={batch_id}")
        keys = stored.filter(named).select(*KEY, day).hint("rebalance", F.col("day"))
        keys.write.mode("overwrite").partitionBy("day").parquet(f"{folder}/{SEEN}/batch={batch_id}")

    writer = readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def first_readings(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """All readings stored so far, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(f"{folder}/{ROWS}").select(*like.columns)
