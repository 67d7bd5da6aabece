"""Readings that come behind the watermark: kept, told apart, and made good in gold.

Streamed aggregates leave such readings out. Here every batch is stored whole, the newest instant
seen so far is stored with it, and what lies further behind that than the delay is written to a
table of late readings. Their plant-days are the ones a refresh has to compute anew.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatch.operators import incremental

READINGS, LATE, MARKS = "readings", "late", "marks"


def newest_before(spark: SparkSession, folder: str, batch_id: int) -> datetime | None:
    """The newest instant of all batches before this one."""
    if batch_id == 0:
        return None
    mark = spark.read.schema("newest TIMESTAMP").parquet(f"{folder}/{MARKS}/batch={batch_id - 1}")
    return mark.first()["newest"]


def stream_readings(
    silver: DataFrame, folder: str, checkpoint: str, delay: str = "1 hour", once: bool = True
) -> StreamingQuery:
    """Store the readings of a stream, and beside them those that came late.

    A reading is late if it is older than the newest of all earlier batches by more than the
    delay. An aggregate with the same delay drops no other reading of these batches, since its
    own watermark follows the same instants. A batch that is run again replaces what it wrote,
    so the tables are the same after a restart.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/{READINGS}/batch={batch_id}")
        stored = spark.read.schema(batch.schema).parquet(f"{folder}/{READINGS}/batch={batch_id}")
        newest = newest_before(spark, folder, batch_id)
        known = F.lit(newest).cast("timestamp")
        behind = F.col("event_timestamp") < known - F.expr(f"INTERVAL {delay}")
        stored.filter(behind).write.mode("overwrite").parquet(f"{folder}/{LATE}/batch={batch_id}")
        mark = stored.agg(F.greatest(F.max("event_timestamp"), known).alias("newest"))
        mark.write.mode("overwrite").parquet(f"{folder}/{MARKS}/batch={batch_id}")

    writer = silver.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stored_readings(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """All readings of the stream, late ones too, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(f"{folder}/{READINGS}").select(*like.columns)


def late_readings(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The late ones of them."""
    return spark.read.schema(like.schema).parquet(f"{folder}/{LATE}").select(*like.columns)


def completed_gold(streamed: DataFrame, readings: DataFrame, late: DataFrame) -> DataFrame:
    """Streamed gold with the plant-days of late readings computed anew from all readings."""
    touched = incremental.touched_days(late)
    fresh = incremental.recomputed_gold(readings, touched).select(*streamed.columns)
    kept = streamed.join(touched, touched.columns, "left_anti")
    return kept.unionByName(fresh).select(*streamed.columns)
