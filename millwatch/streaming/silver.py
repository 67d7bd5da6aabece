"""Bronze to silver and quarantine, resend suppression and enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatch import schemas
from millwatch.config import LIMITS, SensorLimits
from millwatch.operators.quality import quarantine_all
from millwatch.operators.silver import silver_from_bronze
from millwatch.sources.sinks import rebalanced

BATCH = "stream_batch"


def _write_batch(rows: DataFrame, target: str, keys: tuple[str, ...]) -> None:
    """Replace what this batch wrote before, if a failure made it run again."""
    writer = rows.write.mode("overwrite").partitionBy(*keys, BATCH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(target)


def stream_silver(
    bronze: DataFrame,
    silver_path: str,
    quarantine_path: str,
    checkpoint: str,
    run_id: str = "stream",
    limits: SensorLimits = LIMITS,
    once: bool = True,
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Gate, split and write both tables from one pass over each batch.

    Silver is partitioned by plant and day first, so readers prune as on the
    batch table; the batch comes last and makes a repeated batch replace its
    own files. Late readings are kept here whatever aggregates do with them.
    ``then`` is called with the silver rows of each batch once they are written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BATCH, F.lit(f"{run_id}-{batch_id}")).persist()
        try:
            silver = silver_from_bronze(rows, limits)
            _write_batch(rebalanced(silver, schemas.PLANT_DAY), silver_path, schemas.PLANT_DAY)
            _write_batch(rebalanced(quarantine_all(rows, limits)), quarantine_path, ())
            if then:
                then(silver, batch_id)
        finally:
            rows.unpersist()

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: tuple[str, ...] = (),
    once: bool = True,
) -> StreamingQuery:
    """Append a stream to Parquet, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if keys:
        writer = writer.partitionBy(*keys)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def dedupe_stream(readings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Suppress resends that come within the watermark delay.

    Readings carry no event id, so machine and instant identify one. Readings
    that lack either all pass.
    """
    named = F.col("machine_id").isNotNull() & F.col("event_timestamp").isNotNull()
    marked = readings.filter(named).withWatermark("event_timestamp", delay)
    once = marked.dropDuplicatesWithinWatermark(["machine_id", "event_timestamp"])
    return once.unionByName(readings.filter(~named))
