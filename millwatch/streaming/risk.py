"""Daily, sliding and session aggregates of a silver stream.

Readings later than the watermark are left out of these aggregates; silver
keeps them, and a batch refresh of the touched days brings them into gold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatch import schemas
from millwatch.config import WEIGHTS, RiskWeights
from millwatch.functions import measures
from millwatch.operators import serving, sessions, trailing

VERSION = "version"


def daily_risk(
    silver: DataFrame, delay: str = "1 hour", weights: RiskWeights = WEIGHTS
) -> DataFrame:
    """Gold as a tumbling one-day window, with the batch measures."""
    windows = (
        silver.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", "1 day"), "machine_id", "plant_id")
        .agg(*measures.day_measures())
    )
    return windows.withColumns(
        {"event_date": F.to_date("window.start"), "risk_score": measures.day_risk(weights)}
    ).drop("window")


def sliding_risk(
    silver: DataFrame,
    hours: int = 24,
    step_hours: int = 1,
    delay: str = "1 hour",
    weights: RiskWeights = WEIGHTS,
) -> DataFrame:
    """Sliding windows from hourly totals: state holds one row per machine and
    step, and only those rows, not the readings, enter every window they touch.

    Two stateful steps need append mode, so a window appears once it is closed.
    """
    key, step = trailing.KEY, f"{step_hours} hours"
    steps = (
        silver.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", step).alias("step"), *key)
        .agg(*trailing.partials())
    )
    windows = steps.groupBy(F.window("step", f"{hours} hours", step), *key).agg(
        *trailing.merged_partials()
    )
    return windows.select(
        *key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *trailing.results("sliding", weights),
    )


def fault_sessions(silver: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    sessions = (
        silver.filter("is_fault_event")
        .withWatermark("event_timestamp", delay)
        .groupBy(F.session_window("event_timestamp", gap).alias("session"), *trailing.KEY)
        .agg(F.count(F.lit(1)).alias("faults"), F.max("temperature_celsius").alias("max_temp"))
    )
    return sessions.select(
        *trailing.KEY,
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "faults",
        "max_temp",
    )


def _cell_totals(rows: DataFrame, width: str, delay: str, name: str, totals: list) -> DataFrame:
    cell = F.window("event_timestamp", width).alias("__in")
    found = rows.withWatermark("event_timestamp", delay).groupBy(cell, *trailing.KEY).agg(*totals)
    return found.withColumn(name, F.unix_micros("__in.start")).drop("__in")


def step_totals(silver: DataFrame, step_hours: int = 1, delay: str = "1 hour") -> DataFrame:
    """Totals of each machine and step, to be written as upserts for ``whole_windows``."""
    return _cell_totals(silver, f"{step_hours} hours", delay, "__step", trailing.partials())


def whole_windows(
    spark: SparkSession, path: str, hours: int = 24, step_hours: int = 1, weights: RiskWeights = WEIGHTS
) -> DataFrame:
    """All sliding windows of written step totals, those still open with what they have so far."""
    steps = read_upserts(spark, path, (*trailing.KEY, "__step"))
    return trailing.windows_of(steps, hours, step_hours, weights)


def fault_cells(silver: DataFrame, gap_minutes: int = 30, delay: str = "1 hour") -> DataFrame:
    """Totals of faults in cells as long as the gap, to be written as upserts for ``whole_sessions``."""
    faults = silver.filter("is_fault_event")
    return _cell_totals(faults, f"{gap_minutes} minutes", delay, "__cell", sessions.cell_totals())


def whole_sessions(spark: SparkSession, path: str, gap_minutes: int = 30) -> DataFrame:
    """All fault sessions of written cells, those still open with what they have so far."""
    return sessions.joined_cells(read_upserts(spark, path, sessions.CELL), gap_minutes)


def machine_days(silver: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Which machines sent readings on which day, to be written as upserts."""
    seen = (
        silver.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", "1 day"), "machine_id", "plant_id")
        .agg(F.count(F.lit(1)).alias("readings"))
    )
    return seen.withColumn("event_date", F.to_date("window.start")).drop("window")


def plant_machines(spark: SparkSession, path: str) -> DataFrame:
    """Machines seen per plant and day, exact: written machine-days are counted when read.

    Repeated versions of a machine-day collapse in the first grouping.
    """
    days = spark.read.parquet(path).select(*schemas.MACHINE_DAY).distinct()
    return days.groupBy(*schemas.PLANT_DAY).agg(F.count("machine_id").alias("machines"))


def stream_upserts(
    aggregates: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write changed groups after each batch as a new version of those groups."""

    def write(batch: DataFrame, batch_id: int) -> None:
        versioned = batch.withColumn(VERSION, F.lit(batch_id).cast("bigint"))
        writer = versioned.write.mode("overwrite").partitionBy(VERSION)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    writer = aggregates.writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_upserts(
    spark: SparkSession, path: str, keys: Sequence[str] = schemas.MACHINE_DAY
) -> DataFrame:
    """The newest version of every group."""
    versions = spark.read.parquet(path).withColumn(VERSION, F.col(VERSION).cast("bigint"))
    values = [c for c in versions.columns if c not in (*keys, VERSION)]
    newest = F.max_by(F.struct(*values), VERSION).alias("__newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "__newest.*")


def leaderboard(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """Top machine-days of a streamed gold table, read at any time.

    Complete output mode would keep every day in state for good; here the state
    is bounded by the watermark and the written versions hold the history.
    """
    return serving.leaderboard(read_upserts(spark, path), k)
