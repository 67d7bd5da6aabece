"""Incremental runs: new files of the landing zone go into silver, quarantine and gold's states.

Each batch of files is split once into silver and quarantine and its readings are merged into the
stored states, all under the number of the batch. The states keep the number of the last batch in
their manifest, so a batch that is run again after a failure is not counted twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millwatch import schemas
from millwatch.config import LIMITS, WEIGHTS, RiskWeights, SensorLimits
from millwatch.operators import incremental, states
from millwatch.operators.bronze import to_bronze
from millwatch.sources import versions
from millwatch.sources.telemetry import stream_drifting
from millwatch.streaming.silver import stream_silver


@dataclass(frozen=True)
class Increments:
    """The folders of an incremental lake."""

    folder: str

    def at(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    silver = property(lambda self: self.at("silver_telemetry"))
    quarantine = property(lambda self: self.at("quarantine_telemetry"))
    states = property(lambda self: self.at("gold_states"))
    checkpoint = property(lambda self: self.at("_checkpoints/increments"))


def merge_readings(spark: SparkSession, silver: DataFrame, table: str, batch: int) -> int | None:
    """Add readings to a versioned table of states as the next version.

    Only the plant-days of these readings are read and written. A batch number at or below that
    of the table was merged before and is left out (None).
    """
    before = versions.manifest(spark, table)
    if before and before.batch is not None and batch <= before.batch:
        return None
    fresh = states.day_states(silver)
    if before:
        touched = incremental.touched_days(silver)
        near = versions.read_version(spark, table).join(touched, list(schemas.PLANT_DAY), "left_semi")
        fresh = states.merged_states(near, fresh)
    return versions.commit(
        fresh,
        table,
        schemas.PLANT_DAY,
        only_touched=True,
        expected=before.version if before else 0,
        batch=batch,
    )


def withdraw_readings(spark: SparkSession, remaining: DataFrame, touched: DataFrame, table: str) -> int:
    """Compute the states of plant-days that lost readings anew, from the silver that remains.

    Days without any reading left are dropped; only their names reach the driver.
    """
    before = versions.manifest(spark, table)
    gone = incremental.vanished_days(touched, remaining).toLocalIterator()
    names = [versions.partition_name(spark, row.asDict()) for row in gone]
    near = remaining.join(touched, list(schemas.PLANT_DAY), "left_semi")
    return versions.commit(
        states.day_states(near),
        table,
        schemas.PLANT_DAY,
        only_touched=True,
        gone=names,
        expected=before.version if before else 0,
    )


def stored_gold(spark: SparkSession, table: str, weights: RiskWeights = WEIGHTS) -> DataFrame:
    """Gold of the newest version of the states."""
    return states.gold_of_states(versions.read_version(spark, table), weights)


def stream_increments(
    bronze: DataFrame,
    lake: Increments,
    limits: SensorLimits = LIMITS,
    once: bool = True,
    most_folders: int = 16,
) -> StreamingQuery:
    """Take every batch of a bronze stream into silver, quarantine and the states.

    A batch that failed between the writes is run again: it replaces its own files, and its
    states are merged unless the manifest shows that they are. The states are brought back to
    ``most_folders`` folders as they grow.
    """

    def merge(silver: DataFrame, batch_id: int) -> None:
        merge_readings(silver.sparkSession, silver, lake.states, batch_id)
        versions.compact(silver.sparkSession, lake.states, most_folders)

    return stream_silver(
        bronze, lake.silver, lake.quarantine, lake.checkpoint, "increment", limits, once, merge
    )


def refresh(spark: SparkSession, landing: str, folder: str, max_files: int = 1000) -> DataFrame | None:
    """Take in what landed since the last refresh and return gold (None before any batch).

    ``max_files`` bounds one batch of a backlog.
    """
    lake = Increments(folder)
    bronze = to_bronze(stream_drifting(spark, landing, max_files))
    stream_increments(bronze, lake).awaitTermination()
    return stored_gold(spark, lake.states) if versions.manifest(spark, lake.states) else None
