"""Bronze, silver and gold as three stages that hand over written tables."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from millwatch import schemas
from millwatch.operators import incremental
from millwatch.operators.bronze import to_bronze
from millwatch.operators.gold import gold_risk
from millwatch.operators.quality import quarantine_distinct, split_valid
from millwatch.operators.serving import leaderboard
from millwatch.operators.silver import silver_from_bronze, to_silver
from millwatch.sources import sinks, versions
from millwatch.sources.tables import require_rows
from millwatch.sources.telemetry import read_drifting


@dataclass(frozen=True)
class Lake:
    """Targets of the four tables: paths or catalog names."""

    bronze: str
    silver: str
    quarantine: str
    gold: str


# The table names that dashboards query.
CATALOG_LAKE = Lake(
    "bronze_machine_telemetry", "silver_telemetry", "quarantine_telemetry", "gold_supply_risk"
)


def lake_at(folder: str) -> Lake:
    """The same tables as folders under a path."""
    root = folder.rstrip("/")
    return Lake(*[f"{root}/{name}" for name in astuple(CATALOG_LAKE)])


def load_bronze(spark: SparkSession, landing: str, lake: Lake) -> DataFrame:
    """Scan the landing zone; unknown fields and damaged lines are kept as text."""
    raw = require_rows(read_drifting(spark, landing), landing)
    sinks.write_table(to_bronze(raw), lake.bronze)
    return sinks.read_target(spark, lake.bronze)


def load_silver(
    spark: SparkSession, lake: Lake, run_id: str, keep_duplicates: bool = True
) -> DataFrame:
    """Write valid rows to silver and rejected rows to this run's quarantine.

    ``keep_duplicates=False`` quarantines each distinct rejected row once.
    """
    bronze = sinks.read_target(spark, lake.bronze)
    valid, rejected = split_valid(bronze)
    if not keep_duplicates:
        rejected = quarantine_distinct(bronze)
    sinks.write_quarantine(rejected, lake.quarantine, run_id)
    sinks.write_partitioned(to_silver(valid), lake.silver, replace_schema=True)
    return stored_silver(spark, lake)


def stored_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver as written, with the column types that its bronze implies."""
    layout = silver_from_bronze(sinks.read_target(spark, lake.bronze)).schema
    return sinks.read_target(spark, lake.silver, schema=layout)


def load_gold(spark: SparkSession, silver: DataFrame, lake: Lake) -> DataFrame:
    gold = gold_risk(silver)
    sinks.write_partitioned(gold, lake.gold, replace_schema=True)
    return sinks.read_target(spark, lake.gold, schema=gold.schema)


def refresh_gold(
    spark: SparkSession, silver: DataFrame, touched: DataFrame, target: str
) -> DataFrame:
    """Recompute the touched plant-days of a written gold table in place.

    A touched day that lost its last valid reading must be dropped, for
    overwriting partitions leaves it alone. Spark drops partitions of catalog
    tables only, so a path with such a day is refused before anything is written.
    Only the names of such days reach the driver.
    """
    gone = incremental.vanished_days(touched, silver)
    if sinks.is_path(target) and not gone.isEmpty():
        raise ValueError(f"{target} has days without readings: rebuild it or use a catalog table")
    fresh = incremental.recomputed_gold(silver, touched)
    sinks.write_partitioned(fresh, target, only_touched=True)
    if not sinks.is_path(target):
        sinks.drop_partitions(spark, target, [row.asDict() for row in gone.toLocalIterator()])
    return sinks.read_target(spark, target, schema=fresh.schema)


def refresh_versioned_gold(
    spark: SparkSession, silver: DataFrame, touched: DataFrame, table: str
) -> DataFrame:
    """Recompute the touched plant-days as the next version of a versioned gold table.

    Days that lost their last valid reading are left out of the new version, on any path; only
    their names reach the driver. Readers see all of the refresh or none of it, and of two
    refreshes at once the second is refused.
    """
    before = versions.manifest(spark, table)
    gone = incremental.vanished_days(touched, silver).toLocalIterator()
    names = [versions.partition_name(spark, row.asDict()) for row in gone]
    fresh = incremental.recomputed_gold(silver, touched)
    at = before.version if before else 0
    versions.commit(fresh, table, schemas.PLANT_DAY, only_touched=True, gone=names, expected=at)
    return versions.read_version(spark, table)


def run(spark: SparkSession, landing: str, lake: Lake, run_id: str) -> DataFrame:
    """All three stages; the leaderboard is read from the written gold table."""
    load_bronze(spark, landing, lake)
    silver = load_silver(spark, lake, run_id)
    return leaderboard(load_gold(spark, silver, lake))
