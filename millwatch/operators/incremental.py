"""Incremental gold: recompute only the plant-days that got new readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators.gold import gold_risk


def touched_days(changed: DataFrame) -> DataFrame:
    return changed.select(*schemas.PLANT_DAY).distinct()


def recomputed_gold(silver: DataFrame, touched: DataFrame) -> DataFrame:
    """Gold of the touched plant-days only.

    The semi join is on silver's partition columns, so on a partitioned table
    the untouched partitions are pruned when the query runs.
    """
    return gold_risk(silver.join(touched, list(schemas.PLANT_DAY), "left_semi"))


def refreshed_gold(gold: DataFrame, silver: DataFrame, touched: DataFrame) -> DataFrame:
    """Gold after a refresh, as one DataFrame: equal to a full rebuild."""
    kept = gold.join(touched, list(schemas.PLANT_DAY), "left_anti")
    return kept.unionByName(recomputed_gold(silver, touched))


def vanished_days(touched: DataFrame, remaining: DataFrame) -> DataFrame:
    """Touched plant-days without any row left in silver or gold, to be dropped.

    Overwriting only the touched partitions never empties one. Only touched partitions of
    ``remaining`` are looked at.
    """
    near = remaining.select(*schemas.PLANT_DAY).join(touched, list(schemas.PLANT_DAY), "left_semi")
    left = near.distinct()
    gone = touched.join(left, list(schemas.PLANT_DAY), "left_anti")
    return gone.select("plant_id", F.col("event_date").cast("string").alias("event_date"))
