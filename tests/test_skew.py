"""A hot key is split over tasks. Small size limits stand in for large data."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from telemetry_support import final_plan
from pyspark.sql import functions as F

from millwatch.operators import quality, reference, trailing

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot(spark):
    """Half of all readings come from one machine, all of them at one instant."""
    is_hot = F.col("id") % 2 == 0
    start = F.lit("2024-03-01 00:00:00").cast("timestamp")
    moment = start + F.when(is_hot, 0).otherwise(F.col("id")).cast("interval second")
    return spark.range(0, 200_000, 1, 8).select(
        F.when(is_hot, "HOT").otherwise(F.concat(F.lit("M"), F.col("id") % 997)).alias("machine_id"),
        F.lit("P1").alias("plant_id"),
        moment.alias("event_timestamp"),
        F.lit(70.0).alias("temperature_celsius"),
        F.lit(50.0).alias("vibration_hz"),
        F.lit(False).alias("is_fault_event"),
        F.lit(False).alias("is_overheating"),
        F.lit(False).alias("is_vibration_anomaly"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


@pytest.fixture(scope="module")
def machines(spark):
    return spark.range(0, 997).select(
        F.concat(F.lit("M"), "id").alias("machine_id"),
        F.lit("P1").alias("plant_id"),
        F.lit("ROBOT").alias("machine_type"),
        F.lit(60.0).alias("baseline_temp_c"),
        F.lit(50.0).alias("baseline_vibration_hz"),
        F.lit(True).alias("is_active"),
    )


def test_readings_of_a_hot_instant(spark, hot):
    with settings(spark, SMALL):
        joined = trailing.with_trailing_risk(hot, trailing.trailing_risk(hot))
        plan = final_plan(joined.select("machine_id", "payload", "total_readings_trailing"))
        assert "SortMergeJoin(skew=true)" in plan
        hot_rows = joined.filter("machine_id = 'HOT'").agg(
            F.count(F.lit(1)), F.max("total_readings_trailing")
        )
        assert tuple(hot_rows.first()) == (100_000, 100_000)


def test_a_hot_machine_in_an_enrichment(spark, hot, machines):
    with settings(spark, SMALL):
        enriched = reference.enrich_machines(hot, machines)
        assert "SortMergeJoin(skew=true)" in final_plan(enriched)
        assert enriched.count() == 200_000


def test_a_hot_orphan(spark, hot, machines):
    with settings(spark, SMALL):
        found = quality.orphans(hot, machines, "machine_id")
        assert "SortMergeJoin(skew=true)" in final_plan(found)
        assert found.count() == 100_000


def test_copies_collapse_before_the_shuffle(spark, hot):
    """Every aggregate of a hot key has a map-side half."""
    plan = final_plan(trailing.trailing_risk(hot))
    exchange = plan.index("Exchange hashpartitioning(machine_id")
    assert "partial_count" in plan[exchange:]
