"""Plans that must hold at scale, whatever the data."""

from __future__ import annotations

import re

import pytest
from telemetry_support import at, final_plan

from millwatch.operators import gold, incremental, quality, reference, serving
from millwatch.plans.queries import QUERIES
from millwatch.sources import sample_tables as sample
from millwatch.sources import sinks
from millwatch.sources.tables import read_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    silver = sample.silver(spark, SF)
    sinks.write_table(sample.bronze(spark, SF), str(folder / "bronze"))
    sinks.write_partitioned(silver, str(folder / "silver"))
    sinks.write_partitioned(gold.gold_risk(silver), str(folder / "gold"))
    return {
        "bronze": read_path(spark, str(folder / "bronze")),
        "silver": read_path(spark, str(folder / "silver"), schema=silver.schema),
        "gold": read_path(spark, str(folder / "gold")),
    }


def test_partition_filters_prune(stored):
    plan = final_plan(
        stored["silver"].filter("plant_id = 'PLANT_DE_02' AND event_date = DATE '2024-01-03'")
    )
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    assert "plant_id" in filters and "event_date" in filters


def test_gate_is_pushed_and_shuffles_nothing(stored):
    valid, rejected = quality.split_valid(stored["bronze"])
    for side in (valid, rejected):
        assert "Exchange" not in final_plan(side)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", final_plan(valid)).group(1)
    assert "GreaterThan(temperature_celsius,0.0)" in pushed and "LessThan(vibration_hz,500.0)" in pushed


def test_gold_shuffles_partial_aggregates_once(stored):
    plan = final_plan(gold.gold_risk(stored["silver"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan and "SortAggregate" not in plan


def test_compact_gold_reads_fewer_columns(stored):
    schema = re.search(r"ReadSchema: (.*)", final_plan(gold.compact(gold.gold_risk(stored["silver"])))).group(1)
    assert "pressure_bar" not in schema and "rpm" not in schema and "error_code" not in schema


def test_leaderboard_keeps_k_rows_per_task(stored):
    plan = final_plan(serving.leaderboard(stored["gold"]))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_incremental_refresh_prunes_untouched_days(spark, stored):
    touched = incremental.touched_days(stored["silver"].filter("event_date = DATE '2024-01-05'"))
    plan = final_plan(incremental.recomputed_gold(stored["silver"], touched))
    assert "dynamicpruning" in plan


def test_no_operator_forces_a_broadcast(stored, spark):
    """With broadcasting turned off by its size limit, no broadcast is left."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        joined = reference.enrich_machines(stored["silver"], sample.machines(spark, SF))
        assert "Broadcast" not in final_plan(joined)
        for name in ("rank_in_plant", "rolling_24h", "scd2_machines", "fk_orphans", "publish_batches",
                     "missing_days", "snapshot_history", "inventory_value", "baseline_deviation"):
            assert "Broadcast" not in final_plan(QUERIES[name](spark, SF)), name
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize(
    "name", ["rank_in_plant", "rolling_24h", "scd2_machines", "publish_batches", "sliding_24h",
             "fault_sessions", "machine_enrich", "missing_days", "reconcile"]
)
def test_no_cross_join_and_no_python(spark, name):
    plan = final_plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def test_hot_machine_is_spread(spark, silver):
    """One machine with most readings: every ordered group is a short cell."""
    from millwatch.operators import trailing

    rows = silver(*[{"event_timestamp": at(m), "machine_id": "HOT"} for m in range(0, 3000, 3)])
    plan = final_plan(trailing.trailing_risk(rows))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line and "Reused" not in line:
            keys = re.search(r"hashpartitioning\((.*?), \d+\)", line).group(1)
            assert re.search(r"event_timestamp|cell|__group|\bat\b", keys), keys


@pytest.mark.parametrize("flag", ["true", "false"])
def test_chained_changes_join_without_broadcasts(spark, flag):
    """Tables after changes can be joined and grouped again, however Spark sees unions."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.unionOutputPartitioning": flag}
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        for name in ("apply_changes", "snapshot_history", "scd2_machines"):
            changed = QUERIES[name](spark, SF)
            keys = changed.groupBy("machine_id").count()
            assert changed.join(keys, "machine_id").count() == changed.count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_emptied_days_read_touched_partitions_only(spark, tmp_path):
    days = "concat('P', id % 4) AS plant_id", "date_add(date'2024-01-01', cast(id % 20 AS int)) AS event_date"
    spark.range(80).selectExpr(*days, "id").write.partitionBy("plant_id", "event_date").parquet(f"{tmp_path}/silver")
    named = spark.sql("SELECT explode(array('P1', 'P9')) AS plant_id, date'2024-01-02' AS event_date")
    named.write.parquet(f"{tmp_path}/touched")
    touched = spark.read.parquet(f"{tmp_path}/touched").filter("plant_id > 'P0'")
    gone = incremental.vanished_days(touched, spark.read.parquet(f"{tmp_path}/silver"))
    assert "dynamicpruning" in gone._jdf.queryExecution().toString()
    assert [tuple(r) for r in gone.collect()] == [("P9", "2024-01-02")]
