from __future__ import annotations

import json
from decimal import Decimal

import pytest
from telemetry_support import at
from pyspark.sql import functions as F

from millwatch.config import DeliveryPolicy
from millwatch.operators import delivery, reference

ERROR = "ProvisionedThroughputExceededException"
OUTCOMES = "record_id BIGINT, attempt INT, error_code STRING"


def test_partial_failure_then_success(spark):
    outcomes = spark.createDataFrame([(1, 1, None), (2, 1, ERROR), (2, 2, None)], OUTCOMES)
    ledger = delivery.delivery_ledger(outcomes, DeliveryPolicy(max_retries=2)).first()
    assert (ledger.sent, ledger.errors, ledger.pending, ledger.attempts) == (2, 0, 0, 3)


def test_records_fail_for_good_after_the_last_retry(spark):
    rows = [(1, a, ERROR) for a in range(1, 6)] + [(2, a, ERROR) for a in range(1, 5)]
    outcomes = spark.createDataFrame(rows, OUTCOMES)
    ledger = delivery.delivery_ledger(outcomes).first()
    assert (ledger.sent, ledger.errors, ledger.pending) == (0, 1, 1)
    pending = delivery.pending_retries(outcomes).first()
    assert (pending.record_id, pending.attempts, pending.last_error) == (2, 4, ERROR)
    assert pending.backoff_seconds == pytest.approx(1.6)


def test_ledger_of_nothing(spark):
    assert tuple(delivery.delivery_ledger(spark.createDataFrame([], OUTCOMES)).first()) == (0, 0, 0, 0)


def test_every_row_gets_a_bounded_batch(spark):
    rows = spark.range(0, 6005, 5).withColumnRenamed("id", "event_id").repartition(5)
    batches = delivery.assign_batches(rows, "event_id", positions_per_cell=700)
    sizes = {r.batch_id: r["count"] for r in batches.groupBy("batch_id").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 201}
    wrong = batches.filter(F.col("event_id") != 5 * (500 * F.col("batch_id") + F.col("batch_position")))
    assert wrong.isEmpty()


def test_key_and_payload(bronze):
    row = delivery.to_key_value(bronze({"event_timestamp": at(1)}).drop("_ingested_at")).first()
    payload = json.loads(row.value)
    assert row.key == payload["machine_id"] == "MCH_0001"
    assert payload["event_timestamp"] == "2024-03-01T00:01:00.000000Z" and payload["error_code"] is None


@pytest.fixture
def machines(spark):
    return spark.createDataFrame(
        [("MCH_0001", "PLANT_DE_02", "ROBOT", 60.0, 0.0, True)],
        "machine_id STRING, plant_id STRING, machine_type STRING, baseline_temp_c DOUBLE, "
        "baseline_vibration_hz DOUBLE, is_active BOOLEAN",
    )


def test_enrichment_keeps_unknown_machines(silver, machines):
    rows = reference.enrich_machines(silver({}, {"machine_id": "M9"}), machines).collect()
    got = {r.machine_id: (r.plant_id, r.registered_plant_id, r.machine_type) for r in rows}
    assert got == {
        "MCH_0001": ("PLANT_MX_01", "PLANT_DE_02", "ROBOT"),
        "M9": ("PLANT_MX_01", None, None),
    }


def test_baseline_of_zero_has_no_deviation(silver, machines):
    row = reference.baseline_deviation(silver({"temperature_celsius": 90.0}), machines).first()
    assert row.temp_deviation == 0.5 and row.vibration_deviation is None


def test_inventory(spark):
    levels = spark.createDataFrame(
        [("a", "S1", 10, 100, 50), ("b", "S1", 50, 100, 50), ("c", "S2", 100, 100, 50), ("d", "S2", 30, 20, 40)],
        "part_id STRING, supplier_id STRING, stock_level INT, reorder_point INT, safety_stock INT",
    )
    alerts = {r.part_id: (r.severity, r.shortfall) for r in reference.reorder_alerts(levels).collect()}
    assert alerts == {"a": ("CRITICAL", 90), "b": ("REORDER", 50), "d": ("CRITICAL", 10)}
    costs = spark.sql("SELECT 'S1' AS supplier_id, 's' AS supplier_name, CAST(0.1 AS DECIMAL(10,2)) AS unit_cost")
    values = {r.part_id: r.stock_value for r in reference.inventory_value(levels, costs).collect()}
    assert values == {"a": Decimal("1.00"), "b": Decimal("5.00")}


def test_canonical_names(machines):
    assert reference.to_canonical(machines, reference.CANONICAL["site"]).columns == [
        "site_id", "asset_id", "asset_type", "is_active",
    ]
