from __future__ import annotations

import math

import pytest
from telemetry_support import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millwatch.operators import quality
from millwatch.operators.silver import silver_from_bronze


@pytest.mark.parametrize(
    ("change", "accepted"),
    [
        ({"temperature_celsius": 0.0}, False),
        ({"temperature_celsius": 200.0}, False),
        ({"temperature_celsius": 0.01}, True),
        ({"temperature_celsius": 199.99}, True),
        ({"temperature_celsius": None}, False),
        ({"temperature_celsius": math.nan}, False),
        ({"vibration_hz": 0.0}, False),
        ({"vibration_hz": 500.0}, False),
        ({"vibration_hz": -1.0}, False),
        ({"vibration_hz": math.nan}, False),
        ({"machine_id": None}, False),
        ({"plant_id": None}, False),
        ({"event_timestamp": None}, False),
        ({"pressure_bar": None}, True),
        ({"pressure_bar": -5.0}, True),
    ],
)
def test_gate_edges(bronze, change, accepted):
    valid, rejected = quality.split_valid(bronze(change))
    assert (valid.count(), rejected.count()) == ((1, 0) if accepted else (0, 1))


def test_every_broken_rule_is_named(bronze):
    rows = quality.with_reject_reasons(
        bronze(
            {"machine_id": None, "temperature_celsius": None, "vibration_hz": 500.0},
            {"plant_id": None, "event_timestamp": None},
            {"temperature_celsius": math.nan},
        )
    ).collect()
    assert sorted(r.reject_reasons for r in rows) == [
        ["machine_id_missing", "temperature_missing", "vibration_out_of_range"],
        ["plant_id_missing", "timestamp_missing"],
        ["temperature_out_of_range"],
    ]


def test_identical_bad_rows(bronze):
    rows = bronze({"machine_id": None}, {"machine_id": None}, {})
    assert quality.quarantine_distinct(rows).count() == 1
    assert quality.quarantine_all(rows).count() == 2
    counted = quality.quarantine_count(rows).first()
    assert (counted.rejected_rows, counted.rejected_distinct) == (2, 1)


def test_counts_of_an_empty_quarantine(bronze):
    counted = quality.quarantine_count(bronze({})).first()
    assert (counted.rejected_rows, counted.rejected_distinct) == (0, 0)


@pytest.mark.parametrize(
    ("temperature", "vibration", "status", "flags"),
    [
        (95.0, 80.0, "RUNNING", (False, False, False)),
        (95.01, 80.01, "FAULT", (True, True, True)),
        (70.0, 50.0, None, (False, False, None)),
    ],
)
def test_flags(silver, temperature, vibration, status, flags):
    row = silver(
        {
            "temperature_celsius": temperature,
            "vibration_hz": vibration,
            "operational_status": status,
            "event_timestamp": at(60 * 13 + 59),
        }
    ).first()
    assert (row.is_overheating, row.is_vibration_anomaly, row.is_fault_event) == flags
    assert row.event_hour == 13


measurement = st.one_of(
    st.none(), st.sampled_from([0.0, 80.0, 95.0, 200.0, 500.0, math.nan]), st.floats(-10, 600)
)
readings = st.lists(
    st.fixed_dictionaries(
        {
            "machine_id": st.sampled_from(["MCH_0001", "MCH_0002", None]),
            "plant_id": st.sampled_from(["P1", None]),
            "event_timestamp": st.one_of(st.none(), st.integers(0, 5000).map(at)),
            "temperature_celsius": measurement,
            "vibration_hz": measurement,
            "operational_status": st.sampled_from(["RUNNING", "FAULT", None]),
        }
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings)
def test_gate_splits_without_loss(bronze, rows):
    frame = bronze(*rows)
    valid, rejected = quality.split_valid(frame)
    assert quality.frame_differences(valid.unionByName(rejected), frame).isEmpty()
    subtracted = frame.subtract(valid)
    assert quality.frame_differences(quality.quarantine_distinct(frame), subtracted).isEmpty()
    accounts = quality.reconcile(frame, silver_from_bronze(frame), rejected)
    assert accounts.filter(F.col("unaccounted_rows") != 0).isEmpty()


def test_checks(spark):
    parents = spark.createDataFrame([("a",), ("b",)], "k STRING")
    children = spark.createDataFrame(
        [("a", 1), ("a", 1), ("x", 2), (None, 3), ("x", 4)], "k STRING, n INT"
    )
    assert sorted(r.n for r in quality.orphans(children, parents, "k").collect()) == [2, 4]
    duplicated = quality.check_unique(children, ["k", "n"]).collect()
    assert [tuple(r) for r in duplicated] == [("a", 1, 2)]
    assert [r.rule for r in quality.check_not_null(children, ["k", "n"]).collect()] == ["not_null:k"]
    violations = quality.domain_violations(children, "k", ["a", "b"])
    assert {r.k for r in violations.collect()} == {"x"}
    stored = quality.as_failures(violations, "known_key").collect()
    assert {(r.rule, r.record) for r in stored} == {
        ("known_key", '{"k":"x","n":2}'),
        ("known_key", '{"k":"x","n":4}'),
    }


def test_reconcile_finds_a_lost_row(bronze):
    frame = bronze({}, {"event_timestamp": at(60 * 24)}, {"plant_id": None})
    valid, rejected = quality.split_valid(frame)
    lost = quality.reconcile(frame, valid.limit(1), rejected)
    assert lost.agg(F.sum("unaccounted_rows")).first()[0] == 1


def test_differences_count_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "n INT")
    right = spark.createDataFrame([(1,), (2,), (3,)], "n INT")
    rows = quality.frame_differences(left, right).collect()
    assert {(r.n, r.surplus_left) for r in rows} == {(1, 1), (3, -1)}


def test_reject_filter_is_pushed_and_finds_nan(spark, bronze, tmp_path):
    from millwatch.operators import quality

    rows = bronze({}, {"vibration_hz": float("nan")}, {"temperature_celsius": None}, {"vibration_hz": 1e9})
    rows.write.parquet(str(tmp_path / "b"))
    rejected = quality.quarantine_all(spark.read.parquet(str(tmp_path / "b")))
    assert rejected.count() == 3
    plan = rejected._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(" in plan
