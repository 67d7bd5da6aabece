"""Resends of any age, spells without readings, reconciliation of written tables, domains."""

from __future__ import annotations

from datetime import date

import pytest
from telemetry_support import at, final_plan

from millwatch import schemas
from millwatch.operators import gold, quality, reconciliation
from millwatch.operators.silver import silver_from_bronze
from millwatch.streaming import seen

DAY = 24 * 60


def land(spark, base, rows, checkpoint="checkpoint"):
    rows.write.mode("append").parquet(f"{base}/landing")
    landed = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    seen.stream_first_readings(landed, base, f"{base}/{checkpoint}").awaitTermination()


def test_resends_are_dropped_days_later_and_after_restarts(spark, bronze, tmp_path):
    base = str(tmp_path)
    first = bronze({"event_timestamp": at(1)}, {"event_timestamp": at(1)}, {"machine_id": None})
    land(spark, base, first)
    land(spark, base, bronze({"event_timestamp": at(5 * DAY)}, {"event_timestamp": at(1)}))
    land(spark, base, bronze({"event_timestamp": at(1)}, {"event_timestamp": at(2)}, {"machine_id": None}))
    land(spark, base, bronze({"machine_id": None}))  # nothing that could be told apart
    land(spark, base, bronze())
    rows = seen.first_readings(spark, base, first)
    named = rows.filter("machine_id IS NOT NULL").select("event_timestamp").collect()
    assert len(named) == 3 and len(set(named)) == 3
    assert rows.filter("machine_id IS NULL").count() == 3


def test_a_batch_run_again_finds_no_copies_of_itself(spark, bronze, tmp_path):
    base = str(tmp_path)
    rows = bronze({"event_timestamp": at(1)}, {"event_timestamp": at(2)})
    land(spark, base, rows)
    landed = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    seen.stream_first_readings(landed, base, f"{base}/anew").awaitTermination()
    assert seen.first_readings(spark, base, rows).count() == 2


def test_index_reads_only_the_days_of_a_batch(spark, bronze, tmp_path):
    base = str(tmp_path)
    land(spark, base, bronze(*({"event_timestamp": at(k * DAY)} for k in range(5))))
    found = seen.seen_before(spark, base, [date(2024, 3, 2)], 1)
    assert found.count() == 1
    filters = final_plan(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "day#" in filters and "batch#" in filters
    assert seen.seen_before(spark, base, [date(2024, 3, 2)], 0).count() == 0


def spells(df, *bounds):
    found = gold.silent_spells(df, *bounds).collect()
    return sorted((r.machine_id, str(r.silent_from), str(r.silent_to), r.silent_days) for r in found)


@pytest.fixture(scope="module")
def days(spark):
    rows = [("A", "P", d) for d in ("2024-03-02", "2024-03-05", "9999-12-30")] + [("B", "P", "2024-03-09"), ("B", "P", None)]
    text = spark.createDataFrame(rows, "machine_id STRING, plant_id STRING, event_date STRING")
    return text.selectExpr("machine_id", "plant_id", "CAST(event_date AS DATE) AS event_date")


def test_spells_are_bounded_by_each_machine(days):
    assert spells(days) == [
        ("A", "2024-03-03", "2024-03-04", 2),
        ("A", "2024-03-06", "9999-12-29", (date(9999, 12, 29) - date(2024, 3, 6)).days + 1),
    ]


def test_spells_within_given_days(days):
    assert spells(days, "2024-03-01", "2024-03-07") == [
        ("A", "2024-03-01", "2024-03-01", 1),
        ("A", "2024-03-03", "2024-03-04", 2),
        ("A", "2024-03-06", "2024-03-07", 2),
        ("B", "2024-03-01", "2024-03-07", 7),
    ]
    assert spells(days, "2024-03-10") == [
        ("A", "2024-03-10", "9999-12-29", (date(9999, 12, 29) - date(2024, 3, 10)).days + 1),
    ]
    assert spells(days.filter("false"), "2024-03-01", "2024-03-07") == []


def test_dates_of_spells(days):
    found = gold.silent_dates(gold.silent_spells(days, "2024-03-01", "2024-03-04")).collect()
    a = sorted(str(r.event_date) for r in found if r.machine_id == "A")
    assert a == ["2024-03-01", "2024-03-03", "2024-03-04"]


def test_losses_are_named(bronze):
    rows = bronze(
        {"event_timestamp": at(1)},
        {"event_timestamp": at(2)},
        {"event_timestamp": at(3), "temperature_celsius": 500.0},
        {"event_timestamp": at(DAY)},
        {"plant_id": None},
    )
    silver, bad = silver_from_bronze(rows), quality.quarantine_all(rows)
    assert reconciliation.unaccounted_days(rows, silver, bad).count() == 0
    assert reconciliation.unaccounted_rows(rows, silver, bad).count() == 0
    # a loss and a surplus on one day cancel in the counts only
    first = silver.filter(silver.event_timestamp == at(1))
    swapped = silver.filter(silver.event_timestamp != at(2)).unionByName(first)
    assert reconciliation.unaccounted_days(rows, swapped, bad).count() == 0
    found = reconciliation.unaccounted_rows(rows, swapped, bad).collect()
    assert sorted(r.surplus_left for r in found) == [-1, 1]
    lost = reconciliation.unaccounted_days(rows, silver, bad.filter("plant_id IS NOT NULL")).collect()
    assert [(r.plant_id, r.unaccounted_rows) for r in lost] == [(None, 1)]


def test_domains(spark):
    rows = [("RUNNING", "x"), ("running", "y"), (None, "x"), ("FAULT", "z")]
    df = spark.createDataFrame(rows, "operational_status STRING, other STRING")
    domains = schemas.TELEMETRY_DOMAINS | {"other": ("x",)}
    found = quality.check_domains(df, domains).select("rule", "value").collect()
    assert sorted(map(tuple, found)) == [("domain:operational_status", "running"), ("domain:other", "y"), ("domain:other", "z")]
    assert quality.check_domains(df.filter("false"), domains).count() == 0
