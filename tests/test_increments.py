"""Mergeable states of gold, incremental runs, fingerprints and sketches."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F
from telemetry_support import at, final_plan

from millwatch.operators import fingerprints, incremental, quality, sketches, states
from millwatch.operators.gold import gold_risk
from millwatch.plans import increments
from millwatch.sources import versions
from millwatch.streaming import silver as stream_silver

DAY = 60 * 24
LOADED = ("_ingested_at", "_silver_loaded_at")


def shown(gold):
    """Rows by key, doubles to nine digits."""

    def value(v):
        return float(f"{v:.9g}") if isinstance(v, float) and math.isfinite(v) else repr(v)

    columns = sorted(c for c in gold.columns if c != "_gold_loaded_at")
    return sorted([repr(value(row[c])) for c in columns] for row in gold.select(columns).collect())


@pytest.fixture
def mixed(silver):
    """Readings of three days with NULL statuses, pressures and equal temperatures."""
    rows = [
        {
            "machine_id": f"M{k % 3}",
            "plant_id": f"P{k % 2}",
            "event_timestamp": at((k % 3) * DAY + k),
            "temperature_celsius": 70.1 if k % 3 == 0 else 60.0 + k * 0.37,
            "pressure_bar": None if k % 6 < 3 else 1.0 + k / 7,
            "operational_status": None if k % 3 == 1 else ("FAULT" if k % 4 == 0 else "IDLE"),
            "error_code": "E1" if k % 5 == 0 else None,
        }
        for k in range(90)
    ]
    return silver(*rows)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_merged_states_equal_gold(spark, tmp_path, mixed, batches):
    table = f"{tmp_path}/states"
    for batch in range(batches):
        rows = mixed.filter(F.pmod(F.xxhash64("event_timestamp"), F.lit(batches)) == batch)
        increments.merge_readings(spark, rows, table, batch)
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(mixed))


def test_equal_temperatures_have_no_deviation(spark, tmp_path, silver):
    table = f"{tmp_path}/states"
    for batch in range(4):
        rows = [{"temperature_celsius": 70.1, "event_timestamp": at(batch * 10 + k)} for k in range(batch + 2)]
        increments.merge_readings(spark, silver(*rows), table, batch)
    row = increments.stored_gold(spark, table).first()
    assert row.total_readings_24h == 14 and row.temp_stddev_24h < 1e-12


def test_a_single_reading_and_unknown_values(spark, tmp_path, silver):
    rows = silver({"operational_status": None, "pressure_bar": None})
    increments.merge_readings(spark, rows, f"{tmp_path}/states", 0)
    assert shown(increments.stored_gold(spark, f"{tmp_path}/states")) == shown(gold_risk(rows))


def test_a_batch_counts_once(spark, tmp_path, mixed):
    table = f"{tmp_path}/states"
    assert increments.merge_readings(spark, mixed, table, 7) == 1
    assert increments.merge_readings(spark, mixed, table, 7) is None
    assert increments.merge_readings(spark, mixed, table, 3) is None
    assert versions.versions(spark, table) == [1]
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(mixed))
    # an empty batch is remembered too and changes nothing
    assert increments.merge_readings(spark, mixed.limit(0), table, 8) == 2
    assert versions.manifest(spark, table).batch == 8
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(mixed))


def test_an_empty_first_batch(spark, tmp_path, mixed):
    table = f"{tmp_path}/states"
    increments.merge_readings(spark, mixed.limit(0), table, 0)
    assert increments.stored_gold(spark, table).count() == 0
    increments.merge_readings(spark, mixed, table, 1)
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(mixed))


def test_only_touched_days_are_written(spark, tmp_path, mixed):
    table = f"{tmp_path}/states"
    increments.merge_readings(spark, mixed, table, 0)
    day = mixed.filter((F.col("event_date") == "2024-03-02") & (F.col("plant_id") == "P1"))
    increments.merge_readings(spark, day, table, 1)
    newest = versions.manifest(spark, table).parts[0]
    assert newest.partitions == ["plant_id=P1/event_date=2024-03-02"]


def test_withdrawn_readings_and_emptied_days(spark, tmp_path, mixed):
    table = f"{tmp_path}/states"
    increments.merge_readings(spark, mixed, table, 4)
    lost = (F.col("event_date") == "2024-03-02") | (F.col("temperature_celsius") > 85)
    remaining = mixed.filter(~lost)
    increments.withdraw_readings(spark, remaining, incremental.touched_days(mixed.filter(lost)), table)
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(remaining))
    assert versions.manifest(spark, table).batch == 4


def test_gold_of_states_needs_no_shuffle(spark, tmp_path, mixed):
    increments.merge_readings(spark, mixed, f"{tmp_path}/states", 0)
    assert "Exchange" not in final_plan(increments.stored_gold(spark, f"{tmp_path}/states"))


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    base = {"machine_id": "M1", "plant_id": "P1", "temperature_celsius": 99.0, "vibration_hz": 50.0}
    lines = [json.dumps(base | {"operational_status": "FAULT"} | row) for row in rows]
    (folder / name).write_text("\n".join([*lines, "{damaged"]))


def instant(day, minute):
    return {"event_timestamp": f"2024-03-{day:02d}T10:{minute:02d}:00Z"}


def test_a_refresh_takes_only_new_files(spark, tmp_path):
    landing, lake = tmp_path / "landing", f"{tmp_path}/lake"
    land(landing, "a.json", instant(1, 0), instant(2, 0), instant(2, 1) | {"vibration_hz": 900})
    first = increments.refresh(spark, str(landing), lake)
    assert sorted((r.event_date.day, r.total_readings_24h) for r in first.collect()) == [(1, 1), (2, 1)]
    assert increments.refresh(spark, str(landing), lake).count() == 2  # nothing landed
    land(landing, "b.json", instant(1, 5), instant(3, 0) | {"new_field": 1})
    rows = increments.refresh(spark, str(landing), lake).collect()
    assert sorted((r.event_date.day, r.total_readings_24h) for r in rows) == [(1, 2), (2, 1), (3, 1)]
    paths = increments.Increments(lake)
    assert spark.read.parquet(paths.silver).count() == 4
    assert spark.read.parquet(paths.quarantine).count() == 3  # one out of range, two damaged


def test_a_failed_batch_is_completed_once(spark, tmp_path, monkeypatch):
    """Silver is written, then the merge fails; after that the merge is done, then compaction fails."""
    landing, lake = tmp_path / "landing", f"{tmp_path}/lake"
    land(landing, "a.json", instant(1, 0), instant(1, 1))
    commit, compact = versions.commit, versions.compact

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "commit", broken)
    with pytest.raises(Exception, match="lost"):
        increments.refresh(spark, str(landing), lake)
    monkeypatch.setattr(versions, "commit", commit)
    monkeypatch.setattr(versions, "compact", broken)
    with pytest.raises(Exception, match="lost"):
        increments.refresh(spark, str(landing), lake)
    monkeypatch.setattr(versions, "compact", compact)
    gold = increments.refresh(spark, str(landing), lake)
    assert [r.total_readings_24h for r in gold.collect()] == [2]
    assert spark.read.parquet(increments.Increments(lake).silver).count() == 2


def test_folders_stay_bounded(spark, tmp_path, mixed):
    table = f"{tmp_path}/states"
    for batch in range(6):
        rows = mixed.filter(F.dayofmonth("event_date") == 1 + batch % 3)
        increments.merge_readings(spark, rows, table, batch)
        versions.compact(spark, table, 2)
    found = versions.manifest(spark, table)
    assert len(found.parts) <= 2 and found.batch == 5
    assert shown(increments.stored_gold(spark, table)) == shown(gold_risk(mixed.unionByName(mixed)))


# Fingerprints


def differences(left, right, by=("plant_id", "event_date"), **options):
    found = fingerprints.row_differences(left, right, list(by), **options)
    expected = quality.frame_differences(left, right)
    columns = sorted(found.columns)
    rows = [sorted(map(repr, df.select(columns).collect())) for df in (found, expected)]
    assert rows[0] == rows[1]
    return rows[0]


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_drilldown_finds_the_rows_that_differ(mixed, buckets):
    rows = mixed.drop(*LOADED)
    changed = rows.withColumn("error_code", F.when(F.col("temperature_celsius") > 90, "E9").otherwise(F.col("error_code")))
    assert differences(rows, changed, buckets=buckets)
    assert differences(rows, rows.filter("plant_id = 'P1'"), buckets=buckets)
    assert differences(rows.unionByName(rows.limit(3)), rows, buckets=buckets)
    assert differences(rows, rows.repartition(5), buckets=buckets) == []
    assert differences(rows.limit(0), rows.limit(0), buckets=buckets) == []


def test_null_parts_and_swapped_nulls(spark):
    layout = "part string, a string, b string"
    left = spark.createDataFrame([(None, "x", None), ("", None, "y"), ("p", None, None)], layout)
    right = spark.createDataFrame([(None, None, "x"), ("", "y", None), ("p", None, None)], layout)
    assert len(differences(left, right, by=["part"])) == 4
    assert differences(left, left, by=["part"]) == []


def test_fingerprints_count_copies_and_add_up(spark, mixed):
    rows = mixed.drop(*LOADED)
    twice = fingerprints.fingerprints(rows.unionByName(rows), []).first()
    once = fingerprints.fingerprints(rows, []).first()
    assert [2 * v for v in once] == list(twice)
    parts = fingerprints.fingerprints(rows, ["plant_id"], rows.columns)
    assert list(parts.agg(*[F.sum(c) for c in once.asDict()]).first()) == list(once)


def test_equal_tables_shuffle_no_rows(spark, mixed):
    """Partial sums come before every exchange of the fingerprints."""
    rows = mixed.drop(*LOADED)
    prints = [fingerprints.fingerprints(df, ["plant_id"]) for df in (rows, rows.repartition(3))]
    plan = fingerprints.differing_parts(*prints, ["plant_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 3
    found = final_plan(prints[0])
    assert found.index("partial_sum") > found.index("Exchange") and found.count("Exchange") == 1


# Sketches


def test_sketches_unite_over_days(spark, silver):
    rows = [
        {"machine_id": f"M{k}", "plant_id": f"P{k % 2}", "event_timestamp": at((k % 4) * DAY)} for k in range(400)
    ]
    daily = sketches.machine_sketches(silver(*rows, *rows[:100]))
    assert daily.count() == 4
    seen = {r.plant_id: r.machines_seen for r in sketches.united(daily, ["plant_id"]).collect()}
    bound = 4 * sketches.STANDARD_ERROR * 200
    assert all(abs(seen[p] - 200) <= bound for p in ("P0", "P1"))
    assert abs(sketches.united(daily, []).first().machines_seen - 400) <= 2 * bound


def test_agreement_is_false_for_missing_or_far_counts(spark):
    rows = [(100, 100), (100, 103), (100, 140), (None, 3), (3, None)]
    frame = spark.createDataFrame(rows, "estimate long, exact long")
    assert [r[0] for r in frame.select(sketches.agrees("estimate", "exact")).collect()] == [True, True, False, False, False]


def test_silver_stream_calls_back_with_valid_rows(spark, tmp_path, bronze):
    bronze({}, {"vibration_hz": 900.0}).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(bronze({}).schema).parquet(f"{tmp_path}/in")
    seen = []
    places = [f"{tmp_path}/{name}" for name in ("silver", "quarantine", "checkpoint")]
    stream_silver.stream_silver(stream, *places, then=lambda rows, n: seen.append((n, rows.count()))).awaitTermination()
    assert seen == [(0, 1)]
