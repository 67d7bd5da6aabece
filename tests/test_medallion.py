from __future__ import annotations

import json

import pytest
from telemetry_support import at

from millwatch.operators import incremental, quality
from millwatch.operators.gold import gold_risk
from millwatch.plans import medallion
from millwatch.sources import sinks

DAY = 60 * 24


def landed(tmp_path, *rows: dict) -> str:
    base = {
        "machine_id": "M1",
        "plant_id": "P1",
        "event_timestamp": "2024-03-01T10:00:00Z",
        "temperature_celsius": 99.0,
        "vibration_hz": 50.0,
        "operational_status": "FAULT",
    }
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / "a.json").write_text("\n".join(json.dumps(base | row) for row in rows))
    return str(folder)


@pytest.mark.parametrize("by_name", [False, True])
def test_all_stages(spark, tmp_path, by_name):
    names = "bronze", "silver", "quarantine", "gold"
    lake = medallion.Lake(*[f"lake_{n}" if by_name else str(tmp_path / n) for n in names])
    landing = landed(
        tmp_path, {}, {"machine_id": "M2", "operational_status": "IDLE"}, {"vibration_hz": 900}, {"vibration_hz": 900}
    )
    for _ in range(2):
        board = medallion.run(spark, landing, lake, run_id="r1").collect()
    assert [(r.machine_id, r.risk_score) for r in board] == [("M1", 0.7), ("M2", 0.3)]
    counts = [sinks.written_count(spark, t) for t in (lake.bronze, lake.silver, lake.quarantine, lake.gold)]
    assert counts == [4, 2, 2, 2]
    medallion.load_silver(spark, lake, "r1", keep_duplicates=False)
    assert sinks.written_count(spark, lake.quarantine) == 1
    silver = sinks.read_target(spark, lake.silver)
    assert "_source_file" not in silver.columns and "_source_file" in sinks.read_target(spark, lake.bronze).columns


def test_empty_landing_is_refused(spark, tmp_path):
    lake = medallion.Lake(*[str(tmp_path / n) for n in "bsqg"])
    with pytest.raises(ValueError, match="no rows"):
        medallion.load_bronze(spark, landed(tmp_path), lake)


def test_refresh_equals_rebuild_and_drops_emptied_days(spark, silver):
    def rows(*extra):
        return silver({}, {"event_timestamp": at(DAY)}, {"plant_id": "P2", "event_timestamp": at(DAY)}, *extra)

    before = rows({"event_timestamp": at(2 * DAY)})
    sinks.write_partitioned(gold_risk(before), "gold_refresh")
    after = rows({"event_timestamp": at(DAY + 5), "temperature_celsius": 150.0})
    touched = spark.sql(
        "SELECT 'PLANT_MX_01' AS plant_id, explode(array(DATE '2024-03-02', DATE '2024-03-03')) AS event_date"
    )
    compared = [c for c in gold_risk(after).columns if c != "_gold_loaded_at"]
    pure = incremental.refreshed_gold(gold_risk(before), after, touched).select(*compared)
    rebuilt = gold_risk(after).select(*compared)
    assert quality.frame_differences(pure, rebuilt).isEmpty()
    refreshed = medallion.refresh_gold(spark, after, touched, "gold_refresh").select(*compared)
    differing = quality.frame_differences(refreshed, rebuilt)
    assert differing.select("machine_id", "plant_id", "event_date", "surplus_left").collect() == []
    gone = incremental.vanished_days(touched, incremental.recomputed_gold(after, touched)).collect()
    assert [tuple(r) for r in gone] == [("PLANT_MX_01", "2024-03-03")]


def test_refresh_of_a_path(spark, silver, tmp_path):
    target = str(tmp_path / "gold")
    before = silver({}, {"event_timestamp": at(DAY)})
    sinks.write_partitioned(gold_risk(before), target, rebalance=False)
    after = silver({}, {"event_timestamp": at(DAY)}, {"event_timestamp": at(DAY + 1)})
    touched = incremental.touched_days(silver({"event_timestamp": at(DAY)}))
    days = medallion.refresh_gold(spark, after, touched, target).orderBy("event_date").collect()
    assert [r.total_readings_24h for r in days] == [1, 2]
    with pytest.raises(ValueError, match="without readings"):
        medallion.refresh_gold(spark, silver({}), touched, target)
    assert sinks.written_count(spark, target) == 2


def test_command_line_and_dashboard_sql(spark, tmp_path, capsys, monkeypatch):
    from millwatch import __main__ as command

    monkeypatch.setattr(command, "build_session", lambda: spark)
    landing = landed(tmp_path, {}, {"machine_id": "M2", "operational_status": "IDLE", "temperature_celsius": 20})
    command.main(["all", "--landing", landing, "--run-id", "r1"])
    assert "M1" in capsys.readouterr().out
    summary = spark.sql(
        "SELECT plant_id, count(DISTINCT machine_id) AS machines, round(avg(risk_score), 4) AS risk, "
        "sum(fault_event_count_24h) AS faults FROM gold_supply_risk GROUP BY plant_id"
    )
    assert [tuple(r) for r in summary.collect()] == [("P1", 2, 0.35, 1)]
    counters = spark.sql(
        "SELECT count_if(risk_score > 0.30) AS high, max(risk_score) AS peak FROM gold_supply_risk"
    )
    assert tuple(counters.first()) == (1, 0.7)
    folder = str(tmp_path / "lake")
    for stage in ("bronze", "silver", "gold"):
        command.main([stage, "--landing", landing, "--run-id", "r1", "--lake", folder])
    assert sinks.written_count(spark, f"{folder}/gold_supply_risk") == 2
    with pytest.raises(SystemExit):
        command.main(["bronze"])
