from __future__ import annotations

import random
from datetime import timedelta

import pytest
from telemetry_support import at, final_plan
from pyspark.sql import functions as F

from millwatch.operators import sessions, trailing


def random_readings(seed: int, n: int, minutes: int) -> list[dict]:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append(
            {
                # half of all readings come from one machine
                "machine_id": rng.choice(["HOT", "HOT", "M2", "M3"]),
                # whole minutes make ties and exact window edges frequent
                "event_timestamp": at(rng.randrange(minutes)),
                "temperature_celsius": float(rng.randrange(60, 130)),
                "vibration_hz": float(rng.randrange(40, 120)),
                "operational_status": rng.choice(["FAULT", "RUNNING", None]),
            }
        )
    return rows


def by_hand(rows: list[dict], machine: str, since, until) -> dict:
    inside = [
        r for r in rows if r["machine_id"] == machine and since <= r["event_timestamp"] <= until
    ]
    known = [r for r in inside if r["operational_status"] is not None]
    faults = sum(r["operational_status"] == "FAULT" for r in known) if known else None
    hot = sum(r["temperature_celsius"] > 95 for r in inside)
    shaky = sum(r["vibration_hz"] > 80 for r in inside)
    n = len(inside)
    return {
        "total_readings": n,
        "fault_event_count": faults,
        "overheat_count": hot,
        "vibration_anomaly_count": shaky,
        "avg_temp": sum(r["temperature_celsius"] for r in inside) / n,
        "max_temp": max(r["temperature_celsius"] for r in inside),
        "avg_vibration": sum(r["vibration_hz"] for r in inside) / n,
        "max_vibration": max(r["vibration_hz"] for r in inside),
        "risk_score": 1.0 if faults is None else min(1.0, (faults * 0.4 + hot * 0.3 + shaky * 0.3) / n),
    }


def assert_measures(row, suffix: str, expected: dict) -> None:
    actual = {name: row[f"{name}_{suffix}"] for name in expected}
    assert actual == pytest.approx(expected)


@pytest.mark.parametrize(("hours", "cell"), [(24, 1), (24, 60), (2, 1), (3, 90)])
def test_trailing_matches_brute_force(spark, silver, hours, cell):
    rows = random_readings(seed=hours * 100 + cell, n=250, minutes=60 * 24 * 4)
    result = trailing.trailing_risk(silver(*rows), hours=hours, cell_minutes=cell).collect()
    assert len(result) == len({(r["machine_id"], r["event_timestamp"]) for r in rows})
    for row in result:
        moment = row.event_timestamp.astimezone(at().tzinfo)
        expected = by_hand(rows, row.machine_id, moment - timedelta(hours=hours), moment)
        assert_measures(row, "trailing", expected)


def test_trailing_edges_are_inclusive(silver):
    rows = silver(
        {"event_timestamp": at(0)},
        {"event_timestamp": at(24 * 60)},
        {"event_timestamp": at(24 * 60, microseconds=1)},
    )
    counts = [
        r.total_readings_trailing
        for r in trailing.trailing_risk(rows).orderBy("event_timestamp").collect()
    ]
    assert counts == [1, 2, 2]


def test_readings_of_one_instant_share_the_answer(silver):
    rows = silver(*[{"event_timestamp": at(3)}] * 40, {"event_timestamp": at(4)})
    instants = trailing.trailing_risk(rows)
    assert instants.count() == 2
    joined = trailing.with_trailing_risk(rows, instants)
    assert joined.count() == 41
    assert {r.total_readings_trailing for r in joined.collect()} == {40, 41}


def test_cells_must_fill_the_window(silver):
    with pytest.raises(ValueError, match="whole number"):
        trailing.trailing_risk(silver({}), hours=1, cell_minutes=7)


def test_trailing_scans_once_and_windows_small_groups(silver):
    rows = silver(*random_readings(7, 50, 5000))
    plan = final_plan(trailing.trailing_risk(rows))
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and all("__group" in line for line in windows)
    assert plan.count("ReusedExchange") >= 1


@pytest.mark.parametrize(("hours", "step"), [(24, 1), (6, 3)])
def test_sliding_matches_brute_force(silver, hours, step):
    rows = random_readings(seed=step, n=80, minutes=60 * 24 * 2)
    result = trailing.sliding_risk(silver(*rows), hours=hours, step_hours=step).collect()
    for row in result:
        start = row.window_start.astimezone(at().tzinfo)
        end = start + timedelta(hours=hours) - timedelta(microseconds=1)
        assert_measures(row, "sliding", by_hand(rows, row.machine_id, start, end))
    per_reading = hours // step
    windows = {
        (r["machine_id"], at(0) + timedelta(hours=step * (int((r["event_timestamp"] - at(0)).total_seconds()) // (3600 * step) - back)))
        for r in rows
        for back in range(per_reading)
    }
    assert len(result) == len(windows)


def test_fault_sessions_match_brute_force(silver):
    rows = random_readings(seed=11, n=300, minutes=60 * 24 * 2)
    found = {
        (r.machine_id, r.session_start.astimezone(at().tzinfo)): (r.faults, r.max_temp)
        for r in sessions.fault_sessions(silver(*rows)).collect()
    }
    expected = {}
    for machine in ("HOT", "M2", "M3"):
        faults = sorted(
            (r for r in rows if r["machine_id"] == machine and r["operational_status"] == "FAULT"),
            key=lambda r: r["event_timestamp"],
        )
        start = last = None
        for r in faults:
            moment = r["event_timestamp"]
            if last is None or moment - last >= timedelta(minutes=30):
                start = moment
            n, peak = expected.get((machine, start), (0, 0.0))
            expected[machine, start] = n + 1, max(peak, r["temperature_celsius"])
            last = moment
    assert found == expected


def test_a_gap_of_exactly_the_limit_parts_sessions(silver):
    fault = {"operational_status": "FAULT"}
    rows = silver(
        {"event_timestamp": at(0), **fault},
        {"event_timestamp": at(30), **fault},
        {"event_timestamp": at(59.99), **fault},
    )
    assert sorted(r.faults for r in sessions.fault_sessions(rows).collect()) == [1, 2]


def test_batch_sessions_equal_spark_session_windows(silver):
    rows = silver(*random_readings(seed=5, n=300, minutes=60 * 30))
    ours = sessions.fault_sessions(rows).select("machine_id", "session_start", "session_end", "faults")
    window = F.session_window("event_timestamp", "30 minutes").alias("s")
    theirs = (
        rows.filter("is_fault_event")
        .groupBy("machine_id", window)
        .count()
        .select("machine_id", "s.start", "s.end", "count")
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
