"""Builders of small telemetry rows and a view of final plans, for the tests of the core."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

START = datetime(2024, 3, 1, tzinfo=UTC)

BRONZE_LAYOUT = """
    machine_id STRING, plant_id STRING, event_timestamp TIMESTAMP, temperature_celsius DOUBLE,
    vibration_hz DOUBLE, pressure_bar DOUBLE, operational_status STRING, error_code STRING
"""


def at(minutes: float = 0, **parts) -> datetime:
    return START + timedelta(minutes=minutes, **parts)


def reading(**changes) -> tuple:
    row = {
        "machine_id": "MCH_0001",
        "plant_id": "PLANT_MX_01",
        "event_timestamp": at(),
        "temperature_celsius": 70.0,
        "vibration_hz": 50.0,
        "pressure_bar": 3.0,
        "operational_status": "RUNNING",
        "error_code": None,
    } | changes
    return tuple(row.values())


def final_plan(df) -> str:
    """The physical plan after adaptive execution has finished."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
