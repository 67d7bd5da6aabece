"""Gate rules, flags, risk score and the daily measures as expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwatch.config import LIMITS, WEIGHTS, RiskWeights, SensorLimits


def strictly_between(name: str, low: float, high: float) -> Column:
    value = F.col(name)
    return (value > F.lit(low)) & (value < F.lit(high))


def gate_rules(limits: SensorLimits = LIMITS) -> dict[str, Column]:
    """What a good reading satisfies, keyed by the reason given when it does not.

    NaN compares above every number, so the upper bounds reject it.
    """
    return {
        "machine_id_missing": F.col("machine_id").isNotNull(),
        "plant_id_missing": F.col("plant_id").isNotNull(),
        "timestamp_missing": F.col("event_timestamp").isNotNull(),
        "temperature_missing": F.col("temperature_celsius").isNotNull(),
        "temperature_out_of_range": strictly_between(
            "temperature_celsius", limits.temperature_low, limits.temperature_high
        ),
        "vibration_missing": F.col("vibration_hz").isNotNull(),
        "vibration_out_of_range": strictly_between(
            "vibration_hz", limits.vibration_low, limits.vibration_high
        ),
    }


def passes_gate(limits: SensorLimits = LIMITS) -> Column:
    return reduce(Column.__and__, gate_rules(limits).values())


def fails_gate(limits: SensorLimits = LIMITS) -> Column:
    """Exact complement of the gate, as alternatives that a scan can be asked for.

    A missing value is one of them, so no predicate is undecided; NaN is above
    every upper limit.
    """

    def outside(name: str, low: float, high: float) -> Column:
        value = F.col(name)
        return value.isNull() | (value <= F.lit(low)) | (value >= F.lit(high))

    missing = [F.col(c).isNull() for c in ("machine_id", "plant_id", "event_timestamp")]
    ranges = [
        outside("temperature_celsius", limits.temperature_low, limits.temperature_high),
        outside("vibration_hz", limits.vibration_low, limits.vibration_high),
    ]
    return reduce(Column.__or__, missing + ranges)


def reject_reasons(limits: SensorLimits = LIMITS) -> Column:
    """Names of the failed rules; a missing value is not also out of range."""
    named = [F.when(~rule, F.lit(name)) for name, rule in gate_rules(limits).items()]
    return F.filter(F.array(*named), lambda name: name.isNotNull())


def reading_flags(limits: SensorLimits = LIMITS) -> dict[str, Column]:
    """``is_fault_event`` stays NULL where the status is NULL."""
    return {
        "is_overheating": F.col("temperature_celsius") > F.lit(limits.overheating_above),
        "is_vibration_anomaly": F.col("vibration_hz") > F.lit(limits.vibration_anomaly_above),
        "is_fault_event": F.col("operational_status") == F.lit(limits.fault_status),
    }


def flag_total(flag: str) -> Column:
    """Rows with the flag set; NULL when no row of the group knows the flag."""
    return F.sum(F.col(flag).cast("int"))


def day_measures() -> list[Column]:
    """The measures of one machine-day, all with map-side partials.

    Fixed values: the names and their order are those of the gold table.
    """
    return [
        F.avg("temperature_celsius").alias("avg_temp_24h"),
        F.max("temperature_celsius").alias("max_temp_24h"),
        F.stddev_samp("temperature_celsius").alias("temp_stddev_24h"),
        F.avg("vibration_hz").alias("avg_vibration_24h"),
        F.max("vibration_hz").alias("max_vibration_24h"),
        F.avg("pressure_bar").alias("avg_pressure_24h"),
        flag_total("is_fault_event").alias("fault_event_count_24h"),
        flag_total("is_overheating").alias("overheat_count_24h"),
        flag_total("is_vibration_anomaly").alias("vibration_anomaly_count_24h"),
        F.count("error_code").alias("error_code_count_24h"),
        F.count(F.lit(1)).alias("total_readings_24h"),
    ]


def risk_score(
    faults: str | Column,
    overheats: str | Column,
    vibrations: str | Column,
    readings: str | Column,
    weights: RiskWeights = WEIGHTS,
    null_status_as_ok: bool = False,
) -> Column:
    """Weighted share of flagged readings, at most the ceiling.

    The terms are added left to right in double so that scores at the alarm
    level fall on the same side everywhere. ``least`` skips NULL: a group whose
    status is never known scores the ceiling, unless ``null_status_as_ok``.
    """
    faults, overheats, vibrations, readings = (
        F.col(c) if isinstance(c, str) else c for c in (faults, overheats, vibrations, readings)
    )
    if null_status_as_ok:
        faults = F.coalesce(faults, F.lit(0))
    flagged = faults * weights.fault + overheats * weights.overheating
    flagged = flagged + vibrations * weights.vibration
    return F.least(F.lit(weights.ceiling), flagged / F.greatest(readings, F.lit(1)))


def day_risk(weights: RiskWeights = WEIGHTS, null_status_as_ok: bool = False) -> Column:
    return risk_score(
        "fault_event_count_24h",
        "overheat_count_24h",
        "vibration_anomaly_count_24h",
        "total_readings_24h",
        weights,
        null_status_as_ok,
    )


def rounded(value: str | Column, digits: int) -> Column:
    """Half-up rounding of the decimal reading, so float noise decides no tie."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")
