"""Gold as mergeable states: what is stored of a machine-day can take in more readings.

A state holds counts, sums, maxima and the squared deviations of the temperature. New readings
are reduced to states of their own and joined to the stored ones, so the cost of an increment is
that of its own rows and of the states of the days it touches, never of their earlier readings.
Gold is a projection of the states. Maxima can't be taken back: days that lose readings are
computed anew (``millwatch.plans.increments``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.config import WEIGHTS, RiskWeights
from millwatch.functions import measures

#: Parts of a state that are added up and those of which the greater one stays.
ADDED = (
    "temperatures",
    "temperature_sum",
    "vibrations",
    "vibration_sum",
    "pressures",
    "pressure_sum",
    "faults",
    "overheats",
    "vibration_anomalies",
    "error_codes",
    "readings",
)
GREATEST = ("temperature_max", "vibration_max")
DEVIATIONS = "temperature_deviations"


def day_states(silver: DataFrame) -> DataFrame:
    """One state per machine-day of these readings, with map-side partials.

    Flags that no reading of a day knows have a NULL total, as in gold.
    """
    spread = F.var_pop("temperature_celsius") * F.count("temperature_celsius")
    return silver.groupBy(*schemas.MACHINE_DAY).agg(
        F.count("temperature_celsius").alias("temperatures"),
        F.sum("temperature_celsius").alias("temperature_sum"),
        spread.alias(DEVIATIONS),
        F.max("temperature_celsius").alias("temperature_max"),
        F.count("vibration_hz").alias("vibrations"),
        F.sum("vibration_hz").alias("vibration_sum"),
        F.max("vibration_hz").alias("vibration_max"),
        F.count("pressure_bar").alias("pressures"),
        F.sum("pressure_bar").alias("pressure_sum"),
        measures.flag_total("is_fault_event").alias("faults"),
        measures.flag_total("is_overheating").alias("overheats"),
        measures.flag_total("is_vibration_anomaly").alias("vibration_anomalies"),
        F.count("error_code").alias("error_codes"),
        F.count(F.lit(1)).alias("readings"),
    )


def _added(left: Column, right: Column) -> Column:
    return F.coalesce(left + right, left, right)


def merged_states(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The states of both; each side has at most one row per machine-day.

    Deviations are combined around the means of the two sides, which loses no digits where the
    readings are nearly equal. Readings have passed the gate, so no key is NULL.
    """
    both = stored.alias("a").join(fresh.alias("b"), list(schemas.MACHINE_DAY), "full_outer")

    def sides(name: str) -> tuple[Column, Column]:
        return F.col(f"a.{name}"), F.col(f"b.{name}")

    # a state without any temperature has no mean: nullif leaves the term between the sides out
    (sum_a, sum_b), counts = sides("temperature_sum"), sides("temperatures")
    count_a, count_b = (F.nullif(count, F.lit(0)) for count in counts)
    apart = sum_a / count_a - sum_b / count_b
    between = apart * apart * (count_a * count_b / (count_a + count_b))
    merged = {name: _added(*sides(name)) for name in ADDED}
    merged |= {name: F.greatest(*sides(name)) for name in GREATEST}
    merged[DEVIATIONS] = _added(_added(*sides(DEVIATIONS)), between)
    return both.select(*[merged[c].alias(c) if c in merged else F.col(c) for c in fresh.columns])


def gold_of_states(
    states: DataFrame, weights: RiskWeights = WEIGHTS, null_status_as_ok: bool = False
) -> DataFrame:
    """The gold table: a projection, without any shuffle."""

    def mean(total: str, count: str) -> Column:
        return F.col(total) / F.nullif(F.col(count), F.lit(0))

    spread = F.col(DEVIATIONS) / F.nullif(F.col("temperatures") - 1, F.lit(0))
    days = states.select(
        *schemas.MACHINE_DAY,
        mean("temperature_sum", "temperatures").alias("avg_temp_24h"),
        F.col("temperature_max").alias("max_temp_24h"),
        F.sqrt(spread).alias("temp_stddev_24h"),
        mean("vibration_sum", "vibrations").alias("avg_vibration_24h"),
        F.col("vibration_max").alias("max_vibration_24h"),
        mean("pressure_sum", "pressures").alias("avg_pressure_24h"),
        F.col("faults").alias("fault_event_count_24h"),
        F.col("overheats").alias("overheat_count_24h"),
        F.col("vibration_anomalies").alias("vibration_anomaly_count_24h"),
        F.col("error_codes").alias("error_code_count_24h"),
        F.col("readings").alias("total_readings_24h"),
    )
    return days.withColumns(
        {
            "risk_score": measures.day_risk(weights, null_status_as_ok),
            "_gold_loaded_at": F.current_timestamp(),
        }
    )
