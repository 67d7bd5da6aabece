"""Dashboards over gold: leaderboards, plant summary, counters, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.config import WEIGHTS, RiskWeights
from millwatch.functions.measures import rounded

BOARD_DIGITS = {"risk_score": 4, "avg_temp_24h": 1, "max_temp_24h": 1}
BOARD_COLUMNS = (
    "machine_id",
    "plant_id",
    "risk_score",
    "fault_event_count_24h",
    "overheat_count_24h",
    "vibration_anomaly_count_24h",
    "avg_temp_24h",
    "max_temp_24h",
    "event_date",
)
SHORT_BOARD_COLUMNS = (
    "machine_id",
    "plant_id",
    "risk_score",
    "fault_event_count_24h",
    "overheat_count_24h",
    "avg_temp_24h",
)


def leaderboard(
    gold: DataFrame, k: int = 10, rounded_values: bool = True, columns: Sequence[str] | None = None
) -> DataFrame:
    """The k riskiest machine-days; equal scores are ordered by their key.

    With rounded values the rounded score decides the order. Each task keeps
    only its best k rows.
    """
    if rounded_values:
        gold = gold.withColumns({c: rounded(c, d) for c, d in BOARD_DIGITS.items()})
        columns = BOARD_COLUMNS if columns is None else columns
    best = gold.orderBy(F.desc("risk_score"), *schemas.MACHINE_DAY).limit(k)
    return best if columns is None else best.select(*columns)


def plant_summary(gold: DataFrame) -> DataFrame:
    """Machines, mean risk of a machine-day and totals of each plant."""
    return (
        gold.groupBy("plant_id")
        .agg(
            F.count_distinct("machine_id").alias("total_machines"),
            rounded(F.avg("risk_score"), 4).alias("avg_plant_risk_score"),
            F.sum("fault_event_count_24h").alias("total_faults_24h"),
            F.sum("overheat_count_24h").alias("total_overheats_24h"),
        )
        .orderBy(F.desc("avg_plant_risk_score"), "plant_id")
    )


def risk_kpi(gold: DataFrame, weights: RiskWeights = WEIGHTS) -> DataFrame:
    """Machine-days above and not above the alarm level, and the peak.

    The column names say machines, as the dashboard does, but days are counted;
    see ``risk_kpi_machines``. An unknown risk is in neither count.
    """
    high = F.col("risk_score") > F.lit(weights.high_risk_above)
    return gold.agg(
        F.count(F.when(high, 1)).alias("high_risk_machine_count"),
        F.count(F.when(~high, 1)).alias("healthy_machine_count"),
        rounded(F.max("risk_score"), 4).alias("peak_risk_score"),
    )


def risk_kpi_machines(gold: DataFrame, weights: RiskWeights = WEIGHTS) -> DataFrame:
    """The same counters over machines: high once means high."""
    peaks = gold.groupBy("machine_id", "plant_id").agg(F.max("risk_score").alias("risk_score"))
    return risk_kpi(peaks, weights)


def rank_in_plant(gold: DataFrame) -> DataFrame:
    """Rank of every machine inside its plant and day, equal scores sharing one.

    A rank is one plus the machines with a higher score. Machines are counted
    per distinct score, the counts are summed inside narrow bands of scores and
    the bands are summed per plant and day, so no window holds a whole plant.
    """
    day = list(schemas.PLANT_DAY)
    band = F.floor(F.col("risk_score") * 1000).cast("int")
    scores = gold.groupBy(*day, "risk_score").agg(F.count(F.lit(1)).alias("__n"))
    scores = scores.withColumn("__band", band)
    higher = (Window.unboundedPreceding, -1)
    in_band = Window.partitionBy(*day, "__band").orderBy(F.desc("risk_score")).rowsBetween(*higher)
    over_bands = Window.partitionBy(*day).orderBy(F.desc("__band")).rowsBetween(*higher)
    bands = scores.groupBy(*day, "__band").agg(F.sum("__n").alias("__n"))
    bands = bands.select(*day, "__band", F.sum("__n").over(over_bands).alias("__above"))
    ranks = (
        scores.withColumn("__higher", F.sum("__n").over(in_band))
        .join(bands, [*day, "__band"])
        .select(
            *day,
            "risk_score",
            (
                F.coalesce("__higher", F.lit(0)) + F.coalesce("__above", F.lit(0)) + 1
            ).alias("rank_in_plant"),
        )
    )
    return gold.select(*day, "machine_id", "risk_score").join(ranks, [*day, "risk_score"])


def latest_reading(silver: DataFrame) -> DataFrame:
    """The newest reading of every machine, ties broken by the whole reading."""
    key = ["machine_id", "plant_id"]
    values = [
        "event_timestamp",
        "temperature_celsius",
        "vibration_hz",
        "pressure_bar",
        "operational_status",
        "error_code",
    ]
    newest = silver.groupBy(*key).agg(F.max(F.struct(*values)).alias("__newest"))
    return newest.select(*key, "__newest.*")
