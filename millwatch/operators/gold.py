"""Gold: risk per machine, plant and day, and roll-ups of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.config import WEIGHTS, RiskWeights
from millwatch.functions import measures

COMPACT = (
    "avg_temp_24h",
    "max_temp_24h",
    "avg_vibration_24h",
    "max_vibration_24h",
    "fault_event_count_24h",
    "overheat_count_24h",
    "vibration_anomaly_count_24h",
    "total_readings_24h",
    "risk_score",
)


def gold_risk(
    silver: DataFrame, weights: RiskWeights = WEIGHTS, null_status_as_ok: bool = False
) -> DataFrame:
    """Eleven measures and the risk of each machine, plant and (UTC) day.

    All aggregates have map-side partials: a hot machine-day is reduced to one
    row per task before it is shuffled.
    """
    days = silver.groupBy(*schemas.MACHINE_DAY).agg(*measures.day_measures())
    return days.withColumns(
        {
            "risk_score": measures.day_risk(weights, null_status_as_ok),
            "_gold_loaded_at": F.current_timestamp(),
        }
    )


def compact(gold: DataFrame) -> DataFrame:
    """The eight-measure variant; unused aggregates are pruned from the plan."""
    return gold.select(*schemas.MACHINE_DAY, *COMPACT)


def risk_rollup(gold: DataFrame) -> DataFrame:
    """Machine, plant and grand totals.

    Machine totals come first, so the rollup expands one row per machine
    instead of one per machine-day.
    """
    per_machine = gold.groupBy("plant_id", "machine_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("risk_score").alias("risk_sum"),
        F.max("risk_score").alias("peak"),
        F.sum("fault_event_count_24h").alias("faults"),
    )
    return (
        per_machine.rollup("plant_id", "machine_id")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("days").alias("machine_days"),
            (F.sum("risk_sum") / F.sum("days")).alias("avg_risk_score"),
            F.max("peak").alias("peak_risk_score"),
            F.sum("faults").alias("total_faults"),
        )
    )


def hourly_profile(silver: DataFrame) -> DataFrame:
    """What an hour of the day looks like at each plant."""
    return silver.groupBy("plant_id", "event_hour").agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("temperature_celsius").alias("avg_temp"),
        F.avg("vibration_hz").alias("avg_vibration"),
        measures.flag_total("is_fault_event").alias("faults"),
        measures.flag_total("is_overheating").alias("overheats"),
    )


def with_missing_days(gold: DataFrame, first_day=None, last_day=None) -> DataFrame:
    """One row per machine and day from the first to the last day seen anywhere.

    Days without readings have zero readings and no risk. The days come from a
    sequence per machine, the bounds from scalar subqueries.
    """
    days = gold.select(F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    first = F.lit(first_day).cast("date") if first_day else days.select("first").scalar()
    last = F.lit(last_day).cast("date") if last_day else days.select("last").scalar()
    machines = gold.select("machine_id", "plant_id").distinct()
    spine = machines.withColumn("event_date", F.explode(F.sequence(first, last)))
    known = gold.select(*schemas.MACHINE_DAY, "total_readings_24h", "risk_score")
    return spine.join(known, list(schemas.MACHINE_DAY), "left").select(
        *schemas.MACHINE_DAY,
        F.coalesce("total_readings_24h", F.lit(0)).alias("total_readings_24h"),
        "risk_score",
        F.col("total_readings_24h").isNull().alias("is_silent"),
    )


def silent_spells(gold: DataFrame, first_day=None, last_day=None) -> DataFrame:
    """Runs of days without readings, one row each, of every machine.

    By default a machine's own first and last day bound it, so a single stray date makes one row
    and not a row per day and machine. Given days bound all machines alike and add what is silent
    before a machine's first or after its last reading. NULL dates are left out.
    """
    first, last = (F.lit(d).cast("date") for d in (first_day, last_day))
    in_order = Window.partitionBy("machine_id", "plant_id").orderBy("event_date")
    seen = gold.filter(F.col("event_date").isNotNull()).select(
        *schemas.MACHINE_DAY,
        F.lag("event_date").over(in_order).alias("__before"),
        F.lead("event_date").over(in_order).alias("__after"),
    )
    day = F.col("event_date")
    after = F.struct(
        F.date_add(day, 1).alias("a"), F.coalesce(F.date_sub("__after", 1), last).alias("b")
    )
    ahead = F.when(F.col("__before").isNull(), F.struct(first.alias("a"), F.date_sub(day, 1).alias("b")))
    spells = seen.withColumn("__spell", F.explode(F.array(after, ahead))).select(
        "machine_id",
        "plant_id",
        F.when(F.col("__spell.a").isNotNull(), F.greatest("__spell.a", first)).alias("silent_from"),
        F.when(F.col("__spell.b").isNotNull(), F.least("__spell.b", last)).alias("silent_to"),
    )
    length = F.datediff("silent_to", "silent_from").cast("bigint") + 1
    return spells.withColumn("silent_days", length).filter(F.col("silent_days") > 0)


def silent_dates(spells: DataFrame) -> DataFrame:
    """The days of these spells, one row each; narrow the spells first."""
    days = F.explode(F.sequence("silent_from", "silent_to")).alias("event_date")
    return spells.select("machine_id", "plant_id", days)
