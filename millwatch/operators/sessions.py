"""Sessions of consecutive faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.functions import cells

KEY = ("machine_id", "plant_id")


CELL = (*KEY, "__cell")


def cell_totals() -> list[Column]:
    """Totals of the faults of one cell."""
    at = F.unix_micros("event_timestamp")
    return [
        F.min(at).alias("__first"),
        F.max(at).alias("__last"),
        F.count(F.lit(1)).alias("__n"),
        F.max("temperature_celsius").alias("__peak"),
    ]


def fault_sessions(silver: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Runs of faults less than ``gap_minutes`` apart; a run ends one gap after
    its last fault.

    Faults inside one cell as long as the gap always share a session, so they
    are merged first, with partials on the map side.
    """
    cell = cells.cell_start(F.unix_micros("event_timestamp"), gap_minutes * cells.MINUTE)
    merged = (
        silver.filter("is_fault_event").groupBy(*KEY, cell.alias("__cell")).agg(*cell_totals())
    )
    return joined_cells(merged, gap_minutes)


def joined_cells(merged: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Sessions from the totals of cells as long as the gap.

    The window over a machine sees at most one row per gap of time, however many
    faults there are.
    """
    gap = gap_minutes * cells.MINUTE
    in_time = Window.partitionBy(*KEY).orderBy("__cell")
    apart = F.col("__first") - F.lag("__last").over(in_time) >= F.lit(gap)
    numbered = merged.withColumn("__new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "__session", F.sum("__new").over(in_time)
    )
    return (
        numbered.groupBy(*KEY, "__session")
        .agg(
            F.timestamp_micros(F.min("__first")).alias("session_start"),
            F.timestamp_micros(F.max("__last") + F.lit(gap)).alias("session_end"),
            F.sum("__n").alias("faults"),
            F.max("__peak").alias("max_temp"),
        )
        .drop("__session")
    )
