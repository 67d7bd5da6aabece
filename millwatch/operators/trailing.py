"""Trailing and sliding 24-hour risk.

Both work on mergeable partial totals of readings. The trailing window of a
reading at ``t`` is cut into three parts that need no window over a machine's
whole history:

* the head: the cell (one minute) holding ``t``, up to ``t``;
* the middle: the whole cells in between, from one total per cell;
* the tail: the end of the cell holding ``t - span``.

Tail rows are moved forward by the span, so that they meet the readings they
matter to in one cell. The middle is cut once more at span boundaries in the
same way. Every window is a running one, so costs are linear, and the largest
group is one machine's cell or one machine's cell totals over one span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import WEIGHTS, RiskWeights
from millwatch.functions import cells
from millwatch.functions.measures import risk_score

KEY = ("machine_id", "plant_id")
SUMS = ("readings", "known_statuses", "faults", "overheats", "vibrations", "temp_sum", "vib_sum")
PEAKS = ("temp_max", "vib_max")


def partials() -> list[Column]:
    """Totals of readings; fault totals are zero here when no status is known."""

    def flagged(flag: str) -> Column:
        return F.count(F.when(F.col(flag), 1))

    return [
        F.count(F.lit(1)).alias("readings"),
        F.count("is_fault_event").alias("known_statuses"),
        flagged("is_fault_event").alias("faults"),
        flagged("is_overheating").alias("overheats"),
        flagged("is_vibration_anomaly").alias("vibrations"),
        F.sum("temperature_celsius").alias("temp_sum"),
        F.sum("vibration_hz").alias("vib_sum"),
        F.max("temperature_celsius").alias("temp_max"),
        F.max("vibration_hz").alias("vib_max"),
    ]


def merged_partials() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS] + [F.max(c).alias(c) for c in PEAKS]


def results(suffix: str, weights: RiskWeights) -> list[Column]:
    """Measures and risk from partials, under the given name suffix."""
    faults = F.when(F.col("known_statuses") > 0, F.col("faults"))
    score = risk_score(faults, "overheats", "vibrations", "readings", weights)
    return [
        F.col("readings").alias(f"total_readings_{suffix}"),
        faults.alias(f"fault_event_count_{suffix}"),
        F.col("overheats").alias(f"overheat_count_{suffix}"),
        F.col("vibrations").alias(f"vibration_anomaly_count_{suffix}"),
        (F.col("temp_sum") / F.col("readings")).alias(f"avg_temp_{suffix}"),
        F.col("temp_max").alias(f"max_temp_{suffix}"),
        (F.col("vib_sum") / F.col("readings")).alias(f"avg_vibration_{suffix}"),
        F.col("vib_max").alias(f"max_vibration_{suffix}"),
        score.alias(f"risk_score_{suffix}"),
    ]


def _both_sides(
    rows: DataFrame, position: str, span: int, group: Column, with_peers: bool
) -> DataFrame:
    """Add, per own row, totals of own rows before it and of moved rows after it.

    Rows of one span ago are moved onto the present; in each group ``before``
    covers the own rows up to a position and ``after`` the moved rows from it.
    ``with_peers`` says whether the position itself belongs to both.
    """
    shifts = F.array(F.lit(0).cast("bigint"), F.lit(span).cast("bigint"))
    both = (
        rows.withColumn("__shift", F.explode(shifts))
        .withColumns({position: F.col(position) + F.col("__shift"), "__own": F.col("__shift") == 0})
        .withColumn("__group", group)
        .drop("__shift")
    )
    frame = (Window.unboundedPreceding, Window.currentRow if with_peers else -1)
    grouped = Window.partitionBy(*KEY, "__group")
    up = grouped.orderBy(position).rangeBetween(*frame)
    down = grouped.orderBy(F.desc(position)).rangeBetween(*frame)
    totals = {}
    for name in SUMS + PEAKS:
        total = "sum" if name in SUMS else "max"
        totals[f"before_{name}"] = F.expr(f"{total}(if(__own, {name}, NULL))").over(up)
        totals[f"after_{name}"] = F.expr(f"{total}(if(__own, NULL, {name}))").over(down)
    return both.withColumns(totals).filter("__own").drop("__own", "__group", *SUMS, *PEAKS)


def _combined(sides: list[str]) -> dict[str, Column]:
    """Merge the named parts; an empty part is NULL and adds nothing."""
    merged = {}
    for name in SUMS:
        merged[name] = F.expr(" + ".join(f"coalesce({side}_{name}, 0)" for side in sides))
    for name in PEAKS:
        merged[name] = F.expr(f"greatest({', '.join(f'{side}_{name}' for side in sides)})")
    return merged


def trailing_risk(
    silver: DataFrame,
    hours: int = 24,
    cell_minutes: int = 1,
    weights: RiskWeights = WEIGHTS,
) -> DataFrame:
    """Measures and risk over the ``hours`` up to each instant with readings.

    Both ends belong to the window, and so do readings of the same instant. One
    row per machine, plant and instant: readings that share an instant share
    the answer, and are merged before anything is shuffled by time. Use
    ``with_trailing_risk`` for one row per reading.
    """
    span, width = hours * cells.HOUR, cell_minutes * cells.MINUTE
    if span % width:
        raise ValueError("a whole number of cells must fill the trailing window")
    instants = silver.groupBy(*KEY, "event_timestamp").agg(*partials())
    instants = instants.withColumn("at", F.unix_micros("event_timestamp"))
    per_cell = (
        instants.withColumn("cell", cells.cell_start("at", width))
        .groupBy(*KEY, "cell")
        .agg(*merged_partials())
    )
    middle = _both_sides(per_cell, "cell", span, cells.cell_start("cell", span), with_peers=False)
    middle = middle.select(
        *KEY, "cell", *[c.alias(f"middle_{n}") for n, c in _combined(["before", "after"]).items()]
    )
    ends = _both_sides(
        instants.drop("event_timestamp"), "at", span, cells.cell_start("at", width), with_peers=True
    )
    whole = (
        ends.withColumn("cell", cells.cell_start("at", width))
        .join(middle, [*KEY, "cell"])
        .withColumns(_combined(["before", "middle", "after"]))
    )
    return whole.select(
        *KEY, F.timestamp_micros("at").alias("event_timestamp"), *results("trailing", weights)
    )


def with_trailing_risk(silver: DataFrame, trailing: DataFrame) -> DataFrame:
    """Every reading with the trailing measures of its instant.

    Adaptive execution splits an instant that holds very many readings.
    """
    return silver.join(trailing, [*KEY, "event_timestamp"])


def sliding_risk(
    silver: DataFrame, hours: int = 24, step_hours: int = 1, weights: RiskWeights = WEIGHTS
) -> DataFrame:
    """Measures and risk of every ``hours`` window, one starting each step.

    Readings are reduced to one row per machine and step before that row, not
    each reading, is copied into the windows it belongs to.
    """
    if hours % step_hours:
        raise ValueError("a whole number of steps must fill the window")
    step = step_hours * cells.HOUR
    steps = (
        silver.withColumn("__step", cells.cell_start(F.unix_micros("event_timestamp"), step))
        .groupBy(*KEY, "__step")
        .agg(*partials())
    )
    return windows_of(steps, hours, step_hours, weights)


def windows_of(
    steps: DataFrame, hours: int = 24, step_hours: int = 1, weights: RiskWeights = WEIGHTS
) -> DataFrame:
    """The windows of ``sliding_risk`` from the totals of their steps."""
    step = step_hours * cells.HOUR
    first = F.col("__step") - F.lit((hours // step_hours - 1) * step)
    starts = F.sequence(first, F.col("__step"), F.lit(step).cast("bigint"))
    windows = (
        steps.withColumn("__start", F.explode(starts)).groupBy(*KEY, "__start").agg(*merged_partials())
    )
    return windows.select(
        *KEY,
        F.timestamp_micros("__start").alias("window_start"),
        F.timestamp_micros(F.col("__start") + F.lit(hours * cells.HOUR)).alias("window_end"),
        *results("sliding", weights),
    )
