"""Distinct machines over any range of days, from stored daily sketches.

A sketch per plant and day has a bounded size (about 2 to the power of ``LOG2_BUCKETS`` bytes) however many
readings or machines there are; sketches of any days and plants are united when read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch import schemas

LOG2_BUCKETS = 12
#: Relative standard error of a HyperLogLog estimate that was united: 1.04 / sqrt(buckets).
STANDARD_ERROR = 1.04 / 2 ** (LOG2_BUCKETS / 2)


def machine_sketches(silver: DataFrame) -> DataFrame:
    """One sketch of the machines per plant and day, with map-side partials."""
    seen = F.hll_sketch_agg("machine_id", F.lit(LOG2_BUCKETS))
    return silver.groupBy(*schemas.PLANT_DAY).agg(seen.alias("machine_sketch"))


def united(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated machines of the days and plants that fall into each group."""
    union = F.hll_union_agg("machine_sketch")
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(union).alias("machines_seen"))


def agrees(estimate: str, exact: str, errors: float = 4.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count.

    False if either is missing.
    """
    apart = F.abs(F.col(estimate) - F.col(exact))
    bound = F.greatest(F.lit(1.0), errors * STANDARD_ERROR * F.col(exact))
    return F.coalesce(apart <= bound, F.lit(False))
