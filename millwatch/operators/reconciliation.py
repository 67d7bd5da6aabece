"""Reconciliation of written tables: what bronze holds and neither silver nor quarantine has.

Counts per plant and day come first; rows are looked at only where fingerprints differ, so that
tables without a loss move one row per task and plant-day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.operators import fingerprints, quality


def unaccounted_days(bronze: DataFrame, silver: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Plant-days whose rows don't add up: a positive rest was lost, a negative one came twice."""
    counted = quality.reconcile(bronze, silver, quarantined)
    return counted.filter(F.col("unaccounted_rows") != 0)


def unaccounted_rows(
    bronze: DataFrame, silver: DataFrame, quarantined: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """The rows themselves, with the surplus of copies in bronze (negative: too many downstream).

    A loss and a surplus on one day cancel in the counts but not here. Rows are compared by
    ``columns``, by default those of bronze that both others have, load times left out; they must
    contain plant and date. ``quarantined`` must keep duplicates.
    """
    both = set(silver.columns) & set(quarantined.columns)
    shared = columns or [c for c in bronze.columns if c in both and not c.startswith("_")]
    downstream = silver.select(*shared).unionByName(quarantined.select(*shared))
    return fingerprints.row_differences(bronze.select(*shared), downstream, schemas.PLANT_DAY)
