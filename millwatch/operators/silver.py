"""Silver: valid readings with their flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import LIMITS, SensorLimits
from millwatch.functions import measures
from millwatch.operators.quality import valid_rows


def to_silver(valid: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    at = F.col("event_timestamp")
    derived = measures.reading_flags(limits) | {
        "event_date": F.to_date(at),
        "event_hour": F.hour(at),
        "_silver_loaded_at": F.current_timestamp(),
    }
    return valid.withColumns(derived).drop("_source_file", "_rescued_data", "_corrupt_record")


def silver_from_bronze(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    return to_silver(valid_rows(bronze, limits), limits)
