"""Bronze: typed readings with load time, and defaults for absent fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch import schemas


def to_bronze(raw: DataFrame) -> DataFrame:
    """Type the timestamp and add its date and the load time.

    Text that is no timestamp becomes NULL, which the quality gate rejects.
    """
    at = F.col("event_timestamp").try_cast("timestamp")
    return raw.withColumns(
        {
            "event_timestamp": at,
            "event_date": at.cast("date"),
            "_ingested_at": F.current_timestamp(),
        }
    )


def apply_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill absent optional fields, keeping each column's type."""
    defaults = schemas.TELEMETRY_DEFAULTS if defaults is None else defaults
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(kinds[name]))
            for name, value in defaults.items()
            if name in kinds
        }
    )


def merge_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name of batches whose columns drifted apart."""
    merged = first
    for other in others:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def drop_resends(readings: DataFrame) -> DataFrame:
    """One reading per machine and instant; a resend repeats the whole reading.

    Readings that lack either can't be told from each other, so all of them stay
    and the gate sees them.
    """
    named = F.col("machine_id").isNotNull() & F.col("event_timestamp").isNotNull()
    once = readings.filter(named).dropDuplicates(["machine_id", "event_timestamp"])
    return once.unionByName(readings.filter(~named))
