"""Text forms: JSON payloads, ISO timestamps, identifiers, key samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def numbered_id(prefix: str, number: Column, digits: int) -> Column:
    """``prefix`` and a zero-padded number, such as ``MCH_0007``.

    Padding alone would cut longer numbers, so those are kept as they are.
    """
    plain = number.cast("string")
    padded = F.when(F.length(plain) < digits, F.lpad(plain, digits, "0")).otherwise(plain)
    return F.concat(F.lit(prefix), padded)


def choose(options: tuple[str, ...], position: Column) -> Column:
    """The option at a 1-based position; NULL outside instead of an error."""
    return F.get(F.array(*map(F.lit, options)), position.cast("int") - 1)


def seconds_before(moment: str | Column, seconds: Column) -> Column:
    """A timestamp moved back by a number of whole seconds."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return moment - seconds.cast("interval second")


def payload_struct(df: DataFrame) -> Column:
    """All columns, timestamps as ISO-8601 text and decimals as plain text."""
    fields = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, ISO_MICROS)
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("string")
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def to_json_payload(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per row. NULL fields are written as null, not left out."""
    return df.select(F.to_json(payload_struct(df), {"ignoreNullFields": "false"}).alias(column))


def sample_by_key(df: DataFrame, key: str, percent: float) -> DataFrame:
    """A repeatable sample of whole keys: the same keys in every run and table."""
    slots = 1_000_000
    return df.filter(F.pmod(F.xxhash64(key), F.lit(slots)) < F.lit(int(percent * slots / 100)))
