"""Change events of the reference tables as JSON envelopes: of one table, or of all in one pass."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas


def _wire_layout(table: str) -> str:
    """Decimals travel as text, everything else as itself."""
    return schemas.REFERENCE_TABLES[table].replace("DECIMAL(10,2)", "STRING")


def _row(layout: str) -> str:
    columns = (column.split(maxsplit=1) for column in re.split(r",(?![^(]*\))", layout))
    return ", ".join(f"{name}: {kind}" for name, kind in columns)


def _declared(events: DataFrame, table: str) -> DataFrame:
    """The events of one table, both rows with the types its layout declares."""
    found = events.filter(F.col("source.table") == table)
    if _wire_layout(table) == schemas.REFERENCE_TABLES[table]:
        return found
    row = f"STRUCT<{_row(schemas.REFERENCE_TABLES[table])}>"
    typed: dict[str, Column] = {c: F.col(c).cast(row) for c in ("before", "after")}
    return found.withColumns(typed)


def envelope_layout(table: str) -> str:
    row = _row(_wire_layout(table))
    return (
        f"payload STRUCT<before: STRUCT<{row}>, after: STRUCT<{row}>, op: STRING, "
        "ts_ms: BIGINT, source: STRUCT<table: STRING, lsn: BIGINT>>"
    )


def read_changes(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Change files of all tables; keeps the events of one."""
    events = spark.read.schema(envelope_layout(table)).json(path)
    return _declared(events.select("payload.*"), table)


def parse_changes(lines: DataFrame, table: str, text: str = "value") -> DataFrame:
    """The same envelopes held as text in a column."""
    event = F.from_json(text, envelope_layout(table)).alias("event")
    return _declared(lines.select(event).select("event.payload.*"), table)


def _columns(layout: str) -> dict[str, str]:
    """Names and types of a layout."""
    columns = (column.split(maxsplit=1) for column in re.split(r",(?![^(]*\))", layout))
    return {name: kind.strip() for name, kind in columns}


def merged_layout() -> str:
    """An envelope whose rows hold the columns of all tables; a table fills its own."""
    merged: dict[str, str] = {}
    for table in schemas.REFERENCE_TABLES:
        for name, kind in _columns(_wire_layout(table)).items():
            if merged.setdefault(name, kind) != kind:
                raise ValueError(f"column {name} has two types: {merged[name]} and {kind} in {table}")
    row = ", ".join(f"{name}: {kind}" for name, kind in merged.items())
    return (
        f"payload STRUCT<before: STRUCT<{row}>, after: STRUCT<{row}>, op: STRING, "
        "ts_ms: BIGINT, source: STRUCT<table: STRING, lsn: BIGINT>>"
    )


def read_all_changes(spark: SparkSession, path: str) -> DataFrame:
    """Change files of all tables, parsed once."""
    return spark.read.schema(merged_layout()).json(path).select("payload.*")


def parse_all_changes(lines: DataFrame, text: str = "value") -> DataFrame:
    """The same envelopes held as text in a column."""
    return lines.select(F.from_json(text, merged_layout()).alias("event")).select("event.payload.*")


def route_changes(events: DataFrame, folder: str) -> None:
    """Write the events of all tables in one pass, each table's in a partition of its own.

    Events of tables that have no layout are kept beside them, and those without a table under
    an empty name, so none is lost.
    """
    table = F.coalesce("source.table", F.lit(""))
    named = events.withColumn("table_name", table)
    named.write.mode("overwrite").partitionBy("table_name").parquet(folder)


def routed_changes(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The routed events of one table, with its own columns and declared types. Only the
    partition of the table is read, and of it the columns of the table."""
    layout = merged_layout().removeprefix("payload STRUCT<").removesuffix(">")
    fields = f"payload STRUCT<{layout}>"
    stored = spark.createDataFrame([], fields).select("payload.*").schema.add("table_name", "string")
    events = spark.read.schema(stored).parquet(folder).filter(F.col("table_name") == table)

    def own(side: str) -> Column:
        columns = _columns(schemas.REFERENCE_TABLES[table])
        row = F.struct(*[F.col(f"{side}.{name}").cast(kind).alias(name) for name, kind in columns.items()])
        return F.when(F.col(side).isNotNull(), row)

    return events.select(
        own("before").alias("before"), own("after").alias("after"), "op", "ts_ms", "source"
    )
