"""Tables by name or path, reference tables, and checks on what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millwatch import schemas


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_path(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str | StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Pass a schema for partitioned Parquet: path values such as ``007`` would
    otherwise be inferred as numbers."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def resolve_source(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """The named table if the catalog has it, else the path; a missing path raises."""
    if spark.catalog.tableExists(table):
        return read_table(spark, table)
    return read_path(spark, path, fmt)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Refuse an empty input instead of going on with made-up rows."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def read_reference(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    jdbc_url: str | None = None,
    jdbc_options: dict[str, str] | None = None,
) -> DataFrame:
    """``machines``, ``suppliers`` or ``inventory_levels`` from JDBC or Parquet.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``jdbc_options`` to read a large table in parallel.
    """
    if jdbc_url:
        reader = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", name)
        return reader.options(**(jdbc_options or {})).load()
    if path is None:
        raise ValueError("either a path or a JDBC address is needed")
    return spark.read.schema(schemas.REFERENCE_TABLES[name]).parquet(path)
