"""Writes. A target with a slash is a path, any other a catalog table."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwatch import schemas
from millwatch.functions.text import ISO_MICROS


def is_path(target: str) -> bool:
    return "/" in target


def _save(writer: DataFrameWriter, target: str) -> None:
    writer.save(target) if is_path(target) else writer.saveAsTable(target)


def read_target(
    spark: SparkSession, target: str, fmt: str = "parquet", schema: str | StructType | None = None
) -> DataFrame:
    if not is_path(target):
        return spark.read.table(target)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(target)


def write_table(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    _save(df.write.format(fmt).mode("overwrite"), target)


def rebalanced(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of one key together, but a hot key over as many tasks as it needs.

    The rebalance hint lets adaptive execution split large partitions and merge
    small ones, so a third of all rows in one partition is no single task. With
    no keys it only evens out file sizes.
    """
    return df.hint("rebalance", *[F.col(key) for key in keys])


@contextmanager
def _touched_partitions_only(spark: SparkSession) -> Iterator[None]:
    """Catalog inserts take the overwrite mode from the session, not the writer."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(mode, before)


def overwrite_touched(df: DataFrame, target: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions that ``df`` holds and leave all others alone."""
    spark = df.sparkSession
    if is_path(target):
        writer = df.write.format(fmt).mode("overwrite").partitionBy(*keys)
        writer.option("partitionOverwriteMode", "dynamic").save(target)
    elif spark.catalog.tableExists(target):
        with _touched_partitions_only(spark):
            df.select(*spark.read.table(target).columns).write.insertInto(target, overwrite=True)
    else:
        df.write.format(fmt).partitionBy(*keys).saveAsTable(target)


def write_partitioned(
    df: DataFrame,
    target: str,
    keys: Sequence[str] = schemas.PLANT_DAY,
    fmt: str = "parquet",
    only_touched: bool = False,
    replace_schema: bool = False,
    rebalance: bool = True,
) -> None:
    """Overwrite a partitioned table, or only the partitions that ``df`` holds.

    Input that already lies in the order of its keys, such as files landed day by
    day, can skip the shuffle with ``rebalance=False``: each task then writes the
    few partitions it holds.
    """
    rows = rebalanced(df, keys) if rebalance else df
    if only_touched:
        overwrite_touched(rows, target, keys, fmt)
        return
    writer = rows.write.format(fmt).mode("overwrite").partitionBy(*keys)
    if is_path(target):
        # not for a catalog table: it would keep the option for later inserts
        writer = writer.option("partitionOverwriteMode", "static")
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    _save(writer, target)


def write_run(df: DataFrame, target: str, run_id: str, fmt: str = "parquet") -> None:
    """Append the rows of one run; the same run again replaces its own rows, also
    when it has none any more."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"not usable as a run id: {run_id!r}")
    rows = rebalanced(df)
    if is_path(target):
        rows.write.format(fmt).mode("overwrite").save(f"{target}/run_id={run_id}")
        return
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        empty = df.withColumn("run_id", F.lit(run_id)).limit(0)
        empty.write.format(fmt).partitionBy("run_id").saveAsTable(target)
    columns = [c for c in spark.read.table(target).columns if c != "run_id"]
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION (run_id = '{run_id}') SELECT * FROM {{rows}}",
        rows=rows.select(*columns),
    )


def write_quarantine(rejected: DataFrame, target: str, run_id: str, fmt: str = "parquet") -> None:
    write_run(rejected, target, run_id, fmt)


def write_json_lines(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Newline-joined JSON objects; ``rows_per_file`` bounds each file."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.option("timestampFormat", ISO_MICROS).json(path)


def stream_json_lines(stream: DataFrame, path: str, checkpoint: str):
    """Events of a stream as JSON files, one per task and batch, not one per event."""
    writer = stream.writeStream.format("json").option("checkpointLocation", checkpoint)
    writer = writer.option("timestampFormat", ISO_MICROS)
    return writer.trigger(availableNow=True).start(path)


def load_reference(df: DataFrame, target: str) -> None:
    """Empty the reference table and load it anew."""
    writer = df.write.mode("overwrite").option("truncate", True)
    _save(writer.format("parquet"), target)


def publish_serving(
    df: DataFrame,
    target: str,
    jdbc_url: str | None = None,
    jdbc_options: dict[str, str] | None = None,
) -> None:
    """Replace the serving copy of a gold table, in a database or as a table."""
    if jdbc_url is None:
        write_table(df, target)
        return
    writer = df.write.format("jdbc").mode("overwrite").option("truncate", True)
    writer.option("url", jdbc_url).option("dbtable", target).options(**(jdbc_options or {})).save()


def written_count(spark: SparkSession, target: str) -> int:
    """Rows of the written table, counted from file footers by the Parquet scan."""
    return read_target(spark, target).count()


def ensure_table(spark: SparkSession, name: str, layout: str, keys: Sequence[str] = ()) -> None:
    """Create an empty table with the declared columns unless it exists."""
    partitioning = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout}) USING parquet{partitioning}")


def drop_partitions(spark: SparkSession, table: str, partitions: Sequence[dict]) -> None:
    """Drop whole partitions of a catalog table in one statement."""
    if not partitions:
        return

    def clause(values: dict) -> str:
        quoted = {k: str(v).replace("\\", "\\\\").replace("'", "\\'") for k, v in values.items()}
        return "PARTITION (" + ", ".join(f"{k} = '{v}'" for k, v in quoted.items()) + ")"

    clauses = ", ".join(map(clause, partitions))
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")


def materialize(df: DataFrame, name: str, kind: str = "view") -> None:
    """Publish a result as a session view or as a written table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        write_table(df, name)
    else:
        raise ValueError(f"unknown kind of materialisation: {kind}")


def preview(df: DataFrame, rows: int = 10) -> None:
    df.show(rows, truncate=False)
