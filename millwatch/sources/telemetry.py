"""Raw telemetry: JSON lines in batch or as a stream, damaged and drifted lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


def read_telemetry(spark: SparkSession, path: str, corrupt_col: str | None = None) -> DataFrame:
    """JSON lines with the declared layout; ``corrupt_col`` keeps damaged text."""
    return _json_lines(spark.read, corrupt_col).json(path)


def stream_telemetry(
    spark: SparkSession, path: str, max_files: int = 1000, corrupt_col: str | None = None
) -> DataFrame:
    """The same scan as a stream that takes up to ``max_files`` new files a time."""
    reader = _json_lines(spark.readStream, corrupt_col).option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _json_lines(reader, corrupt_col: str | None):
    reader = reader.option("multiLine", False).option("mode", "PERMISSIVE")
    if corrupt_col is None:
        return reader.schema(schemas.RAW_TELEMETRY)
    layout = f"{schemas.RAW_TELEMETRY}, `{corrupt_col}` STRING"
    return reader.schema(layout).option("columnNameOfCorruptRecord", corrupt_col)


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def parse_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Parse JSON text held in a column; damaged text is kept whole."""
    layout = f"{schemas.RAW_TELEMETRY}, `{CORRUPT}` STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.withColumn("__row", F.from_json(text, layout, options)).select(
        *[c for c in lines.columns if c != text], "__row.*"
    )


def with_rescued(
    lines: DataFrame,
    known: Sequence[str] = schemas.RAW_TELEMETRY_COLUMNS,
    text: str = "value",
) -> DataFrame:
    """Add the fields outside ``known`` as a JSON object, NULL if there are none."""
    fields = F.from_json(text, "map<string,string>")
    extra = F.map_filter(fields, lambda name, _: ~name.isin(*known))
    return lines.withColumn(RESCUED, F.when(F.size(extra) > 0, F.to_json(extra)))


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with unknown fields rescued, damaged text kept and the file named."""
    lines = with_source_file(spark.read.text(path))
    return parse_lines(with_rescued(lines))


def stream_drifting(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same as a stream."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return parse_lines(with_rescued(with_source_file(reader.text(path))))
