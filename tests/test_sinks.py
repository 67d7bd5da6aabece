from __future__ import annotations

import json
from pathlib import Path

import pytest
from telemetry_support import at
from pyspark.sql import functions as F

from millwatch.operators.gold import gold_risk
from millwatch.sources import sinks

DAY = 60 * 24


def data_files(path) -> list[Path]:
    return sorted(p for p in Path(path).rglob("part-*") if p.is_file())


def test_partitioned_overwrite_and_touched_only(spark, silver, tmp_path):
    target = str(tmp_path / "silver")
    first = silver({}, {"event_timestamp": at(DAY)})
    sinks.write_partitioned(first, target)
    assert (tmp_path / "silver/plant_id=PLANT_MX_01/event_date=2024-03-02").is_dir()
    changed = silver({"event_timestamp": at(DAY + 1)}, {"event_timestamp": at(DAY + 2)})
    sinks.write_partitioned(changed, target, only_touched=True)
    assert sinks.written_count(spark, target) == 3
    sinks.write_partitioned(changed, target)
    assert sinks.written_count(spark, target) == 2


def test_replaced_layout(spark, tmp_path):
    target = str(tmp_path / "t")
    keys = ["plant_id"]
    sinks.write_partitioned(spark.sql("SELECT 'p' AS plant_id, 1 AS a"), target, keys)
    sinks.write_partitioned(
        spark.sql("SELECT 'p' AS plant_id, 'x' AS b"), target, keys, replace_schema=True
    )
    assert set(sinks.read_target(spark, target).columns) == {"plant_id", "b"}


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Nine rows in ten share one plant and day; small target sizes stand in
    for large data."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "HOT").otherwise("COLD").alias("plant_id"),
        F.lit("2024-03-01").cast("date").alias("event_date"),
        F.xxhash64("id").alias("noise"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "500k")
    try:
        sinks.write_partitioned(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before)
    hot = [p for p in data_files(tmp_path / "t") if "plant_id=HOT" in str(p)]
    assert len(hot) >= 4
    assert sinks.written_count(spark, str(tmp_path / "t")) == 400_000


def test_quarantine_is_stored_once_per_run(spark, bronze, tmp_path):
    rejected = bronze({"machine_id": None}, {"machine_id": None})
    for target in (str(tmp_path / "q"), "quarantine_test"):
        for run_id in ("a", "a", "b"):
            sinks.write_quarantine(rejected, target, run_id)
        stored = sinks.read_target(spark, target).groupBy("run_id").count().collect()
        assert {(r.run_id, r["count"]) for r in stored} == {("a", 2), ("b", 2)}
        sinks.write_quarantine(rejected.limit(0), target, "a")
        left = sinks.read_target(spark, target, schema=rejected.schema.add("run_id", "string"))
        assert {r.run_id for r in left.collect()} == {"b"}
    with pytest.raises(ValueError, match="run id"):
        sinks.write_quarantine(rejected, str(tmp_path / "q"), "../a")


def test_quarantine_errors_are_raised(spark, bronze, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_quarantine(bronze({}), str(tmp_path / "file" / "q"), "a")


def test_json_lines_in_bounded_files(spark, bronze, tmp_path):
    rows = bronze(*[{"event_timestamp": at(i, microseconds=7)} for i in range(10)]).coalesce(1)
    sinks.write_json_lines(rows, str(tmp_path / "j"), rows_per_file=4)
    files = data_files(tmp_path / "j")
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert len(files) == 3 and len(lines) == 10
    assert lines[0]["event_timestamp"] == "2024-03-01T00:00:00.000007Z"


def test_tables_are_created_once(spark):
    for _ in range(2):
        sinks.ensure_table(spark, "declared", "a INT, b STRING", keys=["b"])
    assert spark.read.table("declared").columns == ["a", "b"]
    spark.sql("INSERT INTO declared VALUES (1, 'x'), (2, 'y'), (3, 'z'), (4, \"it's\")")
    sinks.ensure_table(spark, "declared", "a INT, b STRING", keys=["b"])
    sinks.drop_partitions(spark, "declared", [{"b": "x"}, {"b": "y"}, {"b": "none"}, {"b": "it's"}])
    sinks.drop_partitions(spark, "declared", [])
    assert [r.a for r in spark.read.table("declared").collect()] == [3]


def test_reference_load_and_serving_replace(spark, tmp_path):
    for target in (str(tmp_path / "m"), "machines_test"):
        sinks.load_reference(spark.range(5), target)
        sinks.load_reference(spark.range(2), target)
        assert sinks.written_count(spark, target) == 2
    sinks.publish_serving(spark.range(4), str(tmp_path / "s"))
    sinks.publish_serving(spark.range(3), str(tmp_path / "s"))
    assert sinks.written_count(spark, str(tmp_path / "s")) == 3


def test_views_and_tables(spark, silver, capsys):
    days = gold_risk(silver({}))
    sinks.materialize(days, "gold_view")
    sinks.materialize(days, "gold_table", kind="table")
    assert spark.table("gold_view").count() == spark.table("gold_table").count() == 1
    assert not spark.catalog.getTable("gold_table").isTemporary
    with pytest.raises(ValueError, match="materialisation"):
        sinks.materialize(days, "x", kind="index")
    sinks.preview(days.select("machine_id"))
    assert "MCH_0001" in capsys.readouterr().out


def test_touched_partitions_of_a_catalog_table(spark):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "n INT, k STRING")

    for frame in (rows((1, "x"), (2, "y")), rows((3, "y"), (4, "z"))):
        sinks.write_partitioned(frame, "touched_table", ["k"], only_touched=True)
    stored = {(r.n, r.k) for r in spark.read.table("touched_table").collect()}
    assert stored == {(1, "x"), (3, "y"), (4, "z")}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    sinks.write_partitioned(rows((9, "x")), "touched_table", ["k"])
    assert [r.n for r in spark.read.table("touched_table").collect()] == [9]
