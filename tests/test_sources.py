from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import text
from millwatch.operators import quality
from millwatch.operators.bronze import apply_defaults, drop_resends, merge_batches, to_bronze
from millwatch.operators.silver import silver_from_bronze
from millwatch.sources import session, tables, telemetry
from millwatch.streaming.silver import append_stream

GOOD = {
    "machine_id": "MCH_0001",
    "plant_id": "PLANT_MX_01",
    "event_timestamp": "2024-03-01T10:00:00Z",
    "temperature_celsius": 70.5,
    "vibration_hz": 50.0,
}


@pytest.fixture
def landing(tmp_path):
    lines = [
        json.dumps(GOOD),
        json.dumps(GOOD | {"event_timestamp": "2024-03-01T10:00:00.123456+00:00"}),
        json.dumps(GOOD | {"event_timestamp": "bad"}),
        json.dumps(GOOD | {"vibration_hz": "fast"}),
        json.dumps(GOOD | {"wifi_signal_strength": -42.5}),
        "{bad",
    ]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_json_scan_keeps_damaged_text(spark, landing):
    rows = telemetry.read_telemetry(spark, landing, telemetry.CORRUPT).cache().collect()
    damaged = {r[telemetry.CORRUPT] for r in rows if r[telemetry.CORRUPT]}
    assert len(rows) == 6 and len(damaged) == 2 and "{bad" in damaged
    wrong = next(r for r in rows if r[telemetry.CORRUPT] and r.machine_id)
    assert wrong.vibration_hz is None and wrong.temperature_celsius == 70.5


def test_bad_timestamps_reach_the_gate(spark, landing):
    bronze = to_bronze(telemetry.with_source_file(telemetry.read_telemetry(spark, landing)))
    assert bronze.filter(F.col("_source_file").endswith("a.json")).count() == 6
    valid, rejected = quality.split_valid(bronze)
    assert (valid.count(), rejected.count()) == (3, 3)
    moments = {r.event_timestamp.microsecond for r in valid.collect()}
    assert moments == {0, 123456}


def test_unknown_fields_survive(spark, landing):
    lines = spark.read.text(landing)
    rescued = telemetry.with_rescued(lines).filter(F.col(telemetry.RESCUED).isNotNull())
    assert [json.loads(r[telemetry.RESCUED]) for r in rescued.collect()] == [
        {"wifi_signal_strength": "-42.5"}
    ]
    again = text.to_json_payload(spark.createDataFrame([("m", -42.5)], "machine_id STRING, wifi DOUBLE"))
    assert json.loads(again.first().value) == {"machine_id": "m", "wifi": -42.5}


def test_drift_and_damage_in_one_scan(spark, landing, tmp_path):
    def check(rows):
        assert rows.count() == 6
        drifted = rows.filter(F.col(telemetry.RESCUED).isNotNull()).collect()
        assert [(r.machine_id, r[telemetry.RESCUED]) for r in drifted] == [
            ("MCH_0001", '{"wifi_signal_strength":"-42.5"}')
        ]
        assert rows.filter(F.col(telemetry.CORRUPT) == "{bad").count() == 1
        assert rows.filter(F.col("_source_file").endswith("a.json")).count() == 6
        silver = silver_from_bronze(to_bronze(rows))
        assert silver.count() == 3 and telemetry.RESCUED not in silver.columns

    check(telemetry.read_drifting(spark, landing))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    stream = telemetry.stream_drifting(spark, f"{landing}/*.json")
    append_stream(stream, out, checkpoint).awaitTermination()
    check(spark.read.parquet(out))


def test_payload_text_forms(spark):
    row = spark.sql(
        "SELECT TIMESTAMP '2024-03-01 10:00:00.5' AS snapshot_date, "
        "CAST(1.5 AS DECIMAL(10,2)) AS unit_cost, CAST(NULL AS STRING) AS error_code"
    )
    assert json.loads(text.to_json_payload(row).first().value) == {
        "snapshot_date": "2024-03-01T10:00:00.500000Z",
        "unit_cost": "1.50",
        "error_code": None,
    }


def test_source_resolution(spark, tmp_path):
    frame = spark.range(3)
    path = str(tmp_path / "numbers")
    frame.write.parquet(path)
    assert tables.resolve_source(spark, "no_such_table", path).count() == 3
    spark.range(5).write.mode("overwrite").saveAsTable("resolved_numbers")
    assert tables.resolve_source(spark, "resolved_numbers", path).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.resolve_source(spark, "no_such_table", str(tmp_path / "nothing"))


def test_empty_input_is_refused(spark):
    assert tables.require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="landing has no rows"):
        tables.require_rows(spark.range(0), "landing")


def test_reference_table_from_parquet(spark, tmp_path):
    path = str(tmp_path / "machines")
    spark.sql("SELECT 'M1' AS machine_id, 61.5 AS ignored").write.parquet(path)
    frame = tables.read_reference(spark, "machines", path=path)
    assert len(frame.columns) == 9 and frame.first().machine_id == "M1"
    with pytest.raises(ValueError, match="needed"):
        tables.read_reference(spark, "machines")


def test_partition_values_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT '007' AS plant_id, 1 AS n").write.partitionBy("plant_id").parquet(path)
    assert tables.read_path(spark, path, schema="plant_id STRING, n INT").first().plant_id == "007"


def test_defaults_keep_types(spark):
    sparse = spark.createDataFrame(
        [("p", None, None), ("q", 7, "1.25")], "part_id STRING, reorder_point INT, unit_cost STRING"
    ).withColumn("unit_cost", F.col("unit_cost").cast("decimal(10,2)"))
    filled = apply_defaults(sparse, schemas.INVENTORY_DEFAULTS)
    assert filled.dtypes == sparse.dtypes
    assert [(r.reorder_point, str(r.unit_cost)) for r in filled.orderBy("part_id").collect()] == [
        (100, "0.00"),
        (7, "1.25"),
    ]
    plain = spark.createDataFrame([(None, 3.0)], "rpm DOUBLE, power_consumption_kw DOUBLE")
    assert tuple(apply_defaults(plain).first()) == (0.0, 3.0)


def test_drifted_batches_and_resends(spark, bronze):
    merged = merge_batches(
        spark.createDataFrame([(1,)], "a INT"), spark.createDataFrame([(2, "x")], "a INT, b STRING")
    )
    assert {tuple(r) for r in merged.collect()} == {(1, None), (2, "x")}
    assert drop_resends(bronze({}, {}, {"machine_id": "M2"})).count() == 2
    assert drop_resends(bronze({"machine_id": None}, {"machine_id": None}, {"event_timestamp": None})).count() == 3


def test_identifiers(spark):
    numbers = spark.createDataFrame([(7,), (12345,)], "n BIGINT")
    ids = numbers.select(text.numbered_id("MCH_", F.col("n"), 4).alias("id"))
    assert [r.id for r in ids.collect()] == ["MCH_0007", "MCH_12345"]
    chosen = numbers.select(text.choose(("a", "b"), F.col("n") % 5).alias("c"))
    assert [r.c for r in chosen.collect()] == ["b", None]


def test_key_samples_are_whole_and_repeatable(spark):
    frame = spark.range(20_000).withColumn("key", F.col("id") % 1000)
    sample = text.sample_by_key(frame, "key", 10)
    sizes = {r["count"] for r in sample.groupBy("key").count().collect()}
    assert sizes == {20}
    assert 60 <= sample.select("key").distinct().count() <= 140
    assert quality.frame_differences(sample, text.sample_by_key(frame, "key", 10)).isEmpty()


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == configured
