"""Late readings of a stream and changes of several tables in one feed."""

from __future__ import annotations

import json

import pytest
from telemetry_support import at

from millwatch.operators import changes, incremental
from millwatch.operators.gold import gold_risk
from millwatch.sources import changes as change_feed
from millwatch.streaming import late, risk


def run(spark, base, silver):
    landed = spark.readStream.schema(silver.schema).parquet(f"{base}/landing")
    late.stream_readings(landed, base, f"{base}/checkpoint").awaitTermination()
    days = risk.daily_risk(landed)
    risk.stream_upserts(days, f"{base}/gold", f"{base}/gold-checkpoint").awaitTermination()


def test_late_days_are_made_good(spark, silver, tmp_path):
    base, day = str(tmp_path), 24 * 60
    first = silver({"event_timestamp": at(5)}, {"event_timestamp": at(3 * day)})
    second = silver(
        {"event_timestamp": at(6), "temperature_celsius": 150.0},  # behind by three days
        {"event_timestamp": at(3 * day - 30)},  # within the delay
        {"event_timestamp": at(3 * day + 60)},
    )
    for rows in (first, second):
        rows.write.mode("append").parquet(f"{base}/landing")
        run(spark, base, rows)
    behind = late.late_readings(spark, base, first)
    assert [r.temperature_celsius for r in behind.collect()] == [150.0]
    assert [str(r.event_date) for r in incremental.touched_days(behind).collect()] == ["2024-03-01"]
    streamed = risk.read_upserts(spark, f"{base}/gold")
    whole = late.stored_readings(spark, base, first)
    assert whole.count() == 5
    done = late.completed_gold(streamed, whole, behind)
    expected = gold_risk(first.union(second)).select(*streamed.columns)
    assert sorted(map(repr, done.collect())) == sorted(map(repr, expected.collect()))
    assert sorted(map(repr, streamed.collect())) != sorted(map(repr, expected.collect()))


def test_a_batch_run_again_changes_nothing(spark, silver, tmp_path):
    base = str(tmp_path)
    rows = silver({"event_timestamp": at(5)}, {"event_timestamp": at(500)})
    rows.write.parquet(f"{base}/landing")
    landed = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    for checkpoint in ("one", "two"):  # the same batch from the beginning
        late.stream_readings(landed, base, f"{base}/{checkpoint}").awaitTermination()
    assert late.stored_readings(spark, base, rows).count() == 2
    assert late.late_readings(spark, base, rows).count() == 0
    assert late.newest_before(spark, base, 0) is None
    assert late.newest_before(spark, base, 1) is not None


def line(table, op, lsn, **row):
    image = {k: v for k, v in row.items()}
    sides = {"before": image if op != "c" else None, "after": image if op != "d" else None}
    return (json.dumps({"payload": {**sides, "op": op, "ts_ms": lsn, "source": {"table": table, "lsn": lsn}}}),)


def test_one_pass_routes_every_table(spark, tmp_path):
    lines = [
        line("suppliers", "c", 1, supplier_id="S1", unit_cost="12.50", is_active=True),
        line("machines", "u", 2, machine_id="M1", baseline_temp_c=61.5),
        line("inventory_levels", "d", 3, id=7, part_id="P", warehouse_id="W"),
        line("inventory_levels", "c", 4, id=8, part_id="P", warehouse_id="W", stock_level=5),
        line("elsewhere", "c", 5, id=1),
        line(None, "c", 6),
        ("{broken",),
    ]
    events = change_feed.parse_all_changes(spark.createDataFrame(lines, "value string"))
    folder = f"{tmp_path}/routed"
    change_feed.route_changes(events, folder)
    suppliers = change_feed.routed_changes(spark, folder, "suppliers")
    assert dict(suppliers.select("after.*").dtypes)["unit_cost"] == "decimal(10,2)"
    assert suppliers.selectExpr("after.unit_cost", "before is null b").collect()[0][1] is True
    inventory = change_feed.routed_changes(spark, folder, "inventory_levels")
    flat = changes.flatten_changes(inventory, ["part_id", "warehouse_id"])
    assert sorted((r.part_id, r.warehouse_id, r.op, r.id) for r in flat.collect()) == [("P", "W", "c", 8), ("P", "W", "d", None)]
    kept = spark.read.parquet(folder).groupBy("table_name").count().collect()
    assert {r.table_name: r["count"] for r in kept} == {
        "suppliers": 1, "machines": 1, "inventory_levels": 2, "elsewhere": 1, None: 2
    }
    assert change_feed.routed_changes(spark, folder, "machines").count() == 1


def test_a_column_of_two_types_is_refused(monkeypatch):
    tables = {"a": "id BIGINT, x INT", "b": "id STRING"}
    monkeypatch.setattr(change_feed.schemas, "REFERENCE_TABLES", tables)
    with pytest.raises(ValueError, match="two types"):
        change_feed.merged_layout()
