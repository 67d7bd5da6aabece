from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions import cells
from millwatch.operators import changes, quality
from millwatch.sources import changes as feed

BASE_LAYOUT = "machine_id STRING, plant_id STRING, baseline_temp_c DOUBLE, note STRING"


def event(op: str, key: str, lsn: int, temp: float = 0.0, ts_ms: int | None = None, table="machines"):
    row = {"machine_id": key, "plant_id": "P1", "baseline_temp_c": temp}
    return {
        "payload": {
            "before": row if op in "ud" else None,
            "after": None if op == "d" else row,
            "op": op,
            "ts_ms": lsn * 1000 if ts_ms is None else ts_ms,
            "source": {"table": table, "lsn": lsn},
        }
    }


@pytest.fixture
def flat(spark, tmp_path):
    def build(*events):
        folder = tmp_path / "feed"
        folder.mkdir(exist_ok=True)
        (folder / "a.json").write_text("\n".join(json.dumps(e) for e in events))
        return changes.flatten_changes(feed.read_changes(spark, str(folder), "machines"), "machine_id")

    return build


def table_of(frame) -> dict:
    return {r.machine_id: r.baseline_temp_c for r in frame.collect()}


def test_feed_keeps_one_table_and_both_images(flat):
    rows = flat(event("c", "A", 1, 61.0), event("d", "A", 2), event("u", "Z", 3, table="suppliers"))
    got = {(r.machine_id, r.op, r.baseline_temp_c, r.lsn) for r in rows.collect()}
    assert got == {("A", "c", 61.0, 1), ("A", "d", None, 2)}


def test_last_change_wins(spark, flat):
    base = spark.createDataFrame(
        [("A", "P1", 1.0, "a"), ("B", "P1", 2.0, "b"), ("C", "P1", 3.0, "c"), ("D", "P1", 4.0, "d")], BASE_LAYOUT
    )
    rows = flat(
        event("r", "A", 1, 10.0),
        event("u", "A", 3, 30.0),
        event("u", "A", 2, 20.0),
        event("d", "B", 4),
        event("d", "C", 5),
        event("c", "C", 6, 60.0),
        event("c", "N", 7, 70.0),
        event("c", "G", 8, 80.0),
        event("d", "G", 9),
        # same millisecond: the log position decides
        event("u", "N", 11, 72.0, ts_ms=9000),
        event("u", "N", 10, 71.0, ts_ms=9000),
    )
    once = changes.apply_changes(base, rows, "machine_id")
    assert table_of(once) == {"A": 30.0, "C": 60.0, "D": 4.0, "N": 72.0}
    twice = changes.apply_changes(once, rows, "machine_id")
    assert quality.frame_differences(once, twice).isEmpty()
    assert {r.machine_id: r.note for r in once.collect()} == {"A": "a", "C": "c", "D": "d", "N": None}


def test_an_update_to_null_is_kept(spark, flat):
    base = spark.createDataFrame([("A", "P1", 1.0, "a")], BASE_LAYOUT)
    nulled = flat(event("u", "A", 1, None))
    assert table_of(changes.apply_changes(base, nulled, "machine_id")) == {"A": None}


def test_history_has_no_overlap_and_ends_at_deletes(flat):
    rng = random.Random(3)
    events = [
        event(rng.choice("cuud"), rng.choice("ABC"), lsn, float(lsn), ts_ms=rng.randrange(0, 9) * 3_000_000)
        for lsn in range(60)
    ]
    history = changes.scd2(flat(*events), "machine_id").collect()
    for key in "ABC":
        last = {}
        for e in events:
            p = e["payload"]
            row = p["after"] or p["before"]
            if row["machine_id"] == key:
                last[p["ts_ms"]] = p
        moments = sorted(last)
        expected = {
            (ms, moments[i + 1] if i + 1 < len(moments) else None, last[ms]["after"]["baseline_temp_c"])
            for i, ms in enumerate(moments)
            if last[ms]["op"] != "d"
        }

        def ms(value):
            return None if value is None else round(value.timestamp() * 1000)

        got = {
            (ms(r.valid_from), ms(r.valid_to), r.baseline_temp_c) for r in history if r.machine_id == key
        }
        assert got == expected
        assert all(r.is_current == (r.valid_to is None) for r in history)


def test_snapshots_close_and_open_versions(spark):
    def table(*rows):
        return spark.createDataFrame(rows, "machine_id STRING, v INT, updated_at STRING").withColumn(
            "updated_at", F.col("updated_at").cast("timestamp")
        )

    history = changes.open_history(table(("A", 1, "2024-01-01"), ("B", 1, "2024-01-01"), ("C", 1, "2024-01-01")))
    fresh = table(("A", 2, "2024-02-01"), ("B", 1, "2024-01-01"), ("D", 1, "2024-02-02"))
    once = changes.snapshot_history(history, fresh, "machine_id")
    rows = {(r.machine_id, r.v, r.is_current, r.valid_to and str(r.valid_to.date())) for r in once.collect()}
    assert rows == {
        ("A", 1, False, "2024-02-01"),
        ("A", 2, True, None),
        ("B", 1, True, None),
        ("C", 1, True, None),
        ("D", 1, True, None),
    }
    again = changes.snapshot_history(once, fresh, "machine_id")
    assert quality.frame_differences(once, again).isEmpty()


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_next_position_across_cells(spark, width):
    rng = random.Random(width)
    places = {k: sorted(rng.sample(range(-50, 300), 40)) for k in "ab"}
    rows = spark.createDataFrame([(k, p) for k, ps in places.items() for p in ps], "k STRING, p BIGINT")
    for r in cells.next_position(rows, ["k"], "p", width, "n").collect():
        later = [p for p in places[r.k] if p > r.p]
        assert r.n == (later[0] if later else None)


@pytest.mark.parametrize(("width", "fan"), [(1, 2), (10, 3), (100_000, 1000)])
def test_global_row_number(spark, width, fan):
    rng = random.Random(width)
    places = sorted(rng.sample(range(0, 5000), 200))
    rows = spark.createDataFrame([(p,) for p in places], "p BIGINT").repartition(7)
    numbered = cells.global_row_number(rows, "p", width, "n", fan).collect()
    assert {(r.p, r.n) for r in numbered} == {(p, i + 1) for i, p in enumerate(places)}


@pytest.mark.parametrize("parsed", [False, True])
def test_decimals_of_a_feed_keep_their_type(spark, tmp_path, parsed):
    layout = schemas.REFERENCE_TABLES["suppliers"]
    names = spark.createDataFrame([], layout).columns
    row = dict.fromkeys(names) | {"supplier_id": "S1", "unit_cost": "12345678.91"}
    line = json.dumps(
        {"payload": {"before": None, "after": row, "op": "u", "ts_ms": 1, "source": {"table": "suppliers", "lsn": 1}}}
    )
    if parsed:
        events = feed.parse_changes(spark.createDataFrame([(line,)], "value string"), "suppliers")
    else:
        (tmp_path / "a.json").write_text(line)
        events = feed.read_changes(spark, str(tmp_path), "suppliers")
    old = [tuple({"supplier_id": k, "unit_cost": Decimal("0.10")}.get(c) for c in names) for k in ("S1", "S2")]
    base = spark.createDataFrame(old, layout)
    after = changes.apply_changes(base, changes.flatten_changes(events, "supplier_id"), "supplier_id")
    assert after.schema["unit_cost"].dataType.simpleString() == "decimal(10,2)"
    got = {r.supplier_id: r.unit_cost for r in after.collect()}
    assert got == {"S1": Decimal("12345678.91"), "S2": Decimal("0.10")}
