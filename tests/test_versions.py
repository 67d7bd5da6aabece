"""Versioned tables: failures, conflicts, partial writes, cleaning and compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from telemetry_support import final_plan

from millwatch.operators import changes
from millwatch.sources import buckets, versions


@pytest.fixture
def table(tmp_path):
    return f"{tmp_path}/table"



@pytest.fixture
def days(spark):
    def build(*values):
        frame = spark.createDataFrame(list(values), "plant string, day string, n int")
        return frame.withColumn("day", F.col("day").cast("date"))

    return build


def found(spark, table, version=None):
    return sorted((r.plant, str(r.day), r.n) for r in versions.read_version(spark, table, version).collect())


A, B, C = ("A", "2024-01-01", 1), ("A", "2024-01-02", 2), ("B", "2024-01-01", 3)


def test_versions_follow_each_other(spark, table, days):
    assert versions.versions(spark, table) == [] and versions.manifest(spark, table) is None
    assert versions.commit(days(A, B), table) == 1
    assert versions.commit(days(C), table) == 2
    assert found(spark, table) == [C] and found(spark, table, 1) == [A, B]
    with pytest.raises(ValueError, match="no version 7"):
        versions.read_version(spark, table, 7)


def test_a_failed_write_leaves_the_version_before(spark, table, days):
    versions.commit(days(A, B), table, ["plant"])
    failing = days(*[("A", "2024-01-03", k) for k in range(200)]).repartition(4)
    failing = failing.withColumn("n", F.when(F.col("n") == 150, F.raise_error("broken")).otherwise(F.col("n")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        versions.commit(failing, table, ["plant"])
    assert versions.versions(spark, table) == [1] and found(spark, table) == [A, B]
    assert versions.commit(days(C), table, ["plant"]) == 2 and found(spark, table) == [C]


def test_the_second_of_two_writers_is_refused(spark, table, days, monkeypatch):
    versions.commit(days(A), table)
    with pytest.raises(versions.StaleVersion):
        versions.commit(days(B), table, expected=0)
    publish = versions._Files.publish

    def late(self, text, *names):  # another writer gets there while this one writes
        monkeypatch.setattr(versions._Files, "publish", publish)
        versions.commit(days(C), table)
        return publish(self, text, *names)

    monkeypatch.setattr(versions._Files, "publish", late)
    with pytest.raises(versions.StaleVersion, match="another writer"):
        versions.commit(days(B), table)
    assert found(spark, table) == [C] and versions.versions(spark, table) == [1, 2]


def test_only_touched_partitions_are_replaced(spark, table, days):
    keys = ["plant", "day"]
    versions.commit(days(A, B, C), table, keys)
    again = ("A", "2024-01-02", 9)
    versions.commit(days(again), table, keys, only_touched=True)
    assert found(spark, table) == [A, again, C]
    versions.commit(days(), table, keys, only_touched=True, gone=["plant=A/day=2024-01-01"])
    assert found(spark, table) == [again, C]
    assert found(spark, table, 1) == [A, B, C]
    assert "PartitionFilters: [isnotnull(plant" in final_plan(
        versions.read_version(spark, table).filter("plant = 'B'")
    )
    with pytest.raises(ValueError, match="another layout"):
        versions.commit(days(A).withColumn("more", F.lit(1)), table, keys, only_touched=True)
    with pytest.raises(ValueError, match="name their columns"):
        versions.commit(days(A), table, only_touched=True)


def test_nothing_left(spark, table, days):
    versions.commit(days(A), table, ["plant"])
    versions.commit(days(), table, ["plant"], only_touched=True, gone=["plant=A"])
    assert found(spark, table) == []
    versions.commit(days(), table, ["plant"])
    assert found(spark, table) == []
    versions.commit(days(("x=y/z %", "2024-01-01", 1), (None, None, None)), table, ["plant"])
    read = versions.read_version(spark, table).collect()
    assert {(r.plant, r.n) for r in read} == {("x=y/z %", 1), (None, None)}
    versions.commit(days(A), table, ["plant"], only_touched=True)
    assert {r.plant for r in versions.read_version(spark, table).collect()} == {"x=y/z %", None, "A"}


def test_cleaning_keeps_what_is_used(spark, table, days):
    keys = ["plant"]
    versions.commit(days(A, C), table, keys)
    held = versions.read_version(spark, table)
    versions.commit(days(("A", "2024-01-05", 5)), table, keys, only_touched=True)
    assert versions.clean(spark, table, grace_seconds=3600) == []
    assert sorted(r.n for r in held.collect()) == [1, 3]
    assert versions.clean(spark, table, grace_seconds=-5) == []  # its folder still holds B
    assert versions.versions(spark, table) == [2]
    versions.commit(days(A), table, keys)
    assert len(versions.clean(spark, table, grace_seconds=-5)) == 2
    assert found(spark, table) == [A]


def test_compaction_bounds_the_folders(spark, table, days):
    keys = ["plant", "day"]
    for k in range(1, 13):
        versions.commit(days(("A", f"2024-01-{k:02d}", k)), table, keys, only_touched=True)
    before = found(spark, table)
    held = versions.read_version(spark, table)
    assert len(versions.manifest(spark, table).parts) == 12
    assert versions.compact(spark, table, most_folders=4) == 13
    assert len(versions.manifest(spark, table).parts) == 4
    assert versions.compact(spark, table, most_folders=4) is None
    assert found(spark, table) == before and held.count() == 12


FLAT = "k string, w string, v int, op string, ts_ms bigint, lsn bigint"


def test_batches_in_any_order_give_one_state(spark):
    base = spark.createDataFrame([("a", "x", 0), ("b", "x", 0)], "k string, w string, v int")
    feed = [("a", "x", 1, "u", 10, 1), ("a", "x", None, "d", 20, 2), ("c", "x", 3, "c", 5, 3), ("c", "x", 4, "u", 5, 4),
            ("b", "y", 5, "c", 1, 5), ("a", None, 6, "c", None, None)]
    keys = ["k", "w"]
    whole = changes.apply_changes(base, spark.createDataFrame(feed, FLAT), keys)
    for order in ([0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0], [3, 2, 2, 1, 0, 4, 5, 0]):
        state = changes.opened(base)
        for k in order:
            state = changes.merged_state(state, spark.createDataFrame([feed[k]], FLAT), keys)
        assert sorted(map(tuple, changes.current_rows(state).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_merge_reads_only_touched_buckets(spark, table):
    base = spark.range(500).selectExpr("concat('k', id) k", "'x' w", "cast(id as int) v")
    buckets.create_bucketed(base, table, ["k", "w"], 16)
    flat = spark.createDataFrame([("k7", "x", -7, "u", 1, 1), ("k8", "x", None, "d", 1, 2)], FLAT)
    near = buckets.touched_state(spark, table, flat, ["k", "w"], 16)
    touched = {r[0] for r in flat.select(buckets.bucket_of(["k", "w"], 16)).collect()}
    read = {f.split("bucket=")[1].split("/")[0] for f in (r[0] for r in near.select(F.input_file_name()).distinct().collect())}
    assert {int(b) for b in read} == touched and "PartitionFilters: [bucket" in final_plan(near)
    assert buckets.merge_feed(spark, table, flat, ["k", "w"], 16) == 2
    assert buckets.merge_feed(spark, table, flat.limit(0), ["k", "w"], 16) is None
    now = {r.k: r.v for r in buckets.read_current(spark, table).collect()}
    assert len(now) == 499 and now["k7"] == -7 and "k8" not in now and now["k9"] == 9
    replaced = versions.manifest(spark, table).parts[0].partitions
    assert {int(p.removeprefix("bucket=")) for p in replaced} == touched
