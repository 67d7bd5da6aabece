"""Current tables laid out by a hash of their key, into which change feeds are merged.

A feed rewrites the buckets that hold its keys and reads no other: the buckets are the partitions
of a versioned table, so readers see each merge whole, and a merge that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.operators import changes
from millwatch.sources import versions

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_bucketed(base: DataFrame, table: str, keys: Sequence[str], buckets: int) -> int:
    """Lay out a table by key; its rows give way to any change."""
    state = changes.opened(base).withColumn(BUCKET, bucket_of(keys, buckets))
    return versions.commit(state, table, [BUCKET])


def touched_state(spark: SparkSession, table: str, flat: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows of the buckets that a feed touches. Only numbers of buckets reach the driver."""
    touched = flat.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()
    return versions.read_version(spark, table).filter(F.col(BUCKET).isin([r[BUCKET] for r in touched]))


def merge_feed(spark: SparkSession, table: str, flat: DataFrame, keys: Sequence[str], buckets: int) -> int | None:
    """Merge a batch of changes and return the new version, or None where nothing changes.

    Batches may come late or twice: each key keeps the place of the change it shows. ``buckets``
    must be that of the table. A second merge at the same time is refused (StaleVersion).
    """
    if flat.isEmpty():
        return None
    found = versions.manifest(spark, table)
    state = touched_state(spark, table, flat, keys, buckets).drop(BUCKET)
    merged = changes.merged_state(state, flat, keys).withColumn(BUCKET, bucket_of(keys, buckets))
    return versions.commit(merged, table, [BUCKET], only_touched=True, expected=found.version)


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The rows that are not deleted."""
    return changes.current_rows(versions.read_version(spark, table)).drop(BUCKET)
