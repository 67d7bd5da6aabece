"""Tables compared by additive fingerprints, from parts down to rows.

The fingerprint of a set of rows is the sum of their hashes: it does not depend on their order,
counts copies, and sums of parts add up to that of the whole, so it is taken with map-side
partials and can be stored. Two tables are compared part by part, then bucket by bucket inside
the parts that differ, and rows are compared only in buckets that differ. Between equal tables
one row per task and part is shuffled.

A difference is missed only if the hashes of the surplus rows of a part add up to those of the
missing ones, for 64-bit hashes about once in 2^64 parts that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.operators.quality import frame_differences

ROWS, SUMS = "rows", ("low_sum", "middle_sum", "high_sum")
#: Hashes are added in three pieces of 21 or 22 bits: a sum of 2^41 rows fits 64 bits.
PIECE = 21


def row_hash(columns: Sequence[str]) -> Column:
    """The hash of a row; which columns are NULL is part of it."""
    gaps = [F.col(f"`{c}`").isNull() for c in columns]
    return F.xxhash64(*gaps, *[F.col(f"`{c}`") for c in columns])


def fingerprints(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows and sums of their hashes per part, over ``columns`` (all, if not given)."""
    hashed = df.select(*by, row_hash(columns or df.columns).alias("__hash"))
    return _summed(hashed, by)


def _summed(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    value, mask = F.col("__hash"), F.lit((1 << PIECE) - 1).cast("bigint")
    pieces = (
        value.bitwiseAND(mask),
        F.shiftrightunsigned(value, PIECE).bitwiseAND(mask),
        F.shiftrightunsigned(value, 2 * PIECE),
    )
    sums = [F.sum(piece).alias(name) for piece, name in zip(pieces, SUMS, strict=True)]
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def differing_parts(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Parts whose fingerprints differ, with the surplus of rows on the left.

    Takes fingerprints, which may be stored ones: then the table they were taken of is not read.
    A part that one side lacks differs from an empty one.
    """
    totals = (ROWS, *SUMS)
    signed = left.select(*by, *totals).unionByName(right.select(*by, *[(-F.col(t)).alias(t) for t in totals]))
    summed = signed.groupBy(*by).agg(*[F.sum(t).alias(t) for t in totals])
    differs = reduce(Column.__or__, [F.col(t) != 0 for t in totals])
    return summed.filter(differs).select(*by, F.col(ROWS).alias("surplus_rows"))


def _within(df: DataFrame, parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of these parts; NULL is a part like any other."""
    a, b = df.alias("a"), parts.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    return a.join(b, reduce(Column.__and__, same), "left_semi")


def row_differences(left: DataFrame, right: DataFrame, by: Sequence[str], buckets: int = 1024) -> DataFrame:
    """Rows whose number of copies differs, as ``quality.frame_differences`` gives them.

    ``by`` names columns of both frames, best their partition columns; ``buckets`` is how finely
    a part that differs is looked at before rows are moved.
    """
    columns = left.columns
    right = right.select(*columns)
    parts = differing_parts(fingerprints(left, by), fingerprints(right, by), by)
    fine = [*by, "__bucket"]

    def bucketed(df: DataFrame) -> DataFrame:
        near = _within(df, parts, by).withColumn("__hash", row_hash(columns))
        return near.withColumn("__bucket", F.pmod("__hash", F.lit(buckets)).cast("int"))

    sides = [bucketed(left), bucketed(right)]
    apart = differing_parts(*[_summed(s.select(*fine, "__hash"), fine) for s in sides], fine)
    near = [_within(s, apart, fine).select(*columns) for s in sides]
    return frame_differences(*near)
