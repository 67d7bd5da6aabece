"""Quality gate, quarantine, and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.config import LIMITS, SensorLimits
from millwatch.functions import measures


def valid_rows(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    return bronze.filter(measures.passes_gate(limits))


def quarantine_all(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    """Every rejected row, duplicates included; narrow, so it also streams."""
    return bronze.filter(measures.fails_gate(limits))


def split_valid(bronze: DataFrame, limits: SensorLimits = LIMITS) -> tuple[DataFrame, DataFrame]:
    return valid_rows(bronze, limits), quarantine_all(bronze, limits)


def quarantine_distinct(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    """Bronze EXCEPT valid: identical rejected rows count once.

    The gate looks only at the row itself, so the set difference is a filter
    and a distinct, whose partial aggregation collapses copies before shuffling.
    """
    return quarantine_all(bronze, limits).distinct()


def quarantine_count(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    """Rejected rows, all and distinct, in one row."""
    rejected = quarantine_all(bronze, limits)
    copies = rejected.groupBy(*rejected.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rejected_rows"),
        F.count(F.lit(1)).alias("rejected_distinct"),
    )


def with_reject_reasons(bronze: DataFrame, limits: SensorLimits = LIMITS) -> DataFrame:
    """Rejected rows with the names of all rules they fail."""
    return quarantine_all(bronze, limits).withColumn(
        "reject_reasons", measures.reject_reasons(limits)
    )


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is not allowed; NULL is a matter for the not-null check."""
    return df.filter(~F.col(column).isin(*allowed))


def check_domains(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Failing rows, once per column whose value is not allowed, with the rule's name and the value.

    All columns are checked in one pass. NULL is a matter for the not-null check.
    """
    found = [
        F.when(~F.col(c).isin(*allowed), F.struct(F.lit(f"domain:{c}").alias("rule"), F.col(c).alias("value")))
        for c, allowed in domains.items()
    ]
    failing = F.filter(F.array(*found), lambda f: f.isNotNull())
    return df.withColumn("__found", F.explode(failing)).select(*df.columns, "__found.rule", "__found.value")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failing rows, once per missing column, with the rule's name."""
    missing = [
        F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in columns
    ]
    rules = F.filter(F.array(*missing), lambda rule: rule.isNotNull())
    return df.withColumn("rule", F.explode(rules))


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_with_key"))
    return counted.filter(F.col("rows_with_key") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key refers to nothing.

    A parent table under Spark's broadcast limit is sent to the child rows, which
    then stay where they are. Beyond it both sides are shuffled once and adaptive
    execution splits a hot key.
    """
    referring = child.filter(F.col(key).isNotNull())
    return referring.join(parent.select(key), key, "left_anti")


def as_failures(failing: DataFrame, rule: str | None = None) -> DataFrame:
    """Failing rows of any check as (rule, record), ready to be stored together."""
    named = failing if rule is None else failing.withColumn("rule", F.lit(rule))
    record = F.to_json(F.struct(*[c for c in named.columns if c != "rule"]))
    return named.select("rule", record.alias("record"))


def reconcile(bronze: DataFrame, silver: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows per plant and day in each table and what is unaccounted for.

    The tables are counted in one grouping, so a missing plant or date forms a
    group of its own and no outer join is needed. ``quarantined`` must keep
    duplicates.
    """
    tables = {"bronze_rows": bronze, "silver_rows": silver, "quarantined_rows": quarantined}
    stacked = None
    for name, table in tables.items():
        marks = [F.lit(1 if name == other else 0).cast("bigint").alias(other) for other in tables]
        rows = table.select(*schemas.PLANT_DAY, *marks)
        stacked = rows if stacked is None else stacked.unionByName(rows)
    counted = stacked.groupBy(*schemas.PLANT_DAY).agg(*[F.sum(n).alias(n) for n in tables])
    return counted.withColumn(
        "unaccounted_rows",
        F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantined_rows"),
    )


def frame_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on each side.

    One grouping over both frames; equal frames give no rows.
    """
    columns = left.columns
    sides = left.withColumn("__side", F.lit(1)).unionByName(
        right.select(*columns).withColumn("__side", F.lit(-1))
    )
    counted = sides.groupBy(*columns).agg(F.sum("__side").alias("surplus_left"))
    return counted.filter(F.col("surplus_left") != 0)
