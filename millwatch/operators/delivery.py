"""Publishing readings: keyed payloads, bounded batches, delivery accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import DELIVERY, DeliveryPolicy
from millwatch.functions import cells
from millwatch.functions.text import payload_struct


def to_key_value(readings: DataFrame, key: str = "machine_id") -> DataFrame:
    """The two columns every broker sink takes; the machine is the key."""
    payload = F.to_json(payload_struct(readings), {"ignoreNullFields": "false"})
    return readings.select(F.col(key).alias("key"), payload.alias("value"))


def assign_batches(
    records: DataFrame,
    order: str,
    policy: DeliveryPolicy = DELIVERY,
    positions_per_cell: int = 100_000,
) -> DataFrame:
    """Number consecutive batches of at most ``batch_rows`` in the order of a
    unique integer column. Every row gets a batch; only the last is short."""
    numbered = cells.global_row_number(records, order, positions_per_cell, "__row")
    place = F.col("__row") - 1
    return numbered.withColumns(
        {
            "batch_id": F.floor(place / F.lit(policy.batch_rows)).cast("bigint"),
            "batch_position": (place % F.lit(policy.batch_rows)).cast("int"),
        }
    ).drop("__row")


def record_outcomes(outcomes: DataFrame, policy: DeliveryPolicy = DELIVERY) -> DataFrame:
    """One row per record: attempts made, whether it was sent, its last error."""
    ok = F.col("error_code").isNull()
    return (
        outcomes.groupBy("record_id")
        .agg(
            F.max("attempt").alias("attempts"),
            F.count(F.when(ok, 1)).alias("__sent"),
            F.max_by("error_code", "attempt").alias("last_error"),
        )
        .select(
            "record_id",
            "attempts",
            "last_error",
            F.when(F.col("__sent") > 0, "sent")
            .when(F.col("attempts") > policy.max_retries, "error")
            .otherwise("pending")
            .alias("state"),
        )
    )


def delivery_ledger(outcomes: DataFrame, policy: DeliveryPolicy = DELIVERY) -> DataFrame:
    """Records sent, failed for good and still to be retried, and all attempts."""
    per_record = record_outcomes(outcomes, policy)
    return per_record.agg(
        *[
            F.count(F.when(F.col("state") == state, 1)).alias(name)
            for state, name in (("sent", "sent"), ("error", "errors"), ("pending", "pending"))
        ],
        F.coalesce(F.sum("attempts"), F.lit(0)).cast("bigint").alias("attempts"),
    )


def pending_retries(outcomes: DataFrame, policy: DeliveryPolicy = DELIVERY) -> DataFrame:
    """Only the records to send again, with the pause before it.

    The pause doubles with each failed attempt.
    """
    pending = record_outcomes(outcomes, policy).filter(F.col("state") == "pending")
    pause = F.lit(policy.backoff_base_seconds) * F.pow(F.lit(2.0), F.col("attempts"))
    return pending.select("record_id", "attempts", "last_error", pause.alias("backoff_seconds"))
