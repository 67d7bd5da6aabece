"""Reference data: enrichment, baselines, inventory, canonical entities.

No join carries a broadcast hint. Spark broadcasts a side whose size it has
checked against ``spark.sql.autoBroadcastJoinThreshold``; beyond that it sorts
and merges, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MACHINE_COLUMNS = ("machine_type", "baseline_temp_c", "baseline_vibration_hz", "is_active")

# Entity names are fixed values; the columns are our reading of the tables.
CANONICAL = {
    "site": {
        "site_id": "plant_id",
        "asset_id": "machine_id",
        "asset_type": "machine_type",
        "is_active": "is_active",
    },
    "tpartner": {
        "tpartner_id": "supplier_id",
        "description": "supplier_name",
        "product_id": "part_id",
        "lead_time_days": "avg_lead_time_days",
        "is_active": "is_active",
    },
    "inventory_level": {
        "product_id": "part_id",
        "site_id": "warehouse_id",
        "tpartner_id": "supplier_id",
        "on_hand_inventory": "stock_level",
        "safety_stock": "safety_stock",
        "snapshot_date": "snapshot_date",
    },
}


def enrich_machines(readings: DataFrame, machines: DataFrame) -> DataFrame:
    """Readings with the master data of their machine, on batches and streams.

    The plant on record is named ``registered_plant_id``: it may differ from
    the plant the reading came from.
    """
    master = machines.select(
        "machine_id", F.col("plant_id").alias("registered_plant_id"), *MACHINE_COLUMNS
    )
    return readings.join(master, "machine_id", "left")


def baseline_deviation(silver: DataFrame, machines: DataFrame) -> DataFrame:
    """Share by which each machine's mean temperature and vibration leave its
    baseline. Readings are averaged per machine before the join."""
    means = silver.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("temperature_celsius").alias("avg_temp"),
        F.avg("vibration_hz").alias("avg_vibration"),
    )

    def deviation(mean: str, baseline: str):
        return (F.col(mean) - F.col(baseline)) / F.nullif(F.col(baseline), F.lit(0.0))

    baselines = machines.select("machine_id", "baseline_temp_c", "baseline_vibration_hz")
    return means.join(baselines, "machine_id").withColumns(
        {
            "temp_deviation": deviation("avg_temp", "baseline_temp_c"),
            "vibration_deviation": deviation("avg_vibration", "baseline_vibration_hz"),
        }
    )


def inventory_value(inventory: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Stock on hand at the supplier's unit cost, in exact decimals."""
    costs = suppliers.select("supplier_id", "supplier_name", "unit_cost")
    value = (F.col("stock_level") * F.col("unit_cost")).cast("decimal(20,2)")
    return inventory.join(costs, "supplier_id").withColumn("stock_value", value)


def reorder_alerts(inventory: DataFrame) -> DataFrame:
    """Positions under their reorder point or safety stock, critical under the latter.

    The shortfall is against the reorder point, or against the safety stock where
    only that is broken.
    """
    stock = F.col("stock_level")
    to_reorder, unsafe = stock < F.col("reorder_point"), stock < F.col("safety_stock")
    limit = F.when(to_reorder, F.col("reorder_point")).otherwise(F.col("safety_stock"))
    return inventory.filter(to_reorder | unsafe).withColumns(
        {
            "severity": F.when(unsafe, "CRITICAL").otherwise("REORDER"),
            "shortfall": limit - stock,
        }
    )


def to_canonical(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename: canonical name -> column."""
    return df.select(*[F.col(column).alias(name) for name, column in mapping.items()])
