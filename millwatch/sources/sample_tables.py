"""Telemetry, reference tables and feeds as functions of the given tables.

Every mapping is a deterministic projection of whole tables. The floor of a
scaled value is used where rounding would let two engines settle ties apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch import schemas
from millwatch.functions.text import ISO_MICROS, choose, numbered_id, to_json_payload
from millwatch.operators.bronze import to_bronze
from millwatch.operators.silver import silver_from_bronze

EVENTS = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
    value DOUBLE, props STRING
"""

# Fixed values of the sample plants, machines, error codes and warehouses.
PLANTS = ("PLANT_MX_01", "PLANT_DE_02", "PLANT_CN_03", "PLANT_IN_04", "PLANT_US_05")
MACHINE_TYPES = (
    "INJECTION_MOLDER",
    "CRIMPING_PRESS",
    "ASSEMBLY_ROBOT",
    "QUALITY_SCANNER",
    "CONVEYOR_SYSTEM",
)
ERROR_CODES = ("E001_OVERHEAT", "E002_VIBRATION", "E003_PRESSURE", "E004_BEARING_WEAR")
WAREHOUSES = ("WH_MX_01", "WH_DE_02", "WH_US_03", "WH_CN_04", "WH_IN_05")
THROTTLED = "ProvisionedThroughputExceededException"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet")
    return reader.parquet(sf_dir)


def _machine_id() -> Column:
    return numbered_id("MCH_", F.col("user_id") % 50 + 1, 4)


def _plant_id() -> Column:
    return choose(PLANTS, F.col("user_id") % 5 + 1)


def _unless_every(n: int, value: Column) -> Column:
    """NULL for every n-th event, so that each gate rule has rows to reject."""
    return F.when(F.col("event_id") % n != 0, value)


def telemetry_columns() -> dict[str, Column]:
    at, reading, kind = F.col("event_id"), F.col("value"), F.col("event_type")
    vibration = F.floor(2500 + (at % 35) * 100 + reading * 40) / 100.0
    status = F.when(kind == "error", "FAULT").when(kind == "view", "IDLE")
    return {
        "machine_id": _unless_every(101, _machine_id()),
        "plant_id": _plant_id(),
        "event_timestamp": F.col("ts").cast("timestamp"),
        "temperature_celsius": _unless_every(89, F.floor(5500 + reading * 50) / 100.0),
        "vibration_hz": _unless_every(97, F.when(at % 83 == 0, -1.0).otherwise(vibration)),
        "pressure_bar": _unless_every(61, (280 + at % 521) / 100.0),
        "operational_status": status.when(kind == "signup", "MAINTENANCE").otherwise("RUNNING"),
        "error_code": F.when(kind == "error", choose(ERROR_CODES, at % 4 + 1)),
        "rpm": (14000 + at % 2001) / 10.0,
        "power_consumption_kw": (1000 + at % 501) / 100.0,
    }


def telemetry_of(event_rows: DataFrame, *keep: str) -> DataFrame:
    """One reading per event, of a batch or a stream; ``keep`` adds event columns."""
    columns = [column.alias(name) for name, column in telemetry_columns().items()]
    return event_rows.select(*keep, *columns)


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive, with the timestamp as text."""
    text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return telemetry_of(events(spark, sf_dir)).withColumn("event_timestamp", text)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(telemetry_of(events(spark, sf_dir)))


def resent_events(event_rows: DataFrame) -> DataFrame:
    """All events, and purchases a second time: what a retrying producer sends."""
    return event_rows.unionByName(event_rows.filter(F.col("event_type") == "purchase"))


def resent_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(telemetry_of(resent_events(events(spark, sf_dir))))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_from_bronze(bronze(spark, sf_dir))


def drift_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines carrying one field the layout does not know."""
    rows = telemetry_of(events(spark, sf_dir), "event_id", "props")
    unknown = F.get_json_object("props", "$.k").cast("int").alias("firmware_k")
    known = to_json_payload(rows.select(*schemas.RAW_TELEMETRY_COLUMNS, "event_id", unknown))
    return known


def _machine_columns() -> dict[str, Column]:
    slot = F.col("user_id") % 50
    return {
        "machine_id": _machine_id(),
        "plant_id": _plant_id(),
        "machine_type": choose(MACHINE_TYPES, slot % 3 + 1),
        "installed_at": F.lit("2023-01-01 00:00:00").cast("timestamp"),
        "baseline_temp_c": (600 + slot * 4) / 10.0,
        "baseline_vibration_hz": (450 + slot * 4) / 10.0,
        "is_active": slot != 13,
        "created_at": F.lit("2023-01-01 00:00:00").cast("timestamp"),
        "updated_at": F.lit("2023-01-01 00:00:00").cast("timestamp"),
    }


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct machines of all events; each has one plant."""
    columns = [c.alias(name) for name, c in _machine_columns().items()]
    return events(spark, sf_dir).select("user_id").distinct().select(*columns).distinct()


def machine_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change event per event: signups create, errors delete, the rest update."""
    kind = F.col("event_type")
    at = F.col("ts").cast("timestamp")
    row = _machine_columns() | {
        "machine_type": choose(MACHINE_TYPES, F.col("event_id") % 5 + 1),
        "baseline_temp_c": F.floor(6000 + F.col("value") * 10) / 100.0,
        "updated_at": at,
    }
    image = F.struct(*[c.alias(name) for name, c in row.items()])
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    return events(spark, sf_dir).select(
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.unix_millis(at).alias("ts_ms"),
        F.struct(F.lit("machines").alias("table"), F.col("event_id").alias("lsn")).alias("source"),
    )


def _supplier_id(key: str) -> Column:
    return numbered_id("SUPP_", F.col(key) + 1, 5)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return rows.select(
        _supplier_id("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        numbered_id("PART_", key * 7 % 2000, 5).alias("part_id"),
        (3 + key % 28).cast("int").alias("avg_lead_time_days"),
        ((50 + key * 37 % 24950) / 100.0).cast("decimal(10,2)").alias("unit_cost"),
        F.lit(True).alias("is_active"),
    )


def inventory_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    unknown_supplier = order % 211 == 0
    transit = (
        F.when(F.col("l_returnflag") == "A", "IN_TRANSIT")
        .when(F.col("l_returnflag") == "R", "DELAYED")
        .when(F.col("l_linestatus") == "F", "DELIVERED")
        .otherwise("AT_WAREHOUSE")
    )
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select(
        numbered_id("PART_", F.col("l_partkey"), 5).alias("part_id"),
        F.when(unknown_supplier, "SUPP_99999")
        .otherwise(_supplier_id("l_suppkey"))
        .alias("supplier_id"),
        choose(WAREHOUSES, F.col("l_linenumber") % 5 + 1).alias("warehouse_id"),
        (F.col("l_quantity") * 6).cast("int").alias("stock_level"),
        transit.alias("transit_status"),
        (80 + order % 121).cast("int").alias("reorder_point"),
        (40 + order % 61).cast("int").alias("safety_stock"),
        F.col("l_shipdate").cast("timestamp").alias("snapshot_date"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _change(table: str, row: dict[str, Column], op: Column) -> list[Column]:
    """The envelope of a change that an order stands for."""
    image = F.struct(*[c.alias(name) for name, c in row.items()])
    return [
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.struct(F.lit(table).alias("table"), F.col("o_orderkey").alias("lsn")).alias("source"),
    ]


def _op_of_order(n: int) -> Column:
    turn = F.col("o_orderkey") % n
    return F.when(turn == 0, "d").when(turn == 1, "c").otherwise("u")


def supplier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change of a supplier per order; 150 suppliers, some unknown before."""
    order, key, at = F.col("o_orderkey"), F.col("o_custkey") % 150, F.col("o_orderdate").cast("timestamp")
    row = {
        "supplier_id": numbered_id("SUPP_", key + 1, 5),
        "supplier_name": F.concat(F.lit("Supplier "), key.cast("string")),
        "part_id": numbered_id("PART_", order % 2000, 5),
        "avg_lead_time_days": (3 + order % 28).cast("int"),
        "unit_cost": ((50 + order % 24950) / 100.0).cast("decimal(10,2)"),
        "is_active": order % 13 != 0,
        "created_at": F.lit("2023-01-01 00:00:00").cast("timestamp"),
        "updated_at": at,
    }
    return _orders(spark, sf_dir).select(*_change("suppliers", row, _op_of_order(7)))


def _inventory_row() -> dict[str, Column]:
    order, key, at = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("timestamp")
    status = F.col("o_orderstatus")
    return {
        "id": key % 300,
        "part_id": numbered_id("PART_", key % 40, 5),
        "supplier_id": numbered_id("SUPP_", key % 100 + 1, 5),
        "warehouse_id": choose(WAREHOUSES, key % 5 + 1),
        "stock_level": (order % 500).cast("int"),
        "transit_status": F.when(status == "O", "IN_TRANSIT").when(status == "P", "DELAYED").otherwise("DELIVERED"),
        "reorder_point": (80 + order % 121).cast("int"),
        "safety_stock": (40 + order % 61).cast("int"),
        "snapshot_date": at,
        "updated_at": at,
    }


def inventory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 400 orders as rows of inventory, by a surrogate key."""
    row = _inventory_row() | {"id": F.col("o_orderkey")}
    return _orders(spark, sf_dir).filter("o_orderkey < 400").select(*[c.alias(n) for n, c in row.items()])


def inventory_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change of an inventory row per order."""
    return _orders(spark, sf_dir).select(*_change("inventory_levels", _inventory_row(), _op_of_order(9)))


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of all three tables as lines of one feed."""

    def lines(feed: DataFrame) -> DataFrame:
        envelope = F.struct(F.struct(*feed.columns).alias("payload"))
        as_text = {"timestampFormat": ISO_MICROS}
        # decimals travel as text
        typed = [f.name for f in feed.schema["after"].dataType if f.dataType.typeName() == "decimal"]
        for side in ("before", "after"):
            for name in typed:
                image = F.col(side).withField(name, F.col(f"{side}.{name}").cast("string"))
                feed = feed.withColumn(side, F.when(F.col(side).isNotNull(), image))
        return feed.select(F.to_json(envelope, as_text).alias("value"))

    feeds = (machine_changes, supplier_changes, inventory_changes)
    first, *others = [lines(feed(spark, sf_dir)) for feed in feeds]
    for other in others:
        first = first.unionByName(other)
    return first


def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five sends per event; a send fails while its number is below
    ``event_id % 7``."""
    fails = F.col("event_id") % 7
    sends = F.greatest(F.least(fails, F.lit(5)), F.lit(1))
    attempts = F.sequence(F.lit(1).cast("bigint"), sends)
    rows = events(spark, sf_dir).select(
        F.col("event_id").alias("record_id"), fails.alias("fails"), F.explode(attempts).alias("attempt")
    )
    error = F.when(F.col("attempt") < F.col("fails"), THROTTLED)
    return rows.select("record_id", F.col("attempt").cast("int").alias("attempt"), error.alias("error_code"))
