"""Column layouts as DDL text, allowed values and defaults."""

from __future__ import annotations

# The timestamp arrives as text on purpose: a bad one must reach the gate as
# NULL instead of failing the scan.
RAW_TELEMETRY = """
    machine_id STRING, plant_id STRING, event_timestamp STRING,
    temperature_celsius DOUBLE, vibration_hz DOUBLE, pressure_bar DOUBLE,
    operational_status STRING, error_code STRING,
    rpm DOUBLE, power_consumption_kw DOUBLE
"""

RAW_TELEMETRY_COLUMNS = (
    "machine_id",
    "plant_id",
    "event_timestamp",
    "temperature_celsius",
    "vibration_hz",
    "pressure_bar",
    "operational_status",
    "error_code",
    "rpm",
    "power_consumption_kw",
)

INVENTORY_EVENT = """
    part_id STRING, supplier_id STRING, warehouse_id STRING, stock_level INT,
    transit_status STRING, snapshot_date TIMESTAMP, reorder_point INT,
    safety_stock INT, unit_cost DECIMAL(10,2)
"""

MACHINES = """
    machine_id STRING, plant_id STRING, machine_type STRING, installed_at TIMESTAMP,
    baseline_temp_c DOUBLE, baseline_vibration_hz DOUBLE, is_active BOOLEAN,
    created_at TIMESTAMP, updated_at TIMESTAMP
"""

SUPPLIERS = """
    supplier_id STRING, supplier_name STRING, part_id STRING, avg_lead_time_days INT,
    unit_cost DECIMAL(10,2), is_active BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP
"""

INVENTORY_LEVELS = """
    id BIGINT, part_id STRING, supplier_id STRING, warehouse_id STRING, stock_level INT,
    transit_status STRING, reorder_point INT, safety_stock INT,
    snapshot_date TIMESTAMP, updated_at TIMESTAMP
"""

REFERENCE_TABLES = {
    "machines": MACHINES,
    "suppliers": SUPPLIERS,
    "inventory_levels": INVENTORY_LEVELS,
}

# The allowed states of a machine and of a shipment.
OPERATIONAL_STATUSES = ("RUNNING", "IDLE", "FAULT", "MAINTENANCE")
TRANSIT_STATUSES = ("IN_TRANSIT", "AT_WAREHOUSE", "DELIVERED", "DELAYED")

TELEMETRY_DOMAINS = {"operational_status": OPERATIONAL_STATUSES}
INVENTORY_DOMAINS = {"transit_status": TRANSIT_STATUSES}

# What an absent optional field means.
TELEMETRY_DEFAULTS = {"rpm": 0.0, "power_consumption_kw": 0.0}
INVENTORY_DEFAULTS = {
    "stock_level": 0,
    "transit_status": "AT_WAREHOUSE",
    "reorder_point": 100,
    "safety_stock": 50,
    "unit_cost": "0.00",
}
REFERENCE_DEFAULTS = {"is_active": True}

MACHINE_DAY = ("machine_id", "plant_id", "event_date")
PLANT_DAY = ("plant_id", "event_date")
