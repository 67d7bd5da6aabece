"""The registered queries in plain SQL over the same tables.

Written independently of the operators: ordered results use whole-group windows
and joins, which is fine for a comparison and not for large data.
"""

from __future__ import annotations


def _date(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column.split('.')[-1]}"


def _time(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column.split('.')[-1]}"


def _round(value: str, digits: int = 6) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def _padded(prefix: str, number: str, digits: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest({digits}, length({text})) AS INT), '0')"


def _choose(options: tuple[str, ...], position: str) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"list_extract([{listed}], CAST({position} AS INT))"


PLANTS = ("PLANT_MX_01", "PLANT_DE_02", "PLANT_CN_03", "PLANT_IN_04", "PLANT_US_05")
TYPES = (
    "INJECTION_MOLDER",
    "CRIMPING_PRESS",
    "ASSEMBLY_ROBOT",
    "QUALITY_SCANNER",
    "CONVEYOR_SYSTEM",
)
ERRORS = ("E001_OVERHEAT", "E002_VIBRATION", "E003_PRESSURE", "E004_BEARING_WEAR")
WAREHOUSES = ("WH_MX_01", "WH_DE_02", "WH_US_03", "WH_CN_04", "WH_IN_05")

MACHINE_ID = _padded("MCH_", "user_id % 50 + 1", 4)
PLANT_ID = _choose(PLANTS, "user_id % 5 + 1")

TELEMETRY_SELECT = f"""
SELECT event_id, event_type, value, props,
  CASE WHEN event_id % 101 <> 0 THEN {MACHINE_ID} END AS machine_id,
  {PLANT_ID} AS plant_id,
  ts AS event_timestamp,
  CASE WHEN event_id % 89 <> 0 THEN floor(5500 + value * 50) / CAST(100 AS DOUBLE) END
    AS temperature_celsius,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 83 = 0 THEN CAST(-1 AS DOUBLE)
    ELSE floor(2500 + (event_id % 35) * 100 + value * 40) / CAST(100 AS DOUBLE) END
    AS vibration_hz,
  CASE WHEN event_id % 61 <> 0 THEN (280 + event_id % 521) / CAST(100 AS DOUBLE) END
    AS pressure_bar,
  CASE event_type WHEN 'error' THEN 'FAULT' WHEN 'view' THEN 'IDLE'
    WHEN 'signup' THEN 'MAINTENANCE' ELSE 'RUNNING' END AS operational_status,
  CASE WHEN event_type = 'error' THEN {_choose(ERRORS, "event_id % 4 + 1")} END AS error_code,
  (14000 + event_id % 2001) / CAST(10 AS DOUBLE) AS rpm,
  (1000 + event_id % 501) / CAST(100 AS DOUBLE) AS power_consumption_kw,
  CAST(ts AS DATE) AS event_date
"""

GATE = """machine_id IS NOT NULL AND plant_id IS NOT NULL AND event_timestamp IS NOT NULL
  AND temperature_celsius > 0 AND temperature_celsius < 200
  AND vibration_hz > 0 AND vibration_hz < 500"""

FLAGS = """temperature_celsius > 95 AS is_overheating, vibration_hz > 80 AS is_vibration_anomaly,
  operational_status = 'FAULT' AS is_fault_event, CAST(hour(event_timestamp) AS INT) AS event_hour"""

READINGS = f"WITH readings AS ({TELEMETRY_SELECT} FROM events)"
RESENT = (
    f"WITH readings AS ({TELEMETRY_SELECT} FROM events UNION ALL "
    f"{TELEMETRY_SELECT} FROM events WHERE event_type = 'purchase')"
)
SILVER_CTE = f", silver AS (SELECT *, {FLAGS} FROM readings WHERE {GATE})"


def _risk(faults: str, overheats: str, vibrations: str, readings: str) -> str:
    return f"""least(CAST(1 AS DOUBLE),
    (({faults}) * CAST(0.4 AS DOUBLE) + ({overheats}) * CAST(0.3 AS DOUBLE)
     + ({vibrations}) * CAST(0.3 AS DOUBLE)) / greatest({readings}, 1))"""


GOLD_CTE = f""", days AS (
  SELECT machine_id, plant_id, event_date,
    avg(temperature_celsius) AS avg_temp_24h,
    max(temperature_celsius) AS max_temp_24h,
    stddev_samp(temperature_celsius) AS temp_stddev_24h,
    avg(vibration_hz) AS avg_vibration_24h,
    max(vibration_hz) AS max_vibration_24h,
    avg(pressure_bar) AS avg_pressure_24h,
    CAST(sum(CAST(is_fault_event AS INT)) AS BIGINT) AS fault_event_count_24h,
    CAST(sum(CAST(is_overheating AS INT)) AS BIGINT) AS overheat_count_24h,
    CAST(sum(CAST(is_vibration_anomaly AS INT)) AS BIGINT) AS vibration_anomaly_count_24h,
    count(error_code) AS error_code_count_24h,
    count(*) AS total_readings_24h
  FROM silver GROUP BY ALL),
gold AS (SELECT *, {_risk("fault_event_count_24h", "overheat_count_24h",
                          "vibration_anomaly_count_24h", "total_readings_24h")} AS risk_score
  FROM days)"""

SILVER = READINGS + SILVER_CTE
GOLD = SILVER + GOLD_CTE

# silver without the readings of one day and of one plant's hour
SILVER_LEFT = f"""{READINGS}, silver AS (SELECT *, {FLAGS} FROM readings WHERE {GATE}
  AND event_date <> DATE '2024-01-05'
  AND NOT (plant_id = 'PLANT_DE_02' AND hour(event_timestamp) = 7))"""

SENSORS = """temperature_celsius, vibration_hz, pressure_bar, operational_status, error_code,
  rpm, power_consumption_kw"""
BRONZE_OUT = f"machine_id, plant_id, {_time('event_timestamp')}, {SENSORS}, {_date('event_date')}"
SILVER_OUT = f"{BRONZE_OUT}, is_overheating, is_vibration_anomaly, is_fault_event, event_hour"

# silver against a copy with an hour lost, a reading's hour nudged and a day doubled
TAMPERED = f"""{SILVER}, one AS (SELECT machine_id, plant_id, event_timestamp, {SENSORS}, event_date,
    is_overheating, is_vibration_anomaly, is_fault_event, event_hour FROM silver),
  other AS (SELECT * REPLACE (temperature_celsius + CASE WHEN plant_id = 'PLANT_US_05'
      AND event_date = DATE '2024-01-09' AND event_hour = 3 THEN 1 ELSE 0 END AS temperature_celsius)
    FROM one WHERE NOT (plant_id = 'PLANT_CN_03' AND event_date = DATE '2024-01-04' AND event_hour = 9)
    UNION ALL SELECT * FROM one WHERE plant_id = 'PLANT_MX_01' AND event_date = DATE '2024-01-02'),
  apart AS (SELECT *, 1 AS surplus FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM other)
    UNION ALL SELECT *, -1 FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM one))"""

COUNTS = """fault_event_count_24h, overheat_count_24h, vibration_anomaly_count_24h,
  total_readings_24h"""
GOLD_OUT = f"""machine_id, plant_id, {_date("event_date")},
  {_round("avg_temp_24h")} AS avg_temp_24h, max_temp_24h,
  {_round("temp_stddev_24h")} AS temp_stddev_24h,
  {_round("avg_vibration_24h")} AS avg_vibration_24h, max_vibration_24h,
  {_round("avg_pressure_24h")} AS avg_pressure_24h,
  {COUNTS}, error_code_count_24h, risk_score"""

BY_RISK = "ORDER BY risk_score DESC, machine_id, plant_id, event_date"
BOARD = f"""SELECT machine_id, plant_id, risk_score, fault_event_count_24h, overheat_count_24h,
    vibration_anomaly_count_24h, avg_temp_24h, max_temp_24h, {_date("event_date")}
  FROM (SELECT machine_id, plant_id, event_date, fault_event_count_24h, overheat_count_24h,
      vibration_anomaly_count_24h, {_round("risk_score", 4)} AS risk_score,
      {_round("avg_temp_24h", 1)} AS avg_temp_24h, {_round("max_temp_24h", 1)} AS max_temp_24h
    FROM gold {BY_RISK} LIMIT 10)"""
PLANT_SUMMARY = f"""SELECT plant_id, count(DISTINCT machine_id) AS total_machines,
    {_round("avg(risk_score)", 4)} AS avg_plant_risk_score,
    CAST(sum(fault_event_count_24h) AS BIGINT) AS total_faults_24h,
    CAST(sum(overheat_count_24h) AS BIGINT) AS total_overheats_24h
  FROM gold GROUP BY plant_id"""
KPI = f"""SELECT count(CASE WHEN risk_score > CAST(0.30 AS DOUBLE) THEN 1 END)
      AS high_risk_machine_count,
    count(CASE WHEN risk_score <= CAST(0.30 AS DOUBLE) THEN 1 END) AS healthy_machine_count,
    {_round("max(risk_score)", 4)} AS peak_risk_score"""


def _window_measures(suffix: str, over: str = "") -> str:
    """The measures of a window; ``over`` turns the aggregates into window functions."""

    def total(flag: str) -> str:
        return f"CAST(sum(CAST({flag} AS INT)){over} AS BIGINT)"

    faults, overheats, vibrations = map(
        total, ("is_fault_event", "is_overheating", "is_vibration_anomaly")
    )
    return f"""count(*){over} AS total_readings_{suffix},
    {faults} AS fault_event_count_{suffix}, {overheats} AS overheat_count_{suffix},
    {vibrations} AS vibration_anomaly_count_{suffix},
    {_round(f"avg(temperature_celsius){over}")} AS avg_temp_{suffix},
    max(temperature_celsius){over} AS max_temp_{suffix},
    {_round(f"avg(vibration_hz){over}")} AS avg_vibration_{suffix},
    max(vibration_hz){over} AS max_vibration_{suffix},
    {_risk(faults, overheats, vibrations, f"count(*){over}")} AS risk_score_{suffix}"""


TRAILING_OVER = """ OVER (PARTITION BY machine_id, plant_id ORDER BY event_timestamp
      RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)"""
TRAILING = f"""SELECT DISTINCT machine_id, plant_id, {_time("event_timestamp")},
    {_window_measures("trailing", TRAILING_OVER)} FROM silver"""
TRAILING_READINGS = f"""SELECT machine_id, plant_id, {_time("event_timestamp")},
    temperature_celsius, rpm, vibration_hz, {_window_measures("trailing", TRAILING_OVER)}
  FROM silver"""
SLIDING_CTE = f""", windows AS (SELECT machine_id, plant_id, window_start,
      window_start + INTERVAL 24 HOURS AS window_end, {_window_measures("sliding")}
    FROM (SELECT *, date_trunc('hour', event_timestamp) - to_hours(CAST(back AS INT))
            AS window_start
          FROM silver, unnest(generate_series(0, 23)) AS backs(back))
    GROUP BY machine_id, plant_id, window_start)"""
SLIDING = f"""SELECT * REPLACE (strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
    strftime(window_end, '%Y-%m-%d %H:%M:%S.%f') AS window_end) FROM windows"""

SESSION_CTE = """, faults AS (SELECT *, lag(event_timestamp) OVER by_time AS previous
    FROM silver WHERE is_fault_event
    WINDOW by_time AS (PARTITION BY machine_id, plant_id ORDER BY event_timestamp)),
  marked AS (SELECT *, sum(CASE WHEN previous IS NULL
        OR event_timestamp - previous >= INTERVAL 30 MINUTES THEN 1 ELSE 0 END)
      OVER (PARTITION BY machine_id, plant_id ORDER BY event_timestamp) AS session
    FROM faults),
  sessions AS (SELECT machine_id, plant_id, min(event_timestamp) AS session_start,
      max(event_timestamp) + INTERVAL 30 MINUTES AS session_end,
      count(*) AS faults, max(temperature_celsius) AS max_temp
    FROM marked GROUP BY machine_id, plant_id, session)"""
SESSIONS = f"""SELECT machine_id, plant_id, {_time("session_start")}, {_time("session_end")},
    faults, max_temp FROM sessions"""

MACHINES = f"""machines AS (SELECT DISTINCT {MACHINE_ID} AS machine_id, {PLANT_ID} AS plant_id,
    {_choose(TYPES, "(user_id % 50) % 3 + 1")} AS machine_type,
    TIMESTAMP '2023-01-01 00:00:00' AS installed_at,
    (600 + (user_id % 50) * 4) / CAST(10 AS DOUBLE) AS baseline_temp_c,
    (450 + (user_id % 50) * 4) / CAST(10 AS DOUBLE) AS baseline_vibration_hz,
    user_id % 50 <> 13 AS is_active,
    TIMESTAMP '2023-01-01 00:00:00' AS created_at, TIMESTAMP '2023-01-01 00:00:00' AS updated_at
  FROM events)"""
FEED = f"""feed AS (SELECT {MACHINE_ID} AS machine_id, {PLANT_ID} AS plant_id,
    {_choose(TYPES, "event_id % 5 + 1")} AS machine_type,
    TIMESTAMP '2023-01-01 00:00:00' AS installed_at,
    floor(6000 + value * 10) / CAST(100 AS DOUBLE) AS baseline_temp_c,
    (450 + (user_id % 50) * 4) / CAST(10 AS DOUBLE) AS baseline_vibration_hz,
    user_id % 50 <> 13 AS is_active,
    TIMESTAMP '2023-01-01 00:00:00' AS created_at, ts AS updated_at,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
    epoch_us(ts) // 1000 AS ts_ms, event_id AS lsn FROM events)"""
MACHINE_OUT = f"""machine_id, plant_id, machine_type, {_time("installed_at")}, baseline_temp_c,
    baseline_vibration_hz, is_active, {_time("created_at")}, {_time("updated_at")}"""
AFTER_CHANGES = f"""{FEED}, {MACHINES},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY ts_ms DESC, lsn DESC)
      AS newest FROM feed),
  current_machines AS (
    SELECT machine_id, plant_id, machine_type, installed_at, baseline_temp_c,
      baseline_vibration_hz, is_active, created_at, updated_at
    FROM ranked WHERE newest = 1 AND op <> 'd'
    UNION ALL
    SELECT m.* FROM machines m WHERE m.machine_id NOT IN (SELECT machine_id FROM feed))"""


def _deleted_as_null(name: str) -> str:
    return f"CASE WHEN op <> 'd' THEN {name} END AS {name}"


SUPPLIERS = f"""suppliers AS (SELECT {_padded("SUPP_", "s_suppkey + 1", 5)} AS supplier_id,
    s_name AS supplier_name, {_padded("PART_", "s_suppkey * 7 % 2000", 5)} AS part_id,
    CAST(3 + s_suppkey % 28 AS INT) AS avg_lead_time_days,
    CAST((50 + s_suppkey * 37 % 24950) / CAST(100 AS DOUBLE) AS DECIMAL(10,2)) AS unit_cost,
    true AS is_active FROM supplier)"""
INVENTORY = f"""inventory AS (SELECT {_padded("PART_", "l_partkey", 5)} AS part_id,
    CASE WHEN l_orderkey % 211 = 0 THEN 'SUPP_99999'
      ELSE {_padded("SUPP_", "l_suppkey + 1", 5)} END AS supplier_id,
    {_choose(WAREHOUSES, "l_linenumber % 5 + 1")} AS warehouse_id,
    CAST(l_quantity * 6 AS INT) AS stock_level,
    CASE WHEN l_returnflag = 'A' THEN 'IN_TRANSIT' WHEN l_returnflag = 'R' THEN 'DELAYED'
      WHEN l_linestatus = 'F' THEN 'DELIVERED' ELSE 'AT_WAREHOUSE' END AS transit_status,
    CAST(80 + l_orderkey % 121 AS INT) AS reorder_point,
    CAST(40 + l_orderkey % 61 AS INT) AS safety_stock,
    l_shipdate AS snapshot_date FROM lineitem)"""
INVENTORY_OUT = f"""part_id, supplier_id, warehouse_id, stock_level, transit_status,
    reorder_point, safety_stock, {_time("snapshot_date")}"""

def _op_of_order(n: int) -> str:
    return f"CASE o_orderkey % {n} WHEN 0 THEN 'd' WHEN 1 THEN 'c' ELSE 'u' END AS op"


SUPPLIER_FEED = f"""supplier_feed AS (SELECT {_padded("SUPP_", "o_custkey % 150 + 1", 5)} AS supplier_id,
    'Supplier ' || (o_custkey % 150) AS supplier_name, {_padded("PART_", "o_orderkey % 2000", 5)} AS part_id,
    CAST(3 + o_orderkey % 28 AS INT) AS avg_lead_time_days,
    CAST((50 + o_orderkey % 24950) / CAST(100 AS DOUBLE) AS DECIMAL(10,2)) AS unit_cost,
    o_orderkey % 13 <> 0 AS is_active, {_op_of_order(7)},
    epoch_us(o_orderdate) // 1000 AS ts_ms, o_orderkey AS lsn FROM orders)"""
INVENTORY_FEED = f"""inventory_feed AS (SELECT o_custkey % 300 AS id,
    {_padded("PART_", "o_custkey % 40", 5)} AS part_id,
    {_padded("SUPP_", "o_custkey % 100 + 1", 5)} AS supplier_id,
    {_choose(WAREHOUSES, "o_custkey % 5 + 1")} AS warehouse_id, CAST(o_orderkey % 500 AS INT) AS stock_level,
    CASE o_orderstatus WHEN 'O' THEN 'IN_TRANSIT' WHEN 'P' THEN 'DELAYED' ELSE 'DELIVERED' END AS transit_status,
    CAST(80 + o_orderkey % 121 AS INT) AS reorder_point, CAST(40 + o_orderkey % 61 AS INT) AS safety_stock,
    o_orderdate AS snapshot_date, o_orderdate AS updated_at, {_op_of_order(9)},
    epoch_us(o_orderdate) // 1000 AS ts_ms, o_orderkey AS lsn FROM orders)"""
INVENTORY_ROW_OUT = f"""id, part_id, supplier_id, warehouse_id, stock_level, transit_status, reorder_point,
    safety_stock, {_time("snapshot_date")}, {_time("updated_at")}"""

THROTTLED = "ProvisionedThroughputExceededException"
OUTCOMES = f"""WITH outcomes AS (SELECT event_id AS record_id, CAST(attempt AS INT) AS attempt,
    CASE WHEN attempt < event_id % 7 THEN '{THROTTLED}' END AS error_code
  FROM events, unnest(generate_series(1, 5)) AS attempts(attempt)
  WHERE attempt <= greatest(least(event_id % 7, 5), 1))"""


def _reasons() -> str:
    rules = {
        "machine_id_missing": "machine_id IS NULL",
        "plant_id_missing": "plant_id IS NULL",
        "timestamp_missing": "event_timestamp IS NULL",
        "temperature_missing": "temperature_celsius IS NULL",
        "temperature_out_of_range": "temperature_celsius <= 0 OR temperature_celsius >= 200",
        "vibration_missing": "vibration_hz IS NULL",
        "vibration_out_of_range": "vibration_hz <= 0 OR vibration_hz >= 500",
    }
    named = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules.items())
    return f"concat_ws(',', {named})"


def _not_null(columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT machine_id, plant_id, {_time('event_timestamp')}, 'not_null:{c}' AS rule "
        f"FROM readings WHERE {c} IS NULL"
        for c in columns
    )


REJECTED = f"NOT coalesce({GATE}, false)"
FAULTY = f"""{RESENT}, placed AS (SELECT *,
    CASE WHEN NOT coalesce({GATE}, false) THEN 0
      WHEN plant_id = 'PLANT_CN_03' AND event_date = DATE '2024-01-04' AND hour(event_timestamp) = 9 THEN 0
      WHEN plant_id = 'PLANT_MX_01' AND event_date = DATE '2024-01-02' THEN 2 ELSE 1 END AS in_silver,
    CASE WHEN coalesce({GATE}, false) OR event_date IS NOT DISTINCT FROM DATE '2024-01-07'
      THEN 0 ELSE 1 END AS in_quarantine
    FROM readings)"""
WITHOUT_RESENDS = f"""{RESENT} SELECT machine_id, plant_id,
      {_time("event_timestamp")}, {SENSORS} FROM (SELECT *, row_number() OVER (
        PARTITION BY machine_id, event_timestamp ORDER BY event_id) AS copy FROM readings)
      WHERE copy = 1 OR machine_id IS NULL OR event_timestamp IS NULL"""
WATERMARK = "(SELECT max(event_timestamp) - INTERVAL 1 HOUR FROM {0})"

ORACLE_SQL: dict[str, str] = {
    # Bronze and the quality gate
    "telemetry_typed": f"{READINGS} SELECT {BRONZE_OUT} FROM readings",
    "gate_valid": f"{READINGS} SELECT {BRONZE_OUT} FROM readings WHERE {GATE}",
    "quarantine_distinct": f"{RESENT} SELECT DISTINCT {BRONZE_OUT} FROM readings WHERE {REJECTED}",
    "quarantine_all": f"{RESENT} SELECT {BRONZE_OUT} FROM readings WHERE {REJECTED}",
    "quarantine_count": f"""{RESENT}, rejected AS (SELECT * FROM readings WHERE {REJECTED})
      SELECT (SELECT count(*) FROM rejected) AS rejected_rows,
        (SELECT count(*) FROM (SELECT DISTINCT {BRONZE_OUT} FROM rejected)) AS rejected_distinct""",
    "quarantine_written": f"""{READINGS} SELECT run_id, plant_id, count(*) AS rejected_rows
      FROM readings, (VALUES ('run_a'), ('run_b')) AS runs(run_id)
      WHERE {REJECTED} GROUP BY run_id, plant_id""",
    "reject_reasons": f"""{READINGS} SELECT machine_id, plant_id, {_time("event_timestamp")},
      {_reasons()} AS reject_reasons FROM readings WHERE {REJECTED}""",
    "resends_dropped": f"""{RESENT} SELECT {BRONZE_OUT} FROM (SELECT *, row_number() OVER (
        PARTITION BY machine_id, event_timestamp ORDER BY event_id) AS copy FROM readings)
      WHERE copy = 1 OR machine_id IS NULL OR event_timestamp IS NULL""",
    "defaults_applied": f"""WITH {INVENTORY} SELECT * REPLACE (
        CASE WHEN transit_status = 'DELAYED' THEN reorder_point ELSE 100 END AS reorder_point,
        CASE WHEN transit_status = 'DELAYED' THEN safety_stock ELSE 50 END AS safety_stock,
        CASE WHEN transit_status = 'DELAYED' THEN transit_status ELSE 'AT_WAREHOUSE' END
          AS transit_status,
        strftime(snapshot_date, '%Y-%m-%d %H:%M:%S.%f') AS snapshot_date) FROM inventory""",
    # JSON in and out
    "json_round_trip": f"{READINGS} SELECT {BRONZE_OUT}, true AS _source_file FROM readings",
    "corrupt_lines": """SELECT event_id, event_type, event_type = 'error' AS is_corrupt
      FROM events""",
    "landing_kept": f"""{READINGS}, kept AS (SELECT *, event_type = 'error' AS damaged FROM readings)
      SELECT 'bronze' AS kind, count(*) AS n FROM kept
      UNION ALL SELECT 'bronze_damaged', count(*) FROM kept WHERE damaged
      UNION ALL SELECT 'bronze_rescued', count(*) FROM kept WHERE NOT damaged
      UNION ALL SELECT 'quarantine', count(*) FROM kept WHERE damaged OR {REJECTED}
      UNION ALL SELECT 'quarantine_damaged', count(*) FROM kept WHERE damaged
      UNION ALL SELECT 'silver', count(*) FROM kept WHERE NOT damaged AND {GATE}""",
    "drift_rescue": """SELECT event_id,
      CAST(json_extract_string(props, '$.k') AS INT) AS firmware_k FROM events""",
    "drifted_batches_merged": f"""{READINGS} SELECT event_id, machine_id, plant_id,
      CASE WHEN event_type = 'view' THEN value END AS signal FROM readings""",
    "scalar_functions": f"""SELECT event_id,
      {_padded("SUPP_", "event_id % 1000 + 1", 3)} AS padded_id,
      printf('MCH_%04d', event_id % 50 + 1) AS formatted_id,
      CASE WHEN event_id % 7 BETWEEN 1 AND 5 THEN {_choose(PLANTS, "event_id % 7")} END
        AS plant_or_null,
      strftime(ts - to_seconds(event_id * 15), '%Y-%m-%d %H:%M:%S.%f') AS moved_back,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso_text,
      strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INT) AS hour_of_day,
      TRY_CAST(event_type AS DOUBLE) AS not_a_number, CAST(event_id AS INT) AS cast_back,
      CAST(event_type = 'error' AS INT) AS error_as_int,
      {_round("value", 1)} AS rounded_value,
      least(value, NULL, CAST(50 AS DOUBLE)) AS at_most_fifty,
      greatest(value, CAST(1 AS DOUBLE)) AS at_least_one,
      CASE WHEN value > 10 THEN value - 10 END AS above_ten FROM events""",
    "source_resolved": f"{READINGS} SELECT {BRONZE_OUT} FROM readings",
    "reference_loaded": f"WITH {MACHINES} SELECT {MACHINE_OUT} FROM machines",
    # Silver and gold
    "silver_flags": f"{SILVER} SELECT {SILVER_OUT} FROM silver",
    "partition_pruned": f"""{SILVER} SELECT plant_id, {_date("event_date")}, readings, avg_temp,
        avg_vibration FROM (SELECT plant_id, event_date, count(*) AS readings,
          {_round("avg(temperature_celsius)")} AS avg_temp,
          {_round("avg(vibration_hz)")} AS avg_vibration
        FROM silver WHERE plant_id = 'PLANT_DE_02'
          AND event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-10'
        GROUP BY plant_id, event_date)""",
    "gold_full": f"{GOLD} SELECT {GOLD_OUT} FROM gold",
    "gold_compact": f"""{GOLD} SELECT machine_id, plant_id, {_date("event_date")},
      {_round("avg_temp_24h")} AS avg_temp_24h, max_temp_24h,
      {_round("avg_vibration_24h")} AS avg_vibration_24h, max_vibration_24h, {COUNTS},
      risk_score FROM gold""",
    "risk_score": f"""{GOLD} SELECT machine_id, plant_id, {_date("event_date")}, risk_score
      FROM gold""",
    "gold_incremental": f"{GOLD} SELECT {GOLD_OUT} FROM gold",
    "gold_versioned_refresh": f"{GOLD} SELECT {GOLD_OUT} FROM gold WHERE event_date <> DATE '2024-01-05'",
    "gold_merged_states": f"""{SILVER_LEFT}{GOLD_CTE} SELECT {GOLD_OUT} FROM gold""",
    "machines_seen_sketched": f"""{SILVER} SELECT plant_id,
      strftime(date_trunc('week', event_date), '%Y-%m-%d') AS week,
      count(DISTINCT machine_id) AS machines, TRUE AS sketch_agrees FROM silver GROUP BY 1, 2""",
    "incremental_run": f"{GOLD} SELECT {GOLD_OUT} FROM gold",
    "versions_survive_failure": f"""{GOLD}, seen AS (
        SELECT 'after failure' AS seen, * FROM gold WHERE event_date < DATE '2024-01-11'
        UNION ALL SELECT 'after commit', * FROM gold)
      SELECT seen, plant_id, count(*) AS machine_days, {_round("sum(risk_score)")} AS risk_score_sum
      FROM seen GROUP BY seen, plant_id""",
    "risk_rollup": f"""{GOLD} SELECT plant_id, machine_id,
      CAST(grouping(plant_id, machine_id) AS INT) AS level, count(*) AS machine_days,
      {_round("avg(risk_score)")} AS avg_risk_score, max(risk_score) AS peak_risk_score,
      CAST(sum(fault_event_count_24h) AS BIGINT) AS total_faults
      FROM gold GROUP BY ROLLUP (plant_id, machine_id)""",
    "hourly_profile": f"""{SILVER} SELECT plant_id, event_hour, count(*) AS readings,
      {_round("avg(temperature_celsius)")} AS avg_temp,
      {_round("avg(vibration_hz)")} AS avg_vibration,
      CAST(sum(CAST(is_fault_event AS INT)) AS BIGINT) AS faults,
      CAST(sum(CAST(is_overheating AS INT)) AS BIGINT) AS overheats
      FROM silver GROUP BY plant_id, event_hour""",
    "missing_days": f"""{GOLD}, spine AS (SELECT machine_id, plant_id, CAST(day AS DATE) AS event_date
        FROM (SELECT DISTINCT machine_id, plant_id FROM gold),
          (SELECT unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS day
           FROM gold))
      SELECT s.machine_id, s.plant_id, {_date("s.event_date")},
        coalesce(g.total_readings_24h, 0) AS total_readings_24h, g.risk_score,
        g.total_readings_24h IS NULL AS is_silent
      FROM spine s LEFT JOIN gold g USING (machine_id, plant_id, event_date)""",
    "silent_spells": f"""{GOLD}, silent AS (SELECT *, event_date - CAST(row_number() OVER (
          PARTITION BY machine_id, plant_id ORDER BY event_date) AS INT) AS island
        FROM (SELECT machine_id, plant_id, CAST(day AS DATE) AS event_date
          FROM (SELECT DISTINCT machine_id, plant_id FROM gold),
            (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-15', INTERVAL 1 DAY)) AS day))
        ANTI JOIN gold USING (machine_id, plant_id, event_date))
      SELECT machine_id, plant_id, strftime(min(event_date), '%Y-%m-%d') AS silent_from,
        strftime(max(event_date), '%Y-%m-%d') AS silent_to, count(*) AS silent_days
      FROM silent GROUP BY machine_id, plant_id, island""",
    "silent_dates": f"""{GOLD}, spine AS (SELECT machine_id, plant_id, CAST(unnest(generate_series(
          DATE '2024-01-01', DATE '2024-02-15', INTERVAL 1 DAY)) AS DATE) AS event_date
        FROM (SELECT DISTINCT machine_id, plant_id FROM gold WHERE plant_id = 'PLANT_DE_02'))
      SELECT machine_id, plant_id, {_date("event_date")}
      FROM (SELECT * FROM spine ANTI JOIN gold USING (machine_id, plant_id, event_date))""",
    # Dashboards
    "leaderboard_top10": f"{GOLD} {BOARD}",
    "leaderboard_top10_raw": f"""{GOLD}, best AS (SELECT * FROM gold {BY_RISK} LIMIT 10)
      SELECT {GOLD_OUT} FROM best""",
    "leaderboard_top5": f"""{GOLD}, best AS (SELECT * FROM gold {BY_RISK} LIMIT 5)
      SELECT machine_id, plant_id, risk_score, fault_event_count_24h, overheat_count_24h,
        {_round("avg_temp_24h")} AS avg_temp_24h FROM best""",
    "plant_summary": f"{GOLD} {PLANT_SUMMARY}",
    "risk_kpi": f"{GOLD} {KPI} FROM gold",
    "risk_kpi_machines": f"""{GOLD} {KPI} FROM (SELECT max(risk_score) AS risk_score FROM gold
      GROUP BY machine_id, plant_id)""",
    "dashboard_sql": f"""{GOLD}, totals AS (SELECT plant_id, event_date,
        count(CASE WHEN risk_score > CAST(0.30 AS DOUBLE) THEN 1 END) AS high_risk_machines,
        max(risk_score) AS peak_risk_score,
        CAST(sum(error_code_count_24h) AS BIGINT) AS error_codes
      FROM gold GROUP BY plant_id, event_date)
      SELECT plant_id, {_date("event_date")}, high_risk_machines, peak_risk_score, error_codes
      FROM totals""",
    "rank_in_plant": f"""{GOLD} SELECT plant_id, {_date("event_date")}, machine_id, risk_score,
      rank() OVER (PARTITION BY plant_id, event_date ORDER BY risk_score DESC) AS rank_in_plant
      FROM gold""",
    "latest_reading": f"""{SILVER} SELECT machine_id, plant_id, {_time("event_timestamp")},
        temperature_celsius, vibration_hz, pressure_bar, operational_status, error_code
      FROM (SELECT *, row_number() OVER (PARTITION BY machine_id, plant_id
          ORDER BY event_timestamp DESC, temperature_celsius DESC, vibration_hz DESC) AS newest
        FROM silver) WHERE newest = 1""",
    "serving_published": f"{GOLD} {PLANT_SUMMARY}",
    # Trailing and sliding windows, sessions
    "rolling_24h": f"{SILVER} {TRAILING}",
    "rolling_24h_readings": f"{RESENT}{SILVER_CTE} {TRAILING_READINGS}",
    "sliding_24h": f"{SILVER}{SLIDING_CTE} {SLIDING}",
    "fault_sessions": f"{SILVER}{SESSION_CTE} {SESSIONS}",
    # Data quality
    "reconcile": f"""{RESENT} SELECT plant_id, {_date("event_date")}, bronze_rows, silver_rows,
        quarantined_rows, bronze_rows - silver_rows - quarantined_rows AS unaccounted_rows
      FROM (SELECT plant_id, event_date, count(*) AS bronze_rows,
          count(CASE WHEN {GATE} THEN 1 END) AS silver_rows,
          count(CASE WHEN {REJECTED} THEN 1 END) AS quarantined_rows
        FROM readings GROUP BY plant_id, event_date)""",
    "reconcile_written": f"""{FAULTY} SELECT plant_id, {_date("event_date")}, bronze_rows, silver_rows,
        quarantined_rows, bronze_rows - silver_rows - quarantined_rows AS unaccounted_rows
      FROM (SELECT plant_id, event_date, count(*) AS bronze_rows,
          CAST(sum(in_silver) AS BIGINT) AS silver_rows,
          CAST(sum(in_quarantine) AS BIGINT) AS quarantined_rows
        FROM placed GROUP BY plant_id, event_date)
      WHERE bronze_rows <> silver_rows + quarantined_rows""",
    "reconcile_written_rows": f"""{FAULTY} SELECT plant_id, machine_id, {_time("event_timestamp")},
        temperature_celsius, CAST(sum(1 - in_silver - in_quarantine) AS BIGINT) AS surplus_left
      FROM placed WHERE in_silver + in_quarantine <> 1
      GROUP BY plant_id, machine_id, placed.event_timestamp, temperature_celsius""",
    "dq_not_null": f"""{READINGS} {_not_null(("machine_id", "plant_id", "temperature_celsius",
                                             "vibration_hz", "pressure_bar"))}""",
    "dq_unique": f"""{RESENT}, keys AS (SELECT machine_id, event_timestamp,
        count(*) AS rows_with_key FROM readings GROUP BY machine_id, event_timestamp)
      SELECT machine_id, {_time("event_timestamp")}, rows_with_key FROM keys
      WHERE rows_with_key > 1""",
    "dq_accepted_values": f"""WITH {FEED} SELECT machine_id, machine_type, lsn FROM feed
      WHERE op <> 'd' AND machine_type NOT IN
        ('INJECTION_MOLDER', 'CRIMPING_PRESS', 'ASSEMBLY_ROBOT')""",
    "dq_domains": f"""{READINGS}, {INVENTORY}, failing AS (
        SELECT 'domain:operational_status' AS rule, lower(operational_status) AS value FROM readings
          WHERE minute(event_timestamp) = 13 AND operational_status IS NOT NULL
        UNION ALL SELECT 'domain:transit_status', 'LOST' FROM inventory WHERE stock_level % 50 = 0)
      SELECT rule, value, count(*) AS failures FROM failing GROUP BY rule, value""",
    "dq_failures_stored": f"""{READINGS}, {INVENTORY}, {SUPPLIERS}, failing AS (
        SELECT 'not_null:machine_id' AS rule FROM readings WHERE machine_id IS NULL
        UNION ALL SELECT 'not_null:vibration_hz' FROM readings WHERE vibration_hz IS NULL
        UNION ALL SELECT 'known_supplier' FROM inventory
          WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers))
      SELECT rule, count(*) AS failures, count(*) AS records FROM failing GROUP BY rule""",
    "fk_orphans": f"""WITH {INVENTORY}, {SUPPLIERS} SELECT {INVENTORY_OUT} FROM inventory
      WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers)""",
    "frame_differences": f"""{READINGS} SELECT machine_id, plant_id, {_time("event_timestamp")},
      temperature_celsius, count(*) AS surplus_left FROM readings WHERE event_type = 'purchase'
      GROUP BY machine_id, plant_id, readings.event_timestamp, temperature_celsius""",
    "fingerprint_parts": f"""{TAMPERED} SELECT plant_id, {_date("event_date")},
        CAST(sum(surplus) AS BIGINT) AS surplus_rows FROM apart GROUP BY plant_id, apart.event_date""",
    "fingerprint_drilldown": f"""{TAMPERED} SELECT plant_id, machine_id, {_time("event_timestamp")},
        temperature_celsius, CAST(sum(surplus) AS BIGINT) AS surplus_left
      FROM apart GROUP BY plant_id, machine_id, apart.event_timestamp, temperature_celsius""",
    # Change data and history
    "changes_flattened": f"""WITH {FEED} SELECT machine_id, {_deleted_as_null("plant_id")},
      {_deleted_as_null("machine_type")},
      CASE WHEN op <> 'd' THEN strftime(installed_at, '%Y-%m-%d %H:%M:%S.%f') END AS installed_at,
      {_deleted_as_null("baseline_temp_c")}, {_deleted_as_null("baseline_vibration_hz")},
      {_deleted_as_null("is_active")},
      CASE WHEN op <> 'd' THEN strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') END AS created_at,
      CASE WHEN op <> 'd' THEN strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') END AS updated_at,
      op, ts_ms, lsn FROM feed""",
    "apply_changes": f"WITH {AFTER_CHANGES} SELECT {MACHINE_OUT} FROM current_machines",
    "apply_changes_suppliers": f"""WITH {SUPPLIER_FEED}, {SUPPLIERS}, ranked AS (SELECT *, row_number() OVER (
          PARTITION BY supplier_id ORDER BY ts_ms DESC, lsn DESC) AS newest FROM supplier_feed)
      SELECT supplier_id, supplier_name, part_id, avg_lead_time_days, CAST(unit_cost AS DOUBLE) AS unit_cost,
        is_active FROM ranked WHERE newest = 1 AND op <> 'd'
      UNION ALL SELECT supplier_id, supplier_name, part_id, avg_lead_time_days, CAST(unit_cost AS DOUBLE),
        is_active FROM suppliers WHERE supplier_id NOT IN (SELECT supplier_id FROM supplier_feed)""",
    "apply_changes_inventory": f"""WITH {INVENTORY_FEED}, opening AS (
        SELECT * REPLACE (lsn AS id) FROM inventory_feed WHERE lsn < 400),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS newest
        FROM inventory_feed)
      SELECT {INVENTORY_ROW_OUT} FROM (SELECT * EXCLUDE (newest) FROM ranked WHERE newest = 1 AND op <> 'd'
        UNION ALL SELECT * FROM opening WHERE id NOT IN (SELECT id FROM inventory_feed))""",
    "scd2_inventory": f"""WITH {INVENTORY_FEED}, settled AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY part_id, warehouse_id, ts_ms ORDER BY lsn DESC) AS pick FROM inventory_feed)
          WHERE pick = 1),
      versions AS (SELECT *, lead(ts_ms) OVER (PARTITION BY part_id, warehouse_id ORDER BY ts_ms) AS until
        FROM settled)
      SELECT {INVENTORY_ROW_OUT},
        strftime(make_timestamp_ms(ts_ms), '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
        strftime(make_timestamp_ms(until), '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
        until IS NULL AS is_current
      FROM versions WHERE op <> 'd'""",
    "changes_merged": f"WITH {AFTER_CHANGES} SELECT {MACHINE_OUT} FROM current_machines",
    "scd2_machines": f"""WITH {FEED}, settled AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY machine_id, ts_ms ORDER BY lsn DESC) AS pick FROM feed) WHERE pick = 1),
      versions AS (SELECT *, lead(ts_ms) OVER (PARTITION BY machine_id ORDER BY ts_ms) AS until
        FROM settled)
      SELECT {MACHINE_OUT},
        strftime(make_timestamp_ms(ts_ms), '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
        strftime(make_timestamp_ms(until), '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
        until IS NULL AS is_current
      FROM versions WHERE op <> 'd'""",
    "snapshot_history": f"""WITH {AFTER_CHANGES}, history AS (
        SELECT m.*, m.updated_at AS valid_from,
          CASE WHEN c.updated_at > m.updated_at THEN c.updated_at END AS valid_to
        FROM machines m LEFT JOIN current_machines c USING (machine_id)
        UNION ALL
        SELECT c.*, c.updated_at, NULL FROM current_machines c
          LEFT JOIN machines m USING (machine_id)
        WHERE m.machine_id IS NULL OR c.updated_at > m.updated_at)
      SELECT {MACHINE_OUT}, {_time("valid_from")}, {_time("valid_to")},
        valid_to IS NULL AS is_current FROM history""",
    # Reference data
    "machine_enrich": f"""{SILVER}, {MACHINES} SELECT s.machine_id, s.plant_id,
        {_time("s.event_timestamp")}, s.temperature_celsius, m.plant_id AS registered_plant_id,
        m.machine_type, m.baseline_temp_c, m.baseline_vibration_hz, m.is_active
      FROM silver s LEFT JOIN machines m USING (machine_id)""",
    "baseline_deviation": f"""{SILVER}, {MACHINES}, means AS (SELECT machine_id,
        count(*) AS readings, avg(temperature_celsius) AS avg_temp,
        avg(vibration_hz) AS avg_vibration FROM silver GROUP BY machine_id)
      SELECT machine_id, readings, {_round("avg_temp")} AS avg_temp,
        {_round("avg_vibration")} AS avg_vibration, baseline_temp_c, baseline_vibration_hz,
        {_round("(avg_temp - baseline_temp_c) / baseline_temp_c")} AS temp_deviation,
        {_round("(avg_vibration - baseline_vibration_hz) / baseline_vibration_hz")}
          AS vibration_deviation
      FROM means JOIN machines USING (machine_id)""",
    "inventory_value": f"""WITH {INVENTORY}, {SUPPLIERS}
      SELECT i.part_id, i.supplier_id, warehouse_id, stock_level, transit_status, reorder_point,
        safety_stock, {_time("snapshot_date")}, supplier_name,
        CAST(unit_cost AS DOUBLE) AS unit_cost,
        CAST(stock_level * unit_cost AS DOUBLE) AS stock_value
      FROM inventory i JOIN suppliers s ON i.supplier_id = s.supplier_id""",
    "reorder_alerts": f"""WITH {INVENTORY} SELECT {INVENTORY_OUT},
      CASE WHEN stock_level < safety_stock THEN 'CRITICAL' ELSE 'REORDER' END AS severity,
      CASE WHEN stock_level < reorder_point THEN reorder_point ELSE safety_stock END
        - stock_level AS shortfall
      FROM inventory WHERE stock_level < reorder_point OR stock_level < safety_stock""",
    "canonical_sites": f"""WITH {MACHINES} SELECT plant_id AS site_id, machine_id AS asset_id,
      machine_type AS asset_type, is_active FROM machines""",
    "canonical_partners": f"""WITH {SUPPLIERS} SELECT supplier_id AS tpartner_id,
      supplier_name AS description, part_id AS product_id, avg_lead_time_days AS lead_time_days,
      is_active FROM suppliers""",
    "canonical_inventory": f"""WITH {INVENTORY} SELECT part_id AS product_id,
      warehouse_id AS site_id, supplier_id AS tpartner_id, stock_level AS on_hand_inventory,
      safety_stock, {_time("snapshot_date")} FROM inventory""",
    # Publishing
    "publish_batches": f"""{READINGS} SELECT event_id, machine_id, place // 500 AS batch_id,
        CAST(place % 500 AS INT) AS batch_position
      FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM readings)""",
    "key_value_payload": f"{READINGS} SELECT machine_id AS key, {BRONZE_OUT} FROM readings",
    "delivery_ledger": f"""{OUTCOMES}, records AS (SELECT record_id, max(attempt) AS attempts,
        bool_or(error_code IS NULL) AS sent FROM outcomes GROUP BY record_id)
      SELECT count(CASE WHEN sent THEN 1 END) AS sent,
        count(CASE WHEN NOT sent AND attempts > 4 THEN 1 END) AS errors,
        count(CASE WHEN NOT sent AND attempts <= 4 THEN 1 END) AS pending,
        CAST(sum(attempts) AS BIGINT) AS attempts FROM records""",
    "pending_retries": f"""{OUTCOMES}, records AS (SELECT record_id, max(attempt) AS attempts,
        bool_or(error_code IS NULL) AS sent, max(error_code) AS last_error
        FROM outcomes WHERE attempt <= 3 GROUP BY record_id)
      SELECT record_id, attempts, last_error,
        {_round("CAST(0.1 AS DOUBLE) * pow(2, attempts)")} AS backoff_seconds
      FROM records WHERE NOT sent AND attempts <= 4""",
    # Streams: appended windows are those the watermark has closed
    "stream_silver_written": f"{SILVER} SELECT {SILVER_OUT} FROM silver",
    "stream_quarantine_written": f"{READINGS} SELECT {BRONZE_OUT} FROM readings WHERE {REJECTED}",
    "stream_resends_dropped": WITHOUT_RESENDS,
    "stream_resends_days_later": WITHOUT_RESENDS,
    "stream_json_landing": f"{READINGS} SELECT {BRONZE_OUT} FROM readings",
    "daily_window": f"{GOLD} SELECT {GOLD_OUT} FROM gold",
    "stream_late_completed": f"{GOLD} SELECT {GOLD_OUT} FROM gold",
    "stream_late_rows": f"""{SILVER}, landed AS (SELECT plant_id, event_date, event_timestamp,
        CASE WHEN minute(event_timestamp) % 7 = 0 THEN 2
          ELSE least(date_diff('day', DATE '2024-01-01', event_date) // 10, 2) END AS file FROM silver),
      marks AS (SELECT a.file, max(b.event_timestamp) AS newest FROM (SELECT DISTINCT file FROM landed) a
        JOIN landed b ON b.file < a.file GROUP BY a.file)
      SELECT plant_id, {_date("event_date")}, count(*) AS late_readings FROM landed JOIN marks USING (file)
      WHERE event_timestamp < newest - INTERVAL 1 HOUR GROUP BY plant_id, landed.event_date""",
    "stream_leaderboard": f"{GOLD} {BOARD}",
    "stream_plant_machines": f"""{SILVER}, seen AS (SELECT plant_id, event_date,
        count(DISTINCT machine_id) AS machines FROM silver GROUP BY plant_id, event_date)
      SELECT plant_id, {_date("event_date")}, machines FROM seen""",
    "stream_sliding_24h": f"""{SILVER}{SLIDING_CTE} {SLIDING}
      WHERE windows.window_end <= {WATERMARK.format("silver")}""",
    "stream_fault_sessions": f"""{SILVER}{SESSION_CTE} {SESSIONS}
      WHERE sessions.session_end <= {WATERMARK.format("faults")}""",
}
ORACLE_SQL["stream_machine_enrich"] = ORACLE_SQL["machine_enrich"]
ORACLE_SQL["stream_sliding_24h_whole"] = ORACLE_SQL["sliding_24h"]
ORACLE_SQL["stream_fault_sessions_whole"] = ORACLE_SQL["fault_sessions"]
