"""The registered queries: every operator over the given tables.

Dates and timestamps leave as ISO text and averages rounded to six decimals, so
that a comparison does not depend on how clients show them or on the order in
which doubles were added. Load times are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch import schemas
from millwatch.functions.measures import rounded
from millwatch.functions.text import ISO_MICROS, choose, numbered_id, seconds_before
from millwatch.operators import bronze as bronze_ops
from millwatch.operators import (
    changes,
    delivery,
    fingerprints,
    gold,
    incremental,
    quality,
    reconciliation,
    reference,
    serving,
    sessions,
    sketches,
    trailing,
)
from millwatch.operators.silver import silver_from_bronze
from millwatch.plans import increments, medallion
from millwatch.sources import changes as change_feed
from millwatch.sources import sample_tables as sample
from millwatch.sources import buckets, sinks, tables, telemetry, versions
from millwatch.sources.session import shared_folder
from millwatch.sources.tables import read_path
from millwatch.streaming import late as stream_late
from millwatch.streaming import risk as stream_risk
from millwatch.streaming import seen as stream_seen
from millwatch.streaming import silver as stream_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Query] = {}

LOAD_TIMES = ("_ingested_at", "_silver_loaded_at", "_gold_loaded_at")
DAY_AVERAGES = ("avg_temp_24h", "temp_stddev_24h", "avg_vibration_24h", "avg_pressure_24h")


def comparable(df: DataFrame, round_columns: tuple[str, ...] = ()) -> DataFrame:
    """The result without load times, with dates and timestamps as text."""
    shown = []
    for field in df.drop(*LOAD_TIMES).schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif field.name in round_columns:
            value = rounded(value, 6)
        shown.append(value.alias(field.name))
    return df.select(*shown)


def query(*round_columns: str) -> Callable[[Query], Query]:
    """Register a query in comparable form, and its plain form as a builder."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir), round_columns)

        QUERIES[build.__name__] = run
        BUILDERS[build.__name__] = build
        return build

    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder for a table this query writes."""
    return f"{shared_folder(spark)}/millwatch/{name}-{uuid4().hex}"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_risk(sample.silver(spark, sf_dir))


# Bronze and the quality gate


@query()
def telemetry_typed(spark, sf_dir):
    return bronze_ops.to_bronze(sample.raw_telemetry(spark, sf_dir))


@query()
def gate_valid(spark, sf_dir):
    return quality.valid_rows(sample.bronze(spark, sf_dir))


@query()
def quarantine_distinct(spark, sf_dir):
    return quality.quarantine_distinct(sample.resent_bronze(spark, sf_dir))


@query()
def quarantine_all(spark, sf_dir):
    return quality.quarantine_all(sample.resent_bronze(spark, sf_dir))


@query()
def quarantine_count(spark, sf_dir):
    return quality.quarantine_count(sample.resent_bronze(spark, sf_dir))


@query()
def quarantine_written(spark, sf_dir):
    """The same run stored twice counts once, another run adds to it."""
    target = scratch(spark, "quarantine")
    rejected = quality.quarantine_all(sample.bronze(spark, sf_dir))
    for run_id in ("run_a", "run_a", "run_b"):
        sinks.write_quarantine(rejected, target, run_id)
    stored = read_path(spark, target, schema=rejected.schema.add("run_id", "string"))
    return stored.groupBy("run_id", "plant_id").agg(F.count(F.lit(1)).alias("rejected_rows"))


@query()
def reject_reasons(spark, sf_dir):
    rejected = quality.with_reject_reasons(sample.bronze(spark, sf_dir))
    return rejected.select(
        "machine_id",
        "plant_id",
        "event_timestamp",
        F.array_join("reject_reasons", ",").alias("reject_reasons"),
    )


@query()
def resends_dropped(spark, sf_dir):
    return bronze_ops.drop_resends(sample.resent_bronze(spark, sf_dir))


@query()
def defaults_applied(spark, sf_dir):
    """Inventory in which only delayed shipments state their own limits."""
    levels = sample.inventory_levels(spark, sf_dir)
    stated = F.col("transit_status") == "DELAYED"
    sparse = levels.withColumns(
        {
            "reorder_point": F.when(stated, F.col("reorder_point")),
            "safety_stock": F.when(stated, F.col("safety_stock")),
            "transit_status": F.when(stated, F.col("transit_status")),
        }
    )
    return bronze_ops.apply_defaults(sparse, schemas.INVENTORY_DEFAULTS)


# JSON in and out


@query()
def json_round_trip(spark, sf_dir):
    """Readings written as JSON lines and scanned again with their file."""
    path = scratch(spark, "landing")
    sinks.write_json_lines(sample.raw_telemetry(spark, sf_dir), path, rows_per_file=50_000)
    scanned = telemetry.with_source_file(telemetry.read_telemetry(spark, path))
    has_file = F.col("_source_file").isNotNull()
    return bronze_ops.to_bronze(scanned).withColumn("_source_file", has_file)


@query()
def corrupt_lines(spark, sf_dir):
    """Error events lose the end of their line; their text must be kept."""
    rows = sample.telemetry_of(sample.events(spark, sf_dir), "event_type", "event_id")
    line = F.to_json(F.struct(*schemas.RAW_TELEMETRY_COLUMNS))
    cut = F.when(F.col("event_type") == "error", F.expr("substr(line, 1, length(line) - 1)"))
    lines = rows.select("event_id", "event_type", line.alias("line")).withColumn(
        "value", F.coalesce(cut, "line")
    )
    parsed = telemetry.parse_lines(lines.select("event_id", "event_type", "value"))
    return parsed.select(
        "event_id", "event_type", F.col(telemetry.CORRUPT).isNotNull().alias("is_corrupt")
    )


@query()
def landing_kept(spark, sf_dir):
    """Lines with unknown fields, some of them damaged, through bronze and silver: nothing goes."""
    landing, lake = scratch(spark, "landing"), medallion.lake_at(scratch(spark, "lake"))
    damaged = F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id")
    kinds = sample.events(spark, sf_dir).select("event_id", "event_type")
    lines = sample.drift_lines(spark, sf_dir).select("value", damaged).join(kinds, "event_id")
    cut = F.when(F.col("event_type") == "error", F.expr("substr(value, 1, length(value) - 1)"))
    lines.select(F.coalesce(cut, "value").alias("value")).write.text(landing)
    bronze = medallion.load_bronze(spark, landing, lake)
    silver = medallion.load_silver(spark, lake, "run")
    quarantine = read_path(spark, lake.quarantine)
    counted = {
        "bronze": bronze,
        "bronze_damaged": bronze.filter(F.col(telemetry.CORRUPT).isNotNull()),
        "bronze_rescued": bronze.filter(F.col(telemetry.RESCUED).isNotNull()),
        "silver": silver,
        "quarantine": quarantine,
        "quarantine_damaged": quarantine.filter(F.col(telemetry.CORRUPT).isNotNull()),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in counted.items()]
    return reduce(DataFrame.unionByName, parts)


@query()
def drift_rescue(spark, sf_dir):
    """Unknown fields of every line, read back from the rescued object."""
    lines = sample.drift_lines(spark, sf_dir)
    rescued = telemetry.with_rescued(lines)
    field = F.from_json(telemetry.RESCUED, "firmware_k STRING, event_id STRING")
    return rescued.select(field.alias("r")).select(
        F.col("r.event_id").cast("bigint").alias("event_id"),
        F.col("r.firmware_k").cast("int").alias("firmware_k"),
    )


@query()
def drifted_batches_merged(spark, sf_dir):
    """Two batches, the later one with a new column, merged by name."""
    rows = sample.telemetry_of(sample.events(spark, sf_dir), "event_id", "event_type", "value")
    kept = ("event_id", "machine_id", "plant_id")
    early = rows.filter(F.col("event_type") != "view").select(*kept)
    late = rows.filter(F.col("event_type") == "view").select(*kept, F.col("value").alias("signal"))
    return bronze_ops.merge_batches(early, late)


@query()
def scalar_functions(spark, sf_dir):
    """The scalar functions of the model, over all events."""
    at, value = F.col("event_id"), F.col("value")
    moment = F.col("ts").cast("timestamp")
    return sample.events(spark, sf_dir).select(
        "event_id",
        numbered_id("SUPP_", at % 1000 + 1, 3).alias("padded_id"),
        F.format_string("MCH_%04d", at % 50 + 1).alias("formatted_id"),
        choose(sample.PLANTS, at % 7).alias("plant_or_null"),
        seconds_before(moment, at * 15).alias("moved_back"),
        F.date_format(moment, ISO_MICROS).alias("iso_text"),
        F.to_date(moment).alias("day"),
        F.hour(moment).alias("hour_of_day"),
        F.col("event_type").try_cast("double").alias("not_a_number"),
        at.cast("string").cast("int").alias("cast_back"),
        (F.col("event_type") == "error").cast("int").alias("error_as_int"),
        rounded(value, 1).alias("rounded_value"),
        F.least(value, F.lit(None).cast("double"), F.lit(50.0)).alias("at_most_fifty"),
        F.greatest(value, F.lit(1.0)).alias("at_least_one"),
        F.when(value > 10, value - 10).alias("above_ten"),
    )


@query()
def source_resolved(spark, sf_dir):
    """Bronze found by path where the catalog has no such table."""
    path = scratch(spark, "bronze")
    sinks.write_table(sample.bronze(spark, sf_dir), path)
    return tables.require_rows(tables.resolve_source(spark, "no_such_bronze_table", path))


@query()
def reference_loaded(spark, sf_dir):
    """Machines loaded twice, read with the declared layout."""
    path = scratch(spark, "machines")
    for _ in range(2):
        sinks.load_reference(sample.machines(spark, sf_dir), path)
    return tables.read_reference(spark, "machines", path=path)


# Silver and gold


@query()
def silver_flags(spark, sf_dir):
    return sample.silver(spark, sf_dir)


@query("avg_temp", "avg_vibration")
def partition_pruned(spark, sf_dir):
    """One plant's first ten days of a partitioned silver table."""
    target = scratch(spark, "silver")
    silver = sample.silver(spark, sf_dir)
    sinks.write_partitioned(silver, target)
    stored = read_path(spark, target, schema=silver.schema)
    wanted = (F.col("plant_id") == "PLANT_DE_02") & F.col("event_date").between(
        F.lit("2024-01-01").cast("date"), F.lit("2024-01-10").cast("date")
    )
    return stored.filter(wanted).groupBy(*schemas.PLANT_DAY).agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("temperature_celsius").alias("avg_temp"),
        F.avg("vibration_hz").alias("avg_vibration"),
    )


@query(*DAY_AVERAGES)
def gold_full(spark, sf_dir):
    return _gold(spark, sf_dir)


@query(*DAY_AVERAGES)
def gold_compact(spark, sf_dir):
    return gold.compact(_gold(spark, sf_dir))


@query()
def risk_score(spark, sf_dir):
    """Scores to the last bit."""
    return _gold(spark, sf_dir).select(*schemas.MACHINE_DAY, "risk_score")


@query(*DAY_AVERAGES)
def gold_incremental(spark, sf_dir):
    """Gold without signups, then refreshed for the days on which they arrive."""
    target = scratch(spark, "gold")
    event_rows = sample.events(spark, sf_dir)
    arrived = F.col("event_type") == "signup"

    def silver_of(rows: DataFrame) -> DataFrame:
        return silver_from_bronze(bronze_ops.to_bronze(sample.telemetry_of(rows)))

    early = gold.gold_risk(silver_of(event_rows.filter(~arrived)))
    sinks.write_partitioned(early, target)
    touched = incremental.touched_days(silver_of(event_rows.filter(arrived)))
    fresh = incremental.recomputed_gold(silver_of(event_rows), touched)
    sinks.write_partitioned(fresh, target, only_touched=True)
    return read_path(spark, target, schema=early.schema)


@query(*DAY_AVERAGES)
def gold_versioned_refresh(spark, sf_dir):
    """Three versions of gold: cool readings, then hot ones too, then without one emptied day."""
    table, silver = scratch(spark, "gold"), sample.silver(spark, sf_dir)
    hot, emptied = F.col("temperature_celsius") >= 100, F.col("event_date") == "2024-01-05"
    for rows, changed in (
        (silver.filter(~hot), silver.filter(~hot)),
        (silver, silver.filter(hot)),
        (silver.filter(~emptied), silver.filter(emptied)),
    ):
        medallion.refresh_versioned_gold(spark, rows, incremental.touched_days(changed), table)
    return versions.read_version(spark, table)


@query(*DAY_AVERAGES)
def gold_merged_states(spark, sf_dir):
    """Gold of states that three batches were merged into, one of them twice, one day withdrawn."""
    table, silver = scratch(spark, "states"), sample.silver(spark, sf_dir)
    third = F.minute("event_timestamp") % 3
    for batch in (0, 1, 1, 2):
        increments.merge_readings(spark, silver.filter(third == batch), table, batch)
    faulty = (F.col("event_date") == "2024-01-05") | (F.col("event_hour") == 7) & (F.col("plant_id") == "PLANT_DE_02")
    touched = incremental.touched_days(silver.filter(faulty))
    increments.withdraw_readings(spark, silver.filter(~faulty), touched, table)
    return increments.stored_gold(spark, table)


@query(*DAY_AVERAGES)
def incremental_run(spark, sf_dir):
    """Gold after three refreshes, each of which finds new files with readings of any day."""
    base = scratch(spark, "increments")
    raw = sample.raw_telemetry(spark, sf_dir).select(*schemas.RAW_TELEMETRY_COLUMNS)
    landing = F.pmod(F.xxhash64("machine_id", "event_timestamp"), F.lit(3))
    for k in range(3):
        rows = raw.filter(landing == k)
        sinks.write_json_lines(rows, f"{base}/landing/{k}")
        increments.refresh(spark, f"{base}/landing/*", base)
    return increments.stored_gold(spark, increments.Increments(base).states)


@query()
def machines_seen_sketched(spark, sf_dir):
    """Machines seen per plant and week: exact count, and whether united daily sketches agree."""
    table, silver = scratch(spark, "sketches"), sample.silver(spark, sf_dir)
    versions.commit(sketches.machine_sketches(silver), table, ["plant_id"])
    week = F.date_trunc("week", "event_date").cast("date").alias("week")
    daily = versions.read_version(spark, table).select("*", week)
    seen = sketches.united(daily, ["plant_id", "week"])
    exact = silver.groupBy("plant_id", week).agg(F.countDistinct("machine_id").alias("machines"))
    return exact.join(seen, ["plant_id", "week"], "full_outer").select(
        "plant_id", "week", "machines", sketches.agrees("machines_seen", "machines").alias("sketch_agrees")
    )


@query("risk_score_sum")
def versions_survive_failure(spark, sf_dir):
    """What readers see after a write that failed half way, and after the next one."""
    table, gold_rows = scratch(spark, "gold"), _gold(spark, sf_dir)
    versions.commit(gold_rows.filter("event_date < '2024-01-11'"), table, schemas.PLANT_DAY)
    broken = F.when(F.col("plant_id") == "PLANT_DE_02", F.raise_error("broken")).otherwise(F.col("risk_score"))
    try:
        versions.commit(gold_rows.withColumn("risk_score", broken.cast("double")), table, schemas.PLANT_DAY)
    except PySparkException:
        pass
    else:
        raise AssertionError("the write was meant to fail")
    after_failure = versions.read_version(spark, table).withColumn("seen", F.lit("after failure"))
    versions.commit(gold_rows, table, schemas.PLANT_DAY, expected=1)
    after_commit = versions.read_version(spark, table).withColumn("seen", F.lit("after commit"))
    both = after_failure.unionByName(after_commit)
    return both.groupBy("seen", "plant_id").agg(
        F.count(F.lit(1)).alias("machine_days"), F.sum("risk_score").alias("risk_score_sum")
    )


@query("avg_risk_score")
def risk_rollup(spark, sf_dir):
    return gold.risk_rollup(_gold(spark, sf_dir))


@query("avg_temp", "avg_vibration")
def hourly_profile(spark, sf_dir):
    return gold.hourly_profile(sample.silver(spark, sf_dir))


@query()
def missing_days(spark, sf_dir):
    return gold.with_missing_days(_gold(spark, sf_dir))


@query()
def silent_spells(spark, sf_dir):
    """Spells without readings from New Year to the middle of February."""
    return gold.silent_spells(_gold(spark, sf_dir), "2024-01-01", "2024-02-15")


@query()
def silent_dates(spark, sf_dir):
    """The days of these spells, for one plant."""
    spells = gold.silent_spells(_gold(spark, sf_dir), "2024-01-01", "2024-02-15")
    return gold.silent_dates(spells.filter(F.col("plant_id") == "PLANT_DE_02"))


# Dashboards


@query()
def leaderboard_top10(spark, sf_dir):
    return serving.leaderboard(_gold(spark, sf_dir))


@query(*DAY_AVERAGES)
def leaderboard_top10_raw(spark, sf_dir):
    return serving.leaderboard(_gold(spark, sf_dir), rounded_values=False)


@query("avg_temp_24h")
def leaderboard_top5(spark, sf_dir):
    return serving.leaderboard(
        _gold(spark, sf_dir), k=5, rounded_values=False, columns=serving.SHORT_BOARD_COLUMNS
    )


@query()
def plant_summary(spark, sf_dir):
    return serving.plant_summary(_gold(spark, sf_dir))


@query()
def risk_kpi(spark, sf_dir):
    return serving.risk_kpi(_gold(spark, sf_dir))


@query()
def risk_kpi_machines(spark, sf_dir):
    return serving.risk_kpi_machines(_gold(spark, sf_dir))


@query()
def dashboard_sql(spark, sf_dir):
    """SQL text over gold published as a view."""
    sinks.materialize(_gold(spark, sf_dir), "gold_supply_risk")
    return spark.sql(
        "SELECT plant_id, event_date, count_if(risk_score > 0.30D) AS high_risk_machines, "
        "max(risk_score) AS peak_risk_score, sum(error_code_count_24h) AS error_codes "
        "FROM gold_supply_risk GROUP BY plant_id, event_date"
    )


@query()
def rank_in_plant(spark, sf_dir):
    return serving.rank_in_plant(_gold(spark, sf_dir))


@query()
def latest_reading(spark, sf_dir):
    return serving.latest_reading(sample.silver(spark, sf_dir))


@query()
def serving_published(spark, sf_dir):
    """The serving copy of the plant summary, read back after two syncs."""
    target = scratch(spark, "serving")
    for _ in range(2):
        sinks.publish_serving(serving.plant_summary(_gold(spark, sf_dir)), target)
    return sinks.read_target(spark, target)


# Trailing and sliding windows, sessions

TRAILING_AVERAGES = ("avg_temp_trailing", "avg_vibration_trailing")
SLIDING_AVERAGES = ("avg_temp_sliding", "avg_vibration_sliding")


@query(*TRAILING_AVERAGES)
def rolling_24h(spark, sf_dir):
    return trailing.trailing_risk(sample.silver(spark, sf_dir))


@query(*TRAILING_AVERAGES)
def rolling_24h_readings(spark, sf_dir):
    """The trailing measures next to every single reading, resends included."""
    silver = silver_from_bronze(sample.resent_bronze(spark, sf_dir))
    readings = silver.select(*trailing.KEY, "event_timestamp", "temperature_celsius", "rpm",
                             "vibration_hz", "is_fault_event", "is_overheating",
                             "is_vibration_anomaly")
    joined = trailing.with_trailing_risk(readings, trailing.trailing_risk(silver))
    return joined.drop("is_fault_event", "is_overheating", "is_vibration_anomaly")


@query(*SLIDING_AVERAGES)
def sliding_24h(spark, sf_dir):
    return trailing.sliding_risk(sample.silver(spark, sf_dir))


@query()
def fault_sessions(spark, sf_dir):
    return sessions.fault_sessions(sample.silver(spark, sf_dir))


# Data quality


@query()
def reconcile(spark, sf_dir):
    bronze = sample.resent_bronze(spark, sf_dir)
    valid, rejected = quality.split_valid(bronze)
    return quality.reconcile(bronze, valid, rejected)


def _written_with_faults(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Bronze, silver and quarantine as written, a plant's hour lost from silver, a plant-day of it
    written twice, and the quarantine of one day lost."""
    bronze = sample.resent_bronze(spark, sf_dir)
    day, hour = F.col("event_date"), F.hour("event_timestamp")
    lost = (F.col("plant_id") == "PLANT_CN_03") & (day == "2024-01-04") & (hour == 9)
    twice = (F.col("plant_id") == "PLANT_MX_01") & (day == "2024-01-02")
    silver = silver_from_bronze(bronze)
    written = {
        "bronze": bronze,
        "silver": silver.filter(~lost).unionByName(silver.filter(twice)),
        "quarantine": quality.quarantine_all(bronze).filter(~day.eqNullSafe(F.lit("2024-01-07").cast("date"))),
    }
    tables_ = {name: scratch(spark, f"reconciled-{name}") for name in written}
    for name, rows in written.items():
        versions.commit(rows, tables_[name])
    return [versions.read_version(spark, table) for table in tables_.values()]


@query()
def reconcile_written(spark, sf_dir):
    """Plant-days of written tables whose rows don't add up."""
    return reconciliation.unaccounted_days(*_written_with_faults(spark, sf_dir))


@query()
def reconcile_written_rows(spark, sf_dir):
    """The lost and doubled rows themselves."""
    rows = reconciliation.unaccounted_rows(*_written_with_faults(spark, sf_dir))
    keys = ("plant_id", "machine_id", "event_timestamp", "temperature_celsius")
    return rows.groupBy(*keys).agg(F.sum("surplus_left").alias("surplus_left"))


@query()
def dq_not_null(spark, sf_dir):
    bronze = sample.bronze(spark, sf_dir)
    checked = ("machine_id", "plant_id", "temperature_celsius", "vibration_hz", "pressure_bar")
    return quality.check_not_null(bronze, checked).select(
        "machine_id", "plant_id", "event_timestamp", "rule"
    )


@query()
def dq_unique(spark, sf_dir):
    return quality.check_unique(
        sample.resent_bronze(spark, sf_dir), ["machine_id", "event_timestamp"]
    )


@query()
def dq_accepted_values(spark, sf_dir):
    """Changed machines of a type outside the first three."""
    feed = changes.flatten_changes(sample.machine_changes(spark, sf_dir), "machine_id")
    bad = quality.domain_violations(feed, "machine_type", sample.MACHINE_TYPES[:3])
    return bad.select("machine_id", "machine_type", "lsn")


@query()
def dq_domains(spark, sf_dir):
    """States outside their domains, counted: some machines write them in lower case, and stocks
    of a multiple of fifty are marked as lost."""
    status = F.col("operational_status")
    odd = F.when(F.minute("event_timestamp") == 13, F.lower(status)).otherwise(status)
    readings = sample.bronze(spark, sf_dir).withColumn("operational_status", odd)
    transit = F.when(F.col("stock_level") % 50 == 0, "LOST").otherwise(F.col("transit_status"))
    levels = sample.inventory_levels(spark, sf_dir).withColumn("transit_status", transit)
    failing = [
        quality.check_domains(rows, domains).select("rule", "value")
        for rows, domains in ((readings, schemas.TELEMETRY_DOMAINS), (levels, schemas.INVENTORY_DOMAINS))
    ]
    return failing[0].union(failing[1]).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("failures"))


@query()
def dq_failures_stored(spark, sf_dir):
    """Failures of two checks stored together, counted per rule."""
    target = scratch(spark, "failures")
    bronze = sample.bronze(spark, sf_dir)
    missing = quality.check_not_null(bronze, ["machine_id", "vibration_hz"])
    unknown = quality.orphans(
        sample.inventory_levels(spark, sf_dir), sample.suppliers(spark, sf_dir), "supplier_id"
    )
    failures = quality.as_failures(missing).unionByName(
        quality.as_failures(unknown, "known_supplier")
    )
    sinks.write_run(failures, target, "checks")
    stored = read_path(spark, target)
    return stored.groupBy("rule").agg(
        F.count(F.lit(1)).alias("failures"), F.count("record").alias("records")
    )


@query()
def fk_orphans(spark, sf_dir):
    levels = sample.inventory_levels(spark, sf_dir)
    return quality.orphans(levels, sample.suppliers(spark, sf_dir), "supplier_id")


@query()
def frame_differences(spark, sf_dir):
    """What a resend adds to bronze, found by comparing both frames."""
    columns = ["machine_id", "plant_id", "event_timestamp", "temperature_celsius"]
    resent = sample.resent_bronze(spark, sf_dir).select(*columns)
    return quality.frame_differences(resent, sample.bronze(spark, sf_dir).select(*columns))


def _tampered_silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver, and the same with a plant's hour lost, a day doubled and a reading nudged."""
    silver = sample.silver(spark, sf_dir).drop(*LOAD_TIMES)
    day, hour = F.col("event_date"), F.col("event_hour")
    lost = (F.col("plant_id") == "PLANT_CN_03") & (day == "2024-01-04") & (hour == 9)
    nudged = (F.col("plant_id") == "PLANT_US_05") & (day == "2024-01-09") & (hour == 3)
    warmer = F.col("temperature_celsius") + F.when(nudged, 1).otherwise(0)
    doubled = silver.filter((F.col("plant_id") == "PLANT_MX_01") & (day == "2024-01-02"))
    other = silver.filter(~lost).withColumn("temperature_celsius", warmer)
    return silver, other.unionByName(doubled)


@query()
def fingerprint_parts(spark, sf_dir):
    """Plant-days whose fingerprints differ, those of one side read from where they were stored."""
    silver, other = _tampered_silver(spark, sf_dir)
    table = scratch(spark, "fingerprints")
    versions.commit(fingerprints.fingerprints(silver, schemas.PLANT_DAY), table)
    stored = versions.read_version(spark, table)
    now = fingerprints.fingerprints(other, schemas.PLANT_DAY, silver.columns)
    return fingerprints.differing_parts(stored, now, schemas.PLANT_DAY)


@query()
def fingerprint_drilldown(spark, sf_dir):
    """The rows in which both differ, found by parts, buckets and rows."""
    rows = fingerprints.row_differences(*_tampered_silver(spark, sf_dir), schemas.PLANT_DAY)
    keys = ("plant_id", "machine_id", "event_timestamp", "temperature_celsius")
    return rows.groupBy(*keys).agg(F.sum("surplus_left").alias("surplus_left"))


# Change data and history


@query()
def changes_flattened(spark, sf_dir):
    """Change envelopes as JSON text, parsed and flattened."""
    feed = sample.machine_changes(spark, sf_dir)
    envelope = F.struct(F.struct(*feed.columns).alias("payload"))
    lines = feed.select(F.to_json(envelope, {"timestampFormat": ISO_MICROS}).alias("value"))
    parsed = change_feed.parse_changes(lines, "machines")
    return changes.flatten_changes(parsed, "machine_id")


@query()
def apply_changes(spark, sf_dir):
    feed = changes.flatten_changes(sample.machine_changes(spark, sf_dir), "machine_id")
    return changes.apply_changes(sample.machines(spark, sf_dir), feed, "machine_id")


@query()
def scd2_machines(spark, sf_dir):
    feed = changes.flatten_changes(sample.machine_changes(spark, sf_dir), "machine_id")
    return changes.scd2(feed, "machine_id")


@query()
def snapshot_history(spark, sf_dir):
    """History opened from the first machines and brought up to the changed ones."""
    first = sample.machines(spark, sf_dir)
    feed = changes.flatten_changes(sample.machine_changes(spark, sf_dir), "machine_id")
    current = changes.apply_changes(first, feed, "machine_id")
    return changes.snapshot_history(changes.open_history(first), current, "machine_id")


def _routed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table's changes out of the feed of all three, which is parsed and routed in one pass."""
    folder = scratch(spark, "changes")
    change_feed.route_changes(change_feed.parse_all_changes(sample.change_lines(spark, sf_dir)), folder)
    return change_feed.routed_changes(spark, folder, table)


@query()
def apply_changes_suppliers(spark, sf_dir):
    feed = changes.flatten_changes(_routed(spark, sf_dir, "suppliers"), "supplier_id")
    return changes.apply_changes(sample.suppliers(spark, sf_dir), feed, "supplier_id")


@query()
def apply_changes_inventory(spark, sf_dir):
    """Inventory by its surrogate key."""
    feed = changes.flatten_changes(_routed(spark, sf_dir, "inventory_levels"), "id")
    return changes.apply_changes(sample.inventory_table(spark, sf_dir), feed, "id")


@query()
def scd2_inventory(spark, sf_dir):
    """History of inventory by part and warehouse."""
    keys = ["part_id", "warehouse_id"]
    feed = changes.flatten_changes(_routed(spark, sf_dir, "inventory_levels"), keys)
    return changes.scd2(feed, keys)


@query()
def changes_merged(spark, sf_dir):
    """Machines in hash buckets, into which batches of the feed are merged out of order, one twice."""
    table, keys = scratch(spark, "machines"), ["machine_id"]
    buckets.create_bucketed(sample.machines(spark, sf_dir), table, keys, 16)
    feed = changes.flatten_changes(_routed(spark, sf_dir, "machines"), keys)
    for part in (2, 0, 1, 2):
        buckets.merge_feed(spark, table, feed.filter(F.col("lsn") % 3 == part), keys, 16)
    return buckets.read_current(spark, table)


# Reference data


@query()
def machine_enrich(spark, sf_dir):
    silver = sample.silver(spark, sf_dir).select(*trailing.KEY, "event_timestamp", "temperature_celsius")
    return reference.enrich_machines(silver, sample.machines(spark, sf_dir))


@query("avg_temp", "avg_vibration", "temp_deviation", "vibration_deviation")
def baseline_deviation(spark, sf_dir):
    return reference.baseline_deviation(
        sample.silver(spark, sf_dir), sample.machines(spark, sf_dir)
    )


@query()
def inventory_value(spark, sf_dir):
    return reference.inventory_value(
        sample.inventory_levels(spark, sf_dir), sample.suppliers(spark, sf_dir)
    )


@query()
def reorder_alerts(spark, sf_dir):
    return reference.reorder_alerts(sample.inventory_levels(spark, sf_dir))


@query()
def canonical_sites(spark, sf_dir):
    return reference.to_canonical(sample.machines(spark, sf_dir), reference.CANONICAL["site"])


@query()
def canonical_partners(spark, sf_dir):
    return reference.to_canonical(sample.suppliers(spark, sf_dir), reference.CANONICAL["tpartner"])


@query()
def canonical_inventory(spark, sf_dir):
    return reference.to_canonical(
        sample.inventory_levels(spark, sf_dir), reference.CANONICAL["inventory_level"]
    )


# Publishing


@query()
def publish_batches(spark, sf_dir):
    records = sample.telemetry_of(sample.events(spark, sf_dir), "event_id")
    return delivery.assign_batches(records, "event_id").select(
        "event_id", "machine_id", "batch_id", "batch_position"
    )


@query()
def key_value_payload(spark, sf_dir):
    """Keys and the fields read back from the payload text."""
    readings = sample.telemetry_of(sample.events(spark, sf_dir))
    published = delivery.to_key_value(readings)
    parsed = F.from_json("value", schemas.RAW_TELEMETRY).alias("payload")
    return bronze_ops.to_bronze(published.select("key", parsed).select("key", "payload.*"))


@query()
def delivery_ledger(spark, sf_dir):
    return delivery.delivery_ledger(sample.delivery_outcomes(spark, sf_dir))


@query("backoff_seconds")
def pending_retries(spark, sf_dir):
    """What is to be sent again once every record has had three sends."""
    so_far = sample.delivery_outcomes(spark, sf_dir).filter(F.col("attempt") <= 3)
    return delivery.pending_retries(so_far)


# Streams, run to the end of their input and read from the written tables


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_ops.to_bronze(sample.telemetry_of(sample.event_stream(spark, sf_dir)))
    return silver_from_bronze(bronze)


def _finish(started) -> None:
    started.awaitTermination()


def _streamed_split(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    base = scratch(spark, "stream")
    bronze = bronze_ops.to_bronze(sample.telemetry_of(sample.event_stream(spark, sf_dir)))
    paths = f"{base}/silver", f"{base}/quarantine"
    _finish(stream_silver.stream_silver(bronze, *paths, f"{base}/checkpoint"))
    return paths


@query()
def stream_silver_written(spark, sf_dir):
    silver_path, _ = _streamed_split(spark, sf_dir)
    layout = sample.silver(spark, sf_dir).schema
    return read_path(spark, silver_path, schema=layout).drop(stream_silver.BATCH)


@query()
def stream_quarantine_written(spark, sf_dir):
    _, quarantine_path = _streamed_split(spark, sf_dir)
    layout = sample.bronze(spark, sf_dir).schema
    return read_path(spark, quarantine_path, schema=layout).drop(stream_silver.BATCH)


@query()
def stream_resends_dropped(spark, sf_dir):
    base = scratch(spark, "dedupe")
    resent = sample.telemetry_of(sample.resent_events(sample.event_stream(spark, sf_dir)))
    kept = stream_silver.dedupe_stream(resent)
    _finish(stream_silver.append_stream(kept, f"{base}/rows", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows")


@query()
def stream_resends_days_later(spark, sf_dir):
    """Each purchase is sent again ten days later, in a later file; the stream starts anew for each."""
    base, events = scratch(spark, "seen"), sample.events(spark, sf_dir)
    readings = sample.telemetry_of(events)
    again = sample.telemetry_of(events.filter(F.col("event_type") == "purchase"))
    part = F.floor(F.datediff("event_timestamp", F.lit("2024-01-01")) / 10)
    part = F.least(F.greatest(part, F.lit(0)), F.lit(2))
    for k in range(4):
        file = readings.filter(F.coalesce(part, F.lit(0)) == k)
        file = file.unionByName(again.filter(F.coalesce(part, F.lit(0)) == k - 1))
        file.write.mode("append").parquet(f"{base}/landing")
        landed = spark.readStream.schema(readings.schema).parquet(f"{base}/landing")
        _finish(stream_seen.stream_first_readings(landed, base, f"{base}/checkpoint"))
    return stream_seen.first_readings(spark, base, readings)


@query()
def stream_machine_enrich(spark, sf_dir):
    base = scratch(spark, "enrich")
    silver = _silver_stream(spark, sf_dir).select(*trailing.KEY, "event_timestamp", "temperature_celsius")
    enriched = reference.enrich_machines(silver, sample.machines(spark, sf_dir))
    _finish(stream_silver.append_stream(enriched, f"{base}/rows", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows")


@query()
def stream_json_landing(spark, sf_dir):
    """A stream landed as JSON files and picked up by the telemetry stream."""
    base = scratch(spark, "landing")
    events = sample.telemetry_of(sample.event_stream(spark, sf_dir))
    _finish(sinks.stream_json_lines(events, f"{base}/json", f"{base}/out"))
    landed = bronze_ops.to_bronze(telemetry.stream_telemetry(spark, f"{base}/json"))
    _finish(stream_silver.append_stream(landed, f"{base}/rows", f"{base}/in"))
    return spark.read.parquet(f"{base}/rows")


def _streamed_days(spark: SparkSession, sf_dir: str) -> str:
    base = scratch(spark, "daily")
    days = stream_risk.daily_risk(_silver_stream(spark, sf_dir))
    _finish(stream_risk.stream_upserts(days, f"{base}/rows", f"{base}/checkpoint"))
    return f"{base}/rows"


@query(*DAY_AVERAGES)
def daily_window(spark, sf_dir):
    return stream_risk.read_upserts(spark, _streamed_days(spark, sf_dir))


def _late_stream(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Silver landed as three files, ten days each, a seventh of the minutes in the last one; both
    streams are run to the end and started anew for every file."""
    base, silver = scratch(spark, "late"), sample.silver(spark, sf_dir)
    days = F.floor(F.datediff("event_date", F.lit("2024-01-01")) / 10)
    file = F.when(F.minute("event_timestamp") % 7 == 0, 2).otherwise(F.least(days, F.lit(2)))
    for k in range(3):
        silver.filter(file == k).write.mode("append").parquet(f"{base}/landing")
        landed = spark.readStream.schema(silver.schema).parquet(f"{base}/landing")
        _finish(stream_late.stream_readings(landed, base, f"{base}/checkpoint"))
        days_ = stream_risk.daily_risk(landed)
        _finish(stream_risk.stream_upserts(days_, f"{base}/gold", f"{base}/gold-checkpoint"))
    return base, silver


@query(*DAY_AVERAGES)
def stream_late_completed(spark, sf_dir):
    """Streamed gold, made good for the days of readings that came behind the watermark."""
    base, silver = _late_stream(spark, sf_dir)
    return stream_late.completed_gold(
        stream_risk.read_upserts(spark, f"{base}/gold"),
        stream_late.stored_readings(spark, base, silver),
        stream_late.late_readings(spark, base, silver),
    )


@query()
def stream_late_rows(spark, sf_dir):
    """The late readings themselves, counted by plant-day."""
    base, silver = _late_stream(spark, sf_dir)
    late = stream_late.late_readings(spark, base, silver)
    return late.groupBy(*schemas.PLANT_DAY).agg(F.count(F.lit(1)).alias("late_readings"))


@query()
def stream_leaderboard(spark, sf_dir):
    return stream_risk.leaderboard(spark, _streamed_days(spark, sf_dir))


@query()
def stream_plant_machines(spark, sf_dir):
    base = scratch(spark, "plants")
    days = stream_risk.machine_days(_silver_stream(spark, sf_dir))
    _finish(stream_risk.stream_upserts(days, f"{base}/rows", f"{base}/checkpoint"))
    return stream_risk.plant_machines(spark, f"{base}/rows")


@query(*SLIDING_AVERAGES)
def stream_sliding_24h(spark, sf_dir):
    base = scratch(spark, "sliding")
    windows = stream_risk.sliding_risk(_silver_stream(spark, sf_dir))
    _finish(stream_silver.append_stream(windows, f"{base}/rows", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows")


@query()
def stream_fault_sessions(spark, sf_dir):
    base = scratch(spark, "sessions")
    found = stream_risk.fault_sessions(_silver_stream(spark, sf_dir))
    _finish(stream_silver.append_stream(found, f"{base}/rows", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows")


@query(*SLIDING_AVERAGES)
def stream_sliding_24h_whole(spark, sf_dir):
    """The windows still open too, built from streamed hourly totals when read."""
    base = scratch(spark, "steps")
    steps = stream_risk.step_totals(_silver_stream(spark, sf_dir))
    _finish(stream_risk.stream_upserts(steps, f"{base}/rows", f"{base}/checkpoint"))
    return stream_risk.whole_windows(spark, f"{base}/rows")


@query()
def stream_fault_sessions_whole(spark, sf_dir):
    """The sessions still open too, built from streamed cells when read."""
    base = scratch(spark, "fault-cells")
    found = stream_risk.fault_cells(_silver_stream(spark, sf_dir))
    _finish(stream_risk.stream_upserts(found, f"{base}/rows", f"{base}/checkpoint"))
    return stream_risk.whole_sessions(spark, f"{base}/rows")
