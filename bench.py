"""Times the headline queries and prints one JSON line.

Every query is run once to warm up and then BENCH_RUNS times; its median counts.
Results go to Spark's noop sink, so all rows are computed and none collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame

from millwatch.operators import quality, serving, trailing
from millwatch.operators.bronze import to_bronze
from millwatch.operators.gold import gold_risk
from millwatch.plans.queries import BUILDERS, LOAD_TIMES
from millwatch.sources import sample_tables as sample
from millwatch.sources import sinks
from millwatch.sources.session import build_session, shared_folder
from millwatch.sources.tables import read_path
from millwatch.streaming import silver as streaming

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REGISTERED = (
    "gold_full",
    "rolling_24h",
    "sliding_24h",
    "fault_sessions",
    "rank_in_plant",
    "reconcile",
    "quarantine_distinct",
    "apply_changes",
    "scd2_machines",
    "publish_batches",
    "delivery_ledger",
    "machine_enrich",
    "inventory_value",
    "fk_orphans",
    "reorder_alerts",
)


def compute(df: DataFrame) -> None:
    """Load times are left out: they are constants that change with every run,
    and make Spark compile the same query anew each time."""
    df.drop(*LOAD_TIMES).write.format("noop").mode("overwrite").save()


def median_seconds(run: Callable[[], None]) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            # call sites of column expressions, wanted in error messages only
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = f"{shared_folder(spark)}/bench-{uuid4().hex}"
    silver = sample.silver(spark, SF_DIR)
    gold = gold_risk(silver)
    sinks.write_partitioned(silver, f"{lake}/silver")
    sinks.write_partitioned(gold, f"{lake}/gold")
    stored_silver = read_path(spark, f"{lake}/silver", schema=silver.schema)
    stored_gold = read_path(spark, f"{lake}/gold", schema=gold.schema)
    bronze = sample.bronze(spark, SF_DIR)

    def split() -> None:
        for side in quality.split_valid(bronze):
            compute(side)

    def streamed_silver() -> None:
        base = f"{lake}/stream-{uuid4().hex}"
        source = to_bronze(sample.telemetry_of(sample.event_stream(spark, SF_DIR)))
        paths = f"{base}/silver", f"{base}/quarantine"
        streaming.stream_silver(source, *paths, f"{base}/checkpoint").awaitTermination()

    work: dict[str, Callable[[], None]] = {
        "gate_and_split": split,
        "gold_from_silver_table": lambda: compute(gold_risk(stored_silver)),
        "rolling_24h_from_silver_table": lambda: compute(trailing.trailing_risk(stored_silver)),
        "leaderboard_top10": lambda: compute(serving.leaderboard(stored_gold)),
        "plant_summary": lambda: compute(serving.plant_summary(stored_gold)),
        "risk_kpi": lambda: compute(serving.risk_kpi(stored_gold)),
        "write_silver_partitioned": lambda: sinks.write_partitioned(silver, f"{lake}/again"),
        "stream_silver": streamed_silver,
    }
    for name in REGISTERED:
        work[name] = lambda name=name: compute(BUILDERS[name](spark, SF_DIR))

    seconds = {name: median_seconds(run) for name, run in work.items()}
    rows = bronze.count()
    wanted = "plant_id = 'PLANT_DE_02' AND event_date = DATE '2024-01-05'"
    files = {
        "all": len(stored_silver.inputFiles()),
        "one_plant_day": len(
            {r[0] for r in stored_silver.filter(wanted).select("_metadata.file_path").distinct().collect()}
        ),
    }
    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows_per_second": {
            name: round(rows / seconds[name]) for name in ("gate_and_split", "gold_full", "stream_silver")
        },
        "silver_files_read": files,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())
