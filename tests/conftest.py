from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")

from telemetry_support import BRONZE_LAYOUT, reading  # noqa: E402

from millwatch.operators.bronze import to_bronze  # noqa: E402
from millwatch.operators.silver import silver_from_bronze  # noqa: E402
from millwatch.sources.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Builds a bronze frame from partial readings."""

    def build(*rows: dict):
        raw = spark.createDataFrame([reading(**row) for row in rows], BRONZE_LAYOUT)
        return to_bronze(raw)

    return build


@pytest.fixture
def silver(bronze):
    def build(*rows: dict):
        return silver_from_bronze(bronze(*rows))

    return build
