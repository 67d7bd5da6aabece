"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Spark 4.1 can take a union of equally partitioned inputs for partitioned
    # itself and then fail to pair it with the other side of a join.
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("millwatch")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, reachable by every executor.

    A machine-local folder is made only for a local master, where one machine
    is all there is.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"millwatch-{application_id}-")
