"""Session factory, and making this package importable where Python tasks run."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "maskwright") -> SparkSession:
    """A session for one machine; on a cluster spark-submit supplies these settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: rows of an Arrow batch between the JVM and a Python worker; texts can be long
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> SparkSession:
    """Let this session's Python workers import the package from where the driver has it.

    Where executors have no such folder, submit the package with --py-files.
    Also keeps batches small, unless the session has its own size for them.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
    return spark
