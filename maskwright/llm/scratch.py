"""Shared working folder for tables that cut lineage between stages.

Everything goes below ``spark.checkpoint.dir``, which driver and executors
share.  Only where that setting is absent *and* the master is a single local
JVM is a temporary folder used instead.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getConf().get(_KEY) or spark.conf.get(_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"{_KEY} must name a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="maskwright-")
    spark.conf.set(_KEY, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; nothing is created there yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike a cache this survives the loss of any executor, and stages after it
    restart from the files instead of recomputing what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table once its readers are done."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside delete their shuffle files when they end, not when the driver next collects garbage.

    For results that are read once or written to a table; a frame made here must not be run again outside.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
