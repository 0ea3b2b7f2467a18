"""Resumable processing: each source row once, whatever the number of runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.relational import failures_without_success, last_wins


def resume_batch(source: DataFrame, done: DataFrame, key: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results of what is not done yet."""
    return work(source.join(done.select(key).distinct(), key, "left_anti"))


def run_available(
    spark: SparkSession, source_path: str, schema: StructType, out_path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], file_format: str = "parquet"
) -> None:
    """Process all files not seen by earlier runs and stop.

    A batch is written below its own number and replaces what a lost attempt
    at it may have left, so results are there exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    stream = spark.readStream.schema(schema).format(file_format).load(source_path)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def dead_letters(attempts: DataFrame, key: str, order: str) -> DataFrame:
    """Latest failure of each key that has not succeeded since."""
    failures, successes = attempts.where("error is not null"), attempts.where("error is null")
    return failures_without_success(last_wins(failures, [key], order), successes, key)


def sync_checkpoint(spark: SparkSession, source_path: str, schema: StructType | str, state: str, checkpoint: str, key: str, order: str) -> DataFrame:
    """The latest row of each key of a growing folder of JSON Lines, as a table brought up to date (T5).

    Reads only files no earlier call has seen.  Each batch writes the whole
    state as a version of its own, so a lost attempt leaves the last one whole.
    """
    columns = spark.createDataFrame([], schema)

    def version(number: int) -> DataFrame:
        return spark.read.schema(columns.schema).parquet(f"{state}/version={number}") if number >= 0 else columns

    def write(batch: DataFrame, number: int) -> None:
        last_wins(version(number - 1).unionByName(batch), [key], order).select(columns.columns).write.mode("overwrite").parquet(f"{state}/version={number}")

    stream = spark.readStream.schema(columns.schema).json(source_path)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = [int(s.getPath().getName().split("=")[1]) for s in files.listStatus(folder)] if files.exists(folder) else []
    return version(max(numbers, default=-1))
