"""JSON Lines and keyed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, missing_ok: bool = False) -> DataFrame:
    """One object a line, empty lines skipped; a malformed line is an error, a missing file optionally no rows (A1, A2, A4)."""
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="FAILFAST", lineSep="\n")


def read_jsonl_quarantined(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ``path, line`` of lines that are no object of the schema (A3)."""
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("path")).where(F.trim("value") != "")
    parsed = lines.withColumn("row", F.from_json("value", schema)).withColumn("ok", F.col("row").isNotNull() & F.startswith(F.ltrim("value"), F.lit("{")) & F.try_parse_json("value").isNotNull())
    return parsed.where("ok").select("row.*"), parsed.where("not ok").select("path", F.col("value").alias("line"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nulls are written, as readers expect every field."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_snapshot(df: DataFrame, path: str, order: DataFrame, key: str) -> None:
    """The keyed rows that ``order`` (key, ord) lists, in its order."""
    df.join(order, key).repartitionByRange("ord").sortWithinPartitions("ord").drop("ord").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_folder(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All ``*.json`` documents of a folder with their file names, which give them an order (A5)."""
    return spark.read.schema(schema).json(f"{path}/*.json", multiLine=True).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def write_csv(df: DataFrame, path: str, bom_column: bool = True) -> None:
    """CSV with a header; spreadsheets are told the encoding by a mark before the first column's name."""
    first = df.columns[0]
    out = df.withColumnRenamed(first, "\ufeff" + first) if bom_column else df
    out.write.mode("overwrite").option("header", True).csv(path)
