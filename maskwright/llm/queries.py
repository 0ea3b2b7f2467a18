"""The registered queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, kneser_ney, langid, line_dedup, media, packing, secrets, url_lists, warc
from .near_dup import near_duplicates


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.store_texts(_documents(spark, sf_dir))).drop("tile_file", "tile_row", "error")


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir)).drop("text_hash")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_lists.filter_captures(url_lists.capture_days(pages), url_lists.demo_entries(pages))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_documents(spark, sf_dir))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(_documents(spark, sf_dir), tokenizer_path())


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.identify(docs, langid.train(langid.learnable(docs)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_near_dup": op2_near_dup,
    "op3_warc": op3_warc,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc": warc.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_url_filter": url_lists.ORACLE,
    "op7_secret_scan": secrets.ORACLE,
}
