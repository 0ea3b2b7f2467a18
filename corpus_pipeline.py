"""Corpus preparation: five stages, each written and reread before the next.

Every stage works on all rows the one before kept.  All but the last return
the columns of ``documents``, extra ones too; the last returns the packed
pieces.  An empty table stays empty.  Rows of a null id or of the same id are
documents of their own: what goes is told by id and text together.  A null text
has no letter and goes with the first stage; the others keep it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import decontaminate, langid, line_dedup, near_dup, packing
from maskwright.llm.queries import tokenizer_path
from maskwright.llm.scratch import materialise
from maskwright.session import ship

#: texts nearer to no language than this cosine are rejected with those that have no letter; that of an unrelated
#: text is 0.03 from zero in standard deviation, the lowest of the documents' own languages are beyond 0.06
MIN_LANGUAGE_SCORE = 0.05
#: share of shingles, in percent, from which two documents are near-duplicates
NEAR_PERCENT = 80
#: words a worker remembers while packing: its memory still holds what the stages before left there
CACHE_WORDS = 100_000
#: documents to drop are broadcast up to this many (16 bytes each), else joined by shuffle
BROADCAST_IDS = 1_000_000


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows named by ``gone`` (doc_id, text_hash)."""
    gone = materialise(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "dropped")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and those like no language learnt from the table itself, go."""
    ship(spark)
    model = langid.train(langid.learnable(docs))
    return langid.accepted(docs, model, MIN_LANGUAGE_SCORE)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go; the documents stay, if need be empty."""
    ship(spark)
    rest = {f"rest_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}  # names of its own
    named = docs.select("doc_id", "text", *[F.col(c).alias(own) for own, c in rest.items()])
    kept = line_dedup.drop_repeated_lines(named, carry=list(rest))
    back = kept.select("doc_id", F.col("kept_text").alias("text"), F.length("kept_text").cast("long").alias("n_chars"), *[F.col(own).alias(c) for own, c in rest.items()])
    return back.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays; texts without words stay."""
    ship(spark)
    return _without(docs, near_dup.near_duplicates(docs, percent=NEAR_PERCENT).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    ship(spark)
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    hits = decontaminate.contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key").select(F.col("doc_id").alias("key"))
    hits = materialise(hits.distinct(), "hits")
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_IDS else hits
    return _without(docs, keyed.join(hits, "key", "left_semi").select("doc_id", F.xxhash64("text").alias("text_hash")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 4096 ids."""
    ship(spark)
    return packing.pack_sequences(docs, tokenizer_path(), cache_words=CACHE_WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dup", near_duplicates),
    ("decontaminate", decontamination),
    ("packing", packing_stage),
]

#: vectors, minhashes, alignment and bin packing have no SQL form; tests/llm holds run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
