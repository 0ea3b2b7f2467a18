"""De-identification of document tables: one pass over the text, five tables out (E*, M*, N*, Q*, R12).

The stages depend on each other's whole output, so they run in one vectorised
function; callers persist its frame once and project the tables from it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import legal_zh
from .relational import spread

PERSON = "array<struct<canonical_name:string,roles:array<string>,mentions:array<string>,alias:string,role:string>>"
ORGANIZATION = "array<struct<canonical_name:string,alias:string,type:string>>"
EVIDENCE = "array<struct<evidence_id:string,name:string,content:string,content_status:string,source:string>>"
RESULT = (
    "source_id string, normalized_text string, text string, people " + PERSON + ", organizations " + ORGANIZATION + ", mask_counts map<string,bigint>, "
    "volume_citations_removed bigint, evidence " + EVIDENCE + ", leak_pass boolean, original_mentions array<string>, regex_hits map<string,bigint>, "
    "residual_role_names array<string>, semantic_pass boolean, legal_citations_preserved boolean, disposition_term_loss array<string>, length_ratio double"
)


def _row(source_id: str, text: str | None) -> dict:
    out = legal_zh.deidentify(text or "")
    leak, semantic = out.pop("leakage"), out.pop("semantic")
    out["mask_counts"] = list(out["mask_counts"].items())
    return {
        "source_id": source_id, **out, "leak_pass": leak["pass"], "original_mentions": leak["original_mentions"], "regex_hits": list(leak["regex_hits"].items()),
        "residual_role_names": leak["residual_role_names"], "semantic_pass": semantic.pop("pass"), **semantic,
    }


def _arrow_schema() -> pa.Schema:
    """RESULT for Arrow, which takes the rows as they are; by way of pandas every nested value is converted in Python."""
    text, texts, counts = pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.int64())
    items = lambda **fields: pa.list_(pa.struct(list(fields.items())))
    return pa.schema({
        "source_id": text, "normalized_text": text, "text": text, "people": items(canonical_name=text, roles=texts, mentions=texts, alias=text, role=text),
        "organizations": items(canonical_name=text, alias=text, type=text), "mask_counts": counts, "volume_citations_removed": pa.int64(),
        "evidence": items(evidence_id=text, name=text, content=text, content_status=text, source=text), "leak_pass": pa.bool_(), "original_mentions": texts, "regex_hits": counts,
        "residual_role_names": texts, "semantic_pass": pa.bool_(), "legal_citations_preserved": pa.bool_(), "disposition_term_loss": texts, "length_ratio": pa.float64(),
    })


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow_schema()
    for batch in batches:
        ids, texts = (batch.column(name).to_pylist() for name in ("source_id", "raw_text"))
        yield pa.RecordBatch.from_pylist([_row(i, t) for i, t in zip(ids, texts)], schema=schema)


def deidentify(adapted: DataFrame) -> DataFrame:
    """All results for every row of ``source_id, raw_text``; a null text is an empty one."""
    return spread(adapted.select(F.col("source_id").cast("string"), "raw_text")).mapInArrow(_run, RESULT)


def with_stable_ids(results: DataFrame, mapping: DataFrame) -> DataFrame:
    """``doc_id`` from the mapping table, new ones where it has none.

    New ids are random, so write the frame before anything reads it twice.
    """
    return results.join(mapping.select("source_id", F.col("doc_id").alias("__known")), "source_id", "left").withColumn("doc_id", F.coalesce("__known", F.expr("replace(uuid(), '-', '')"))).drop("__known")


def output_tables(results: DataFrame) -> dict[str, DataFrame]:
    """Clean, audit, normalised, registry and mapping tables of a persisted result with ``doc_id``."""
    case = F.sha2("source_id", 256).alias("case_internal_id")
    return {
        "clean": results.select("doc_id", "text", "evidence", F.struct(F.col("leak_pass").alias("leakage_pass"), "semantic_pass").alias("privacy")),
        "audit": results.select(case, "doc_id", "leak_pass", "original_mentions", "regex_hits", "residual_role_names", "semantic_pass", "length_ratio", "mask_counts", "volume_citations_removed", F.size("evidence").cast("long").alias("evidence_count")),
        "normalized": results.select("source_id", "normalized_text", F.sha2("normalized_text", 256).alias("normalized_hash")),
        "registry": results.select(case, "source_id", F.col("people").alias("persons"), "organizations"),
        "mapping": results.select(F.col("doc_id").alias("internal_clean_doc_id"), "source_id"),
    }


def manifest(results: DataFrame) -> DataFrame:
    """One row of counts."""
    return results.agg(
        F.count("*").alias("documents"), F.count_distinct(F.sha2("text", 256)).alias("distinct_texts"), F.count_if("leak_pass").alias("leakage_passed"),
        F.count_if("semantic_pass").alias("semantic_passed"), F.sum(F.size("evidence")).alias("evidence_items"), F.sum("volume_citations_removed").alias("volume_citations_removed"),
    )


def manifest_json(results: DataFrame) -> str:
    """The manifest with summed mask counts, as JSON."""
    from .ranking import explode_counts

    row = manifest(results).first().asDict()
    row["mask_counts"] = {r["kind"]: r["n_masked"] for r in explode_counts(results, "mask_counts", []).collect()}
    return json.dumps(row, ensure_ascii=False, sort_keys=True)
