"""Cases assembled from indictments and linked judgments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import first_wins, non_blank

#: one step of a generated role: closed fields, as a model's answer is parsed with
TRACE = (
    "array<struct<step_id:string,claim_type:string,proposition:string,evidence_ids:array<string>,support_snippets:array<string>,"
    "evidence_interpretation:string,inference:string,uncertainty:string>>"
)
CLAIM_TYPES = ("fact", "evidence_observation", "inference", "legal_rule", "legal_application")


def linked_source_ids(links: Column, namespace: str) -> Column:
    """Namespaced ids of a record's links, blank ones dropped."""
    return F.transform(F.filter(links, lambda x: F.trim(x["barcode"]) != ""), lambda x: F.concat(F.lit(namespace + ":"), F.trim(x["barcode"])))


def judgment_internal_id(url: Column, namespace: str = "JUDICIAL") -> Column:
    """Id that hides the address of a judgment."""
    return F.sha2(F.concat(F.lit(namespace + ":"), F.sha2(url, 256)), 256)


def holding(sections: Column) -> Column:
    """The operative part, null if there is none."""
    return non_blank(F.try_element_at(sections, F.lit("主文")))


def generation_pairs(indictments: DataFrame, judgments: DataFrame, model: str) -> DataFrame:
    """Judgments with their indictment, both by one model, with a holding; the first of each pair_id.

    ``judgments`` needs pair_id, linked_indictment_doc_id, model, text, sections, ord.
    """
    same = F.lower("model") == model.lower()
    left = judgments.where(same).withColumn("target_holding", holding(F.col("sections"))).where("target_holding is not null")
    right = indictments.where(same).select(F.col("doc_id").alias("linked_indictment_doc_id"), F.col("text").alias("indictment_text"), F.col("evidence").alias("indictment_evidence"))
    joined = first_wins(left.join(right, "linked_indictment_doc_id"), ["pair_id"], "ord")
    return joined.withColumn("source_chars", (F.length("indictment_text") + F.length("text")).cast("long"))


def evidence_catalog(items: Column, prefix: str, source: str) -> Column:
    """Evidence with ids like I-E001 and where it is from."""
    return F.transform(
        items, lambda e, i: F.struct(F.format_string(f"{prefix}-E%03d", i + 1).alias("evidence_id"), e["name"].alias("name"), F.lit(source).alias("source"))
    )


def case_materials(pairs: DataFrame) -> DataFrame:
    """What each role may see: catalogues of both documents, and the prosecutor's of the indictment alone."""
    first = evidence_catalog(F.col("indictment_evidence"), "I", "indictment")
    second = evidence_catalog(F.col("evidence"), "J", "judgment")
    return pairs.select(
        "pair_id", "target_holding", first.alias("indictment_evidence"), F.concat(first, second).alias("all_evidence"),
        F.array("indictment_text").alias("prosecutor_sources"), F.array("indictment_text", "text").alias("court_sources"),
    )


def complete_cases(judgments: DataFrame, indictments: DataFrame, raw_indictments: DataFrame, raw_judgments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cases with all four texts, and the ids of judgments that lack one."""
    texts = lambda df, name: df.select("doc_id", non_blank("text").alias(name)).where(f"{name} is not null")
    by_link = lambda df, name: texts(df, name).withColumnRenamed("doc_id", "linked_indictment_doc_id")
    full = (
        judgments.join(by_link(indictments, "clean_indictment"), "linked_indictment_doc_id")
        .join(by_link(raw_indictments, "raw_indictment"), "linked_indictment_doc_id")
        .join(texts(raw_judgments, "raw_judgment"), "doc_id")
    )
    return full, judgments.select("doc_id").join(full, "doc_id", "left_anti")


def public_pairs(cases: DataFrame, entities: DataFrame) -> DataFrame:
    """What may be shown of a pair: clean texts, and of people only id, role and alias.

    ``entities``: pair_id, pair_person_id, role, alias, and restricted columns that stay behind.
    """
    shown = entities.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("pair_person_id", "role", "alias"))).alias("pair_entities"))
    documents = F.struct(F.col("clean_indictment").alias("indictment"), F.col("clean_judgment").alias("judgment"))
    return cases.select("pair_id", documents.alias("documents")).join(shown, "pair_id", "left")


def sampled_by_length(cases: DataFrame, group: str, limit: int) -> DataFrame:
    """The shortest case of each group, then the shortest others."""
    from .ranking import best_of_each

    return best_of_each(cases, group, ["source_chars", "pair_id"], limit).drop("rest")


def parse_role(answers: DataFrame, column: str = "answer") -> DataFrame:
    """Answers parsed into the closed schema; ``parse_error`` says what is wrong (L2, L3, Q5)."""
    schema = f"struct<role:string,reasoning_trace:{TRACE},new_evidence_claimed:array<string>,limitations:array<string>>"
    row = F.from_json(column, schema)
    types = F.exists(row["reasoning_trace"], lambda s: ~F.coalesce(s["claim_type"].isin(*CLAIM_TYPES), F.lit(False)))
    error = (
        F.when(F.try_parse_json(column).isNull(), "not_json")
        .when(row["role"].isNull(), "missing_role")
        .when(F.coalesce(F.size(row["reasoning_trace"]), F.lit(0)) <= 0, "missing_trace")
        .when(types, "unknown_claim_type")
    )
    return answers.withColumns({"parsed": row, "parse_error": error})


def evidence_keys(explicit: Column, category: Column, name: Column) -> Column:
    """Key by which evidence of two documents is the same: the given one, else category and content; blank if neither says anything."""

    @F.pandas_udf("string")
    def content(values: pd.Series) -> pd.Series:
        from ..functions.legal_zh import content_key

        return values.map(content_key)

    given, key = non_blank(explicit), content(name)
    return F.when(given.isNotNull(), F.concat(F.lit("explicit:"), given)).when(key != "", F.concat(F.lit("content:"), content(category), F.lit(":"), key)).otherwise("")


def longer_evidence(current: Column, prior: Column) -> tuple[Column, Column]:
    """The evidence list to keep and where it is from: an earlier reviewed one only if it is longer."""
    keep_prior = F.coalesce(F.size(prior), F.lit(0)) > F.coalesce(F.size(current), F.lit(0))
    return F.when(keep_prior, prior).otherwise(current), F.when(keep_prior, "previous_human_reviewed_best").otherwise("hybrid_analysis")


def reaudit_cases(patched: DataFrame, indictments: DataFrame, judgments: DataFrame) -> DataFrame:
    """Patched copies with the raw texts of both their documents, ready to be audited again.

    ``patched``: pair_id, judgment_internal_id, linked_indictment_doc_id and the
    copies.  ``indictments``: doc_id, text.  ``judgments``: judgment_internal_id,
    text, null as empty.  A copy without its indictment or judgment has no case.
    """
    first = indictments.select(F.col("doc_id").alias("linked_indictment_doc_id"), F.coalesce("text", F.lit("")).alias("raw_indictment"))
    second = judgments.select("judgment_internal_id", F.coalesce("text", F.lit("")).alias("raw_judgment"))
    return patched.join(first, "linked_indictment_doc_id").join(second, "judgment_internal_id")
