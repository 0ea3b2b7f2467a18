"""Analysis plans without a remote model, and what surrounds a model's calls (L*, N34, N39, N40, Q7, J16).

A model stage reads a table of plans keyed by prompt digest; where it has
none, :func:`local_plan` makes one from the deterministic extraction.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import legal_zh as zh

MAX_SOURCE_CHARS, MAX_PROMPT_CHARS = 24_000, 160_000


def local_plan(text: str) -> dict:
    """A plan in the form a model is asked for, from the rule pack."""
    persons = [{"group_id": f"g{i}", "role": p["role"], "mentions": p["mentions"], "linked_indictment_group_id": None, "same_person_reason": ""} for i, p in enumerate(zh.extract_people(text), 1)]
    organizations = [{"group_id": f"o{i}", "mentions": [o["canonical_name"]], "action": "MASK", "reason": ""} for i, o in enumerate(zh.extract_organizations(text), 1)]
    identifiers = [
        {"mention": m[0], "category": {"MOBILE": "PHONE", "LANDLINE": "PHONE", "TW_ID": "ID"}.get(kind, kind), "replacement": label, "reason": ""}
        for kind, (pattern, label) in zh.IDENTIFIERS.items()
        for m in re.finditer(pattern, text)
    ]
    return {"persons": persons, "organizations": organizations, "identifiers": identifiers, "crime_facts_summary": [], "evidence": zh.extract_evidence(text), "uncertainties": []}


def canonical_digest(value, spaced: bool = False) -> str:
    """SHA-256 of JSON with sorted keys, with or without spaces after separators."""
    separators = (", ", ": ") if spaced else (",", ":")
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=separators).encode()).hexdigest()


def extract_json_object(answer: str) -> dict:
    """The one object of an answer, code fences and a list around it taken off."""
    body = re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", answer.strip())
    value = json.loads(body)
    if isinstance(value, list) and len(value) == 1:
        value = value[0]
    if not isinstance(value, dict):
        raise ValueError("the answer is no JSON object")
    return value


def retry_after(header: str | None, detail: str, fallback: float) -> float:
    """Seconds to wait: the header's, else what the message says and three more; five at least."""
    match = re.search(r"retry in ([0-9.]+)\s*s", detail, re.I)
    try:
        seconds = float(header) if header else float(match[1]) + 3 if match else fallback
    except ValueError:
        seconds = fallback
    return max(5.0, seconds)


def failure_kind(status: int | None, chars: int, answer_ok: bool | None) -> str | None:
    """Dead-letter reason of an attempt, None for a success (Q7)."""
    if chars > MAX_SOURCE_CHARS:
        return "source_too_long_for_free_api"
    if status is not None and status >= 400:
        return "transient_api_error" if status in (429, 500, 502, 503, 504) else "api_request_error"
    if answer_ok is None:
        return "empty_model_response"
    return None if answer_ok else "invalid_model_response"


def conservative_cost(prompt_bytes: Column, calls: int, in_price: float, out_price: float, out_tokens: int) -> Column:
    """Upper bound of a call's price: a token a byte, all answers of full length."""
    return F.round(calls * (prompt_bytes * in_price + out_tokens * out_price), 8)


def with_plans(cases: DataFrame, plans: DataFrame, prompt: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cases with a plan for their prompt, those to be asked for, and those too long."""
    keyed = cases.withColumn("input_sha256", F.sha2(prompt, 256)).withColumn("__long", F.length(prompt) > MAX_PROMPT_CHARS)
    fits = keyed.where("not __long").drop("__long")
    return fits.join(plans, "input_sha256"), fits.join(plans, "input_sha256", "left_anti"), keyed.where("__long").drop("__long")


def role_order(checkpoints: DataFrame, pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """The next role each pair needs: prosecutor, defense, judge, or none."""
    have = checkpoints.groupBy(key).agg(F.collect_set("role").alias("have"))
    missing = F.array_except(F.array(*[F.lit(r) for r in ("prosecutor", "defense", "judge")]), F.coalesce("have", F.array().cast("array<string>")))
    return pairs.join(have, key, "left").select(pairs[key], F.get(missing, F.lit(0)).alias("next_role"))
