"""Repair, flags and tiers of generated three-role records."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable

from ..functions import legal_zh as zh
from .grounding import cited_ids, migrate_legal_rules
from .rendering import CATEGORY_LABELS, LABELS, OTHER_CATEGORY, OTHER_LABEL, is_masked

# ---- fixed values ------------------------------------------------------------------------------------------------

MASKS = zh.MASK_GLYPHS
ROLES = ("prosecutor", "defense", "judge")
PARTIES = ("被告", "告訴人", "證人", "被害人", "法定代理人")
#: these share the neutral mask here; the police get aliases of their own
NEUTRAL_ROLES = zh.PROFESSIONAL - {"POLICE"}
TAIL = re.compile(r"(?<=[。；;])\s*(?:犯罪事實及證據名稱|犯罪事實及證據|犯罪事實|事實及證據名稱|事實及理由|事實|理由)(?=\s*[^，,。；;])")
OUTCOMES = {
    "conviction": re.compile(r"犯[^。；]{0,45}罪|處(?:有期徒刑|拘役|罰金)|應執行"),
    "acquittal": re.compile("無罪"),
    "procedural": re.compile("公訴不受理|本件免訴|本案免訴|管轄錯誤|上訴不受理"),
    "interlocutory": re.compile("停止審判|再開辯論|限制出境|限制出海"),
}
CONFLICT = re.compile(r"不一致|相互矛盾|矛盾|記載差異|有待(?:法院)?釐清|同時出現")
BOILERPLATE = re.compile(
    r"未(?:親自)?(?:提供|閱覽).{0,18}(?:原文|全文|本體|原件|完整卷證)|現有(?:資料|材料|文字|摘要).{0,18}(?:不足|無法)|仍須.{0,18}(?:法院|完整卷證).{0,12}(?:判斷|審查|認定)"
)
ARTEFACT = "actual_target_holding"
ARTEFACT_TEXT = "本案主文"
BROAD = {"fact": (8, 0.65), "evidence_observation": (8, 0.65), "inference": (12, 0.75), "legal_application": (12, 0.75)}
BOILERPLATE_STEPS = 4

# ---- pieces ------------------------------------------------------------------------------------------------------


def clean_holding(value: str | None) -> tuple[str, bool]:
    """A holding up to the first section that follows it, and whether that cut anything."""
    holding = re.sub(r"\s+", " ", value or "").strip()
    cut = TAIL.split(holding, maxsplit=1)[0].strip()
    return cut, cut != holding


def classify_outcome(holding: str) -> str:
    """What a holding decides; several kinds are mixed, none unknown (K2)."""
    found = [name for name, pattern in OUTCOMES.items() if pattern.search(holding)]
    return "unknown" if not found else found[0] if len(found) == 1 else "mixed"


def map_strings(value, change: Callable[[str], str]):
    """A nested value with every string changed, keys left alone."""
    if isinstance(value, str):
        return change(value)
    if isinstance(value, list):
        return [map_strings(v, change) for v in value]
    return {k: map_strings(v, change) for k, v in value.items()} if isinstance(value, dict) else value


def is_private_name(mention: str, reason: str = "") -> bool:
    """Whether a mention is a person's own name and no nickname, label or code."""
    if not re.fullmatch(r"[㐀-鿿]{2,4}(?:教授|律師|醫師)?", mention) or re.search("暱稱|綽號|網路代稱|匿名", reason):
        return False
    labels = "|".join([*PARTIES, OTHER_LABEL])
    if mention in (*PARTIES, "不詳男子", "不詳女子") or re.fullmatch(rf"(?:{labels})?[{zh.MARKS}男女]|[㐀-鿿]姓(?:友人|男子|女子)", mention):
        return False
    nickname = mention[0] == "阿" or mention[-1] in "哥姐仔董少毛爺" or (len(mention) == 2 and mention[0] == mention[1])
    return not (len(mention) <= 3 and nickname)


def _plans(*documents: dict):
    return [d.get("analysis_plan") or {} for d in documents]


def private_literals(*documents: dict) -> set[str]:
    """Names and identifiers no output may show (P5)."""
    out = set()
    for plan in _plans(*documents):
        for person in plan.get("persons") or []:
            out |= {m for m in person.get("mentions") or [] if is_private_name(m, person.get("same_person_reason") or "")}
        for item in plan.get("identifiers") or []:
            mention = (item.get("mention") or "").strip()
            if len(mention) >= 3 and not is_masked(mention) and item.get("category") != "KEEP" and "[" not in mention:
                out.add(mention)
    return out


def private_replacements(*documents: dict) -> dict[str, str]:
    """Aliases for names that leaked into structured fields, the same in all documents of a case."""
    table: dict[str, str] = {}
    used: Counter = Counter()
    for plan in _plans(*documents):
        for person in plan.get("persons") or []:
            mentions = [m.strip() for m in person.get("mentions") or [] if is_private_name(m.strip(), person.get("same_person_reason") or "") or re.fullmatch(rf"[㐀-鿿][{MASKS}]{{2,}}", m.strip())]
            if not mentions:
                continue
            role = person.get("role") or "OTHER"
            alias = next((table[m] for m in mentions if m in table), None)
            if alias is None and role in NEUTRAL_ROLES:
                alias = zh.NEUTRAL
            elif alias is None:
                label = "法定代理人" if role == "LEGAL_REPRESENTATIVE" else LABELS.get(role, OTHER_LABEL)
                alias = label + zh.mark(used[label])
                used[label] += 1
            for mention in mentions:
                table.setdefault(mention, alias)
    for plan in _plans(*documents):
        for item in plan.get("identifiers") or []:
            mention = (item.get("mention") or "").strip()
            if mention and not is_masked(mention) and not re.search(rf"[{MASKS}\[\]]", mention):
                table.setdefault(mention, item.get("replacement") or CATEGORY_LABELS.get(item.get("category"), OTHER_CATEGORY))
    return table


def replace_literals(value, table: dict[str, str]) -> tuple[object, int]:
    """All literals replaced, and in how many strings."""
    if not table:
        return value, 0
    changed = 0

    def one(text: str) -> str:
        nonlocal changed
        new = zh.replace_words(text, table)
        changed += new != text
        return new

    return map_strings(value, one), changed


def resolve_masks(value, source: str) -> tuple[object, int]:
    """Masked names like 甲○○ to role and mark, where the source gives them one role."""
    masked = rf"([{zh.MARKS}])[{MASKS}]{{2,}}"
    roles = {}
    for literal in {m[0] for m in re.finditer(masked, source)}:
        seen = [p for p in PARTIES if p + literal in source]
        if len(seen) == 1:
            roles[literal] = seen[0] + literal[0]
    changed = 0

    def one(text: str) -> str:
        nonlocal changed
        new = re.sub(rf"({'|'.join(PARTIES)}){masked}", r"\1\2", text)
        new = re.sub(masked, lambda m: roles.get(m[0], m[0]), new)
        changed += new != text
        return new

    return map_strings(value, one), changed


# ---- flags and the whole record ----------------------------------------------------------------------------------


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def broad_steps(roles: dict, n_catalog: int) -> int:
    """Steps that cite too much of the catalogue for their kind (K6)."""
    n = 0
    for role in roles.values():
        for step in role.get("reasoning_trace") or []:
            least, share = BROAD.get(step.get("claim_type"), (float("inf"), 1))
            ids = len(set(step.get("evidence_ids") or []))
            n += ids >= least and ids / max(1, n_catalog) >= share
    return n


def record_flags(record: dict, *documents: dict) -> tuple[list[str], list[str]]:
    """Hard and review flags of a record (K5-K7)."""
    roles = record.get("roles") or {}
    if not set(ROLES) <= set(roles):
        return ["missing_role"], []
    catalog = {str(e.get("evidence_id")) for e in record.get("evidence_catalog") or []}
    text = _json(roles)
    defence = [" ".join(str(s.get(k) or "") for k in ("proposition", "inference")) for s in roles["defense"].get("reasoning_trace") or []]
    hard = {
        "unknown_evidence_id": bool(set(cited_ids(roles)) - catalog),
        "new_evidence_claimed": any(roles[r].get("new_evidence_claimed") for r in ROLES),
        "prosecutor_judgment_evidence_leak": any(i.startswith("J-E") for i in cited_ids(roles["prosecutor"])),
        "judge_holding_mismatch": (roles["judge"].get("decision") or {}).get("target_holding") != record.get("target_holding"),
        "unknown_outcome": record.get("outcome_class") == "unknown",
        "non_final_interlocutory_order": record.get("outcome_class") == "interlocutory",
        "unremoved_prompt_artifact": ARTEFACT in text,
        "raw_private_literal_leak": any(p in text for p in private_literals(*documents)),
    }
    review = {
        "unresolved_masked_person_alias": re.search(rf"[{zh.MARKS}][{MASKS}]{{2,}}", text) is not None,
        "cross_document_fact_conflict": CONFLICT.search(_json(roles["judge"])) is not None,
        "overbroad_evidence_citation": broad_steps(roles, len(catalog)) > 0,
        "defense_boilerplate_heavy": sum(BOILERPLATE.search(t) is not None for t in defence) >= BOILERPLATE_STEPS,
    }
    return sorted(k for k, v in hard.items() if v), sorted(k for k, v in review.items() if v)


def tier(hard: list[str], review: list[str]) -> str:
    return "rejected" if hard else "needs_review" if review else "recommended"


def clean_record(record: dict, indictment: dict, judgment: dict) -> dict:
    """A repaired copy with quality and the repairs made (K1)."""
    repairs: list[str] = []
    sections = judgment.get("sections") or {}
    holding, cut = clean_holding(sections.get("主文") or record.get("target_holding"))
    if cut or holding != record.get("target_holding"):
        repairs.append("holding_reextraction")
    outcome = classify_outcome(holding)
    if outcome != record.get("outcome_class"):
        repairs.append("outcome_reclassification")
    roles, n = replace_literals(record.get("roles") or {}, private_replacements(indictment, judgment))
    repairs += ["private_literal_replacement"] * bool(n)
    roles, n = replace_literals(roles, {ARTEFACT: ARTEFACT_TEXT})
    repairs += ["prompt_artifact_replacement"] * bool(n)
    source = "\n".join(str(d.get("text") or "") for d in (indictment, judgment))
    roles, n = resolve_masks(roles, source)
    repairs += ["alias_normalization"] * bool(n)
    documents = {"indictment": str(indictment.get("text") or ""), "judgment": str(judgment.get("text") or "")}
    moved = {name: {**r, "reasoning_trace": migrate_legal_rules(r.get("reasoning_trace") or [], documents)} for name, r in roles.items()}
    repairs += ["legal_rule_citation_migration"] * (moved != roles)
    if (decision := moved.get("judge", {}).get("decision")) is not None:
        moved["judge"]["decision"] = {**decision, "target_holding": holding}
    out = {**record, "roles": moved, "target_holding": holding, "outcome_class": outcome}
    hard, review = record_flags(out, indictment, judgment)
    status = tier(hard, review)
    out["quality"] = {"status": status, "hard_flags": hard, "review_flags": review, "training_eligible": not hard, "recommended_for_training": status == "recommended"}
    out["cleaning"] = {"version": "clean-v1", "repairs_applied": repairs}
    return out


def report(records: list[dict]) -> dict:
    """Counts of tiers, flags and repairs."""
    count = lambda values: dict(sorted(Counter(values).items()))
    return {
        "records": len(records), "status": count(r["quality"]["status"] for r in records), "hard_flags": count(f for r in records for f in r["quality"]["hard_flags"]),
        "review_flags": count(f for r in records for f in r["quality"]["review_flags"]), "repairs": count(k for r in records for k in r["cleaning"]["repairs_applied"]),
    }
