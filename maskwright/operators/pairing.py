"""Linked documents of one case: alias registry, identity of mentions, audits (P*, Q3-Q6, J12, C5)."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.legal_zh import HAN, HIGH_RISK, IDENTIFIERS, NEUTRAL, mention_key

#: mentions that identify nobody: court codes, heavenly-stem nicknames, bare masks; fixed values
SAFE_MENTION = re.compile(r"(?i:A\d+)|[甲-癸]+[男女]?|[○〇ＯOo某]+")
SECTION_NAMES = ("privacy", "pair_consistency", "facts", "evidence")


def build_registry(persons: list[dict], literals: list[tuple[str, str]]) -> dict:
    """Persons of a plan with the alias each got most often; mentions of one person apart from ambiguous ones.

    ``persons``: group_id, role, mentions.  ``literals``: (mention, alias) as
    applied.  Persons without any alias are left out.
    """
    applied = dict(literals)
    entries, owners = [], defaultdict(set)
    for person in persons:
        mentions = [m for m in person["mentions"] if m in applied]
        if not mentions:
            continue
        alias = Counter(applied[m] for m in mentions).most_common(1)[0][0]  # the first seen of equals
        entry = {"pair_person_id": f"P{len(entries) + 1:02d}", "indictment_group_id": person["group_id"], "role": person["role"], "alias": alias, "indictment_mentions": mentions}
        entries.append(entry)
        for mention in mentions:
            owners[mention_key(mention)].add((entry["pair_person_id"], alias))
    unique = {k: dict(zip(("pair_person_id", "alias"), next(iter(v)))) for k, v in owners.items() if len(v) == 1}
    ambiguous = sorted(k for k, v in owners.items() if len(v) > 1)
    return {"version": "pair-alias-v1", "restricted": True, "persons": entries, "unique_mentions": unique, "ambiguous_mentions": ambiguous, "manual_review_required": bool(ambiguous)}


def resolve(person: dict, registry: dict) -> dict | None:
    """The registry's person for one of the other document: by explicit link, else by unambiguous mentions."""
    linked = person.get("linked_indictment_group_id")
    if linked:
        for entry in registry["persons"]:
            if linked in (entry["indictment_group_id"], entry["pair_person_id"]):
                return {"pair_person_id": entry["pair_person_id"], "alias": entry["alias"], "method": "explicit_link"}
    found = {tuple(registry["unique_mentions"][k].values()) for m in person["mentions"] if (k := mention_key(m)) in registry["unique_mentions"]}
    if len(found) == 1:
        pair_person_id, alias = found.pop()
        return {"pair_person_id": pair_person_id, "alias": alias, "method": "unique_normalized_mention"}
    return None


def augmented(registry: dict, persons: list[dict]) -> dict:
    """A copy of the registry that also knows the linked mentions of the other document."""
    out = {**registry, "persons": [dict(p) for p in registry["persons"]], "unique_mentions": dict(registry["unique_mentions"])}
    for person in persons:
        hit = resolve(person, registry)
        if hit:
            entry = next(p for p in out["persons"] if p["pair_person_id"] == hit["pair_person_id"])
            entry["judgment_mentions"] = list(dict.fromkeys([*entry.get("judgment_mentions", []), *person["mentions"]]))
            for mention in person["mentions"]:
                out["unique_mentions"][mention_key(mention)] = {k: hit[k] for k in ("pair_person_id", "alias")}
    return out


def is_safe_mention(mention: str) -> bool:
    """Whether a mention identifies nobody."""
    return SAFE_MENTION.fullmatch(mention) is not None


def identifier_hits(text: str) -> dict[str, int]:
    """Identifiers left in a published text; zeros, masks and letterless plates are none (Q3)."""
    out = {}
    for kind, (pattern, _) in IDENTIFIERS.items():
        found = [m[0] for m in re.finditer(pattern, text)]
        found = [v for v in found if set(re.sub(r"[^0-9A-Za-z]", "", v)) - set("0Oo")]
        if kind == "PLATE":
            found = [v for v in found if re.search("[A-Za-z]", v)]
        if found:
            out[kind] = len(found)
    return out


def deterministic_checks(texts: dict[str, str], mentions: dict[str, list[str]], persons: list[dict], professional: frozenset[str]) -> dict:
    """Leaks of exact mentions, identifiers and alias collisions over a pair's clean texts."""
    leaks = [
        {"document": name, "mention": mention}
        for name, text in texts.items()
        for mention in dict.fromkeys(m for found in mentions.values() for m in found)
        if not is_safe_mention(mention) and mention in text
    ]
    hits = [{"document": n, "kind": k, "count": c, "severity": "high" if k in HIGH_RISK else "medium"} for n, t in texts.items() for k, c in identifier_hits(t).items()]
    by_alias: dict[str, list[dict]] = defaultdict(list)
    for person in persons:
        by_alias[person["alias"]].append(person)
    collisions = [
        {"alias": alias, "person_ids": sorted({p["pair_person_id"] for p in found})}
        for alias, found in by_alias.items()
        if len({p["pair_person_id"] for p in found}) > 1 and alias != NEUTRAL and not all(p["role"] in professional for p in found)
    ]
    high = bool(leaks or collisions or any(h["severity"] == "high" for h in hits))
    return {"pass": not high, "exact_person_mention_leaks": leaks, "identifier_pattern_hits": hits, "alias_collisions": collisions}


def mention_leaks(mentions: DataFrame, texts: DataFrame, case: str = "pair_id") -> DataFrame:
    """``case, document, mention`` of original mentions found in clean texts, compared within a case only."""
    asked = mentions.select(case, "mention").distinct().where(~F.col("mention").rlike(f"^(?:{SAFE_MENTION.pattern})$"))
    return texts.select(case, "document", "text").join(asked, case).where(F.contains("text", F.col("mention"))).select(case, "document", "mention")


def outcome(overall: Column, sections: list[Column], checks_pass: Column) -> Column:
    """pass, review or fail: a failed check alone is a case for review (Q6)."""
    every = checks_pass & (overall == "pass")
    for section in sections:
        every = every & (section == "pass")
    return F.when(overall == "fail", "fail").when(every, "pass").otherwise("review")


def has_han(column: Column) -> Column:
    return column.rlike(f"[{HAN}]")
