"""Registries, audits, grounding and patches of linked records; all names are invented."""

import copy

import json

import pytest

from maskwright.functions import json_pointer as jp
from maskwright.functions.legal_zh import PROFESSIONAL
from maskwright.operators import grounding, pairing, patching


def registry():
    persons = [{"group_id": "g1", "role": "DEFENDANT", "mentions": ["許○○", "許大明"]}, {"group_id": "g2", "role": "WITNESS", "mentions": ["林小甫"]}]
    return pairing.build_registry(persons, [("許○○", "被告甲"), ("許大明", "被告甲"), ("林小甫", "證人乙")])


def test_masked_variant_is_the_same_person():
    hit = pairing.resolve({"mentions": ["許OO"]}, registry())
    assert hit == {"pair_person_id": "P01", "alias": "被告甲", "method": "unique_normalized_mention"}


def test_explicit_link_comes_first():
    assert pairing.resolve({"mentions": ["A03"], "linked_indictment_group_id": "g2"}, registry())["alias"] == "證人乙"


def test_ambiguous_mentions_resolve_to_nobody():
    persons = [{"group_id": "a", "role": "VICTIM", "mentions": ["陳○○", "甲一"]}, {"group_id": "b", "role": "VICTIM", "mentions": ["陳○○", "乙一"]}]
    found = pairing.build_registry(persons, [("陳○○", "被害人甲"), ("甲一", "被害人甲"), ("乙一", "被害人乙")])
    # one literal has one alias, so the second person's commonest alias is the first seen of its own
    assert found["manual_review_required"] and found["ambiguous_mentions"] == ["陳○○"]
    assert pairing.resolve({"mentions": ["陳OO"]}, found) is None


def test_augmenting_copies():
    base = registry()
    before = copy.deepcopy(base)
    out = pairing.augmented(base, [{"mentions": ["許O明", "許大明"]}])
    assert base == before and "許○明" in out["unique_mentions"] and out["persons"][0]["judgment_mentions"] == ["許O明", "許大明"]


def test_checks():
    people = registry()["persons"]
    check = lambda text, p=people: pairing.deterministic_checks({"indictment": text}, {"indictment": ["許大明", "甲", "A01"]}, p, PROFESSIONAL)
    assert check("被告甲與A01於113-05-20到場，車牌OO-OO")["pass"]
    assert check("許大明到場")["exact_person_mention_leaks"] == [{"document": "indictment", "mention": "許大明"}]
    assert not check("電話0912345678")["pass"]
    assert check("112年度偵字第12號")["identifier_pattern_hits"][0]["severity"] == "medium"
    twice = [{"pair_person_id": "P01", "alias": "被告甲", "role": "DEFENDANT"}, {"pair_person_id": "P02", "alias": "被告甲", "role": "WITNESS"}]
    assert check("", twice)["alias_collisions"] == [{"alias": "被告甲", "person_ids": ["P01", "P02"]}]
    judges = [{"pair_person_id": "P01", "alias": "〇〇〇", "role": "JUDGE"}, {"pair_person_id": "P02", "alias": "〇〇〇", "role": "CLERK"}]
    assert check("", judges)["pass"]


def test_leaks_and_outcome(spark):
    from pyspark.sql import functions as F

    mentions = spark.createDataFrame([("p1", "許大明"), ("p1", "A01"), ("p2", "林小甫")], "pair_id string, mention string")
    texts = spark.createDataFrame([("p1", "judgment", "許大明與A01"), ("p2", "judgment", "許大明")], "pair_id string, document string, text string")
    assert [tuple(r) for r in pairing.mention_leaks(mentions, texts).collect()] == [("p1", "judgment", "許大明")]
    rows = spark.createDataFrame([("pass", "pass", True), ("pass", "warning", True), ("fail", "pass", True), ("pass", "pass", False)], "o string, s string, c boolean")
    got = [r[0] for r in rows.select(pairing.outcome(F.col("o"), [F.col("s")], F.col("c"))).collect()]
    assert got == ["pass", "review", "fail", "review"]


SOURCE = "被告甲於某日將款項共計７００萬元匯入帳戶，隨即離去。"


def test_quotes():
    assert grounding.contains_folded(SOURCE, "款項 共計700萬元")
    assert grounding.closest_quote("將款項共計700萬圓匯入帳戶", [SOURCE]) == "將款項共計７００萬元匯入帳戶"
    assert grounding.closest_quote("完全無關的另外一段文字內容", [SOURCE]) is None
    assert grounding.closest_quote("款項", [SOURCE]) is None
    assert grounding.repair_snippets(["將款項共計700萬圓匯入帳戶", "隨即離去", "完全無關的另外一段文字內容"], [SOURCE]) == (["將款項共計７００萬元匯入帳戶", "隨即離去"], ["replaced", "dropped"])
    assert grounding.repair_snippets(["無關"], [SOURCE]) == (["無關"], [])


def role(name="judge", **more):
    cite = [{"evidence_ids": ["E1"]}]
    briefs = {
        "judge": {"decision": {"target_holding": "有罪", "issue_findings": cite, "response_to_prosecution": cite, "response_to_defense": cite, "rationale": cite}},
        "defense": {"defense_brief": {"admissions": [], "disputes": cite, "evidence_arguments": cite}, "hypotheticals": [{"is_asserted_fact": False}]},
        "prosecutor": {"prosecution_brief": {"theory_of_case": cite[0], "facts_asserted": cite, "evidence_arguments": cite}},
    }
    base = {"role": name, "issues": ["i"], "reasoning_trace": [{"evidence_ids": ["E1"], "support_snippets": ["隨即離去"]}], "new_evidence_claimed": []}
    return base | briefs[name] | more


def without(name, *path):
    output = json.loads(json.dumps(role(name)))
    at = output
    for key in path[:-1]:
        at = at[key]
    del at[path[-1]]
    return output


@pytest.mark.parametrize(
    "name, output, errors",
    [
        ("judge", role(), []),
        ("defense", role("defense"), []),
        ("prosecutor", role("prosecutor"), []),
        ("defense", role("judge"), ["wrong_role", "missing_defense_brief", "brief_part_is_no_list"]),
        ("judge", role(reasoning_trace=[{"evidence_ids": ["E9"], "support_snippets": ["隨即離去"]}]), ["unknown_evidence_id"]),
        ("judge", role(reasoning_trace=[]), ["missing_trace"]),
        ("judge", role(reasoning_trace=[{}]), ["step_without_evidence", "step_without_snippet"]),
        ("judge", role(reasoning_trace=[{"evidence_ids": ["E1"], "support_snippets": ["隨"]}]), ["invalid_snippet"]),
        ("judge", role(new_evidence_claimed=["x"]), ["new_evidence_claimed"]),
        ("judge", without("judge", "new_evidence_claimed"), ["new_evidence_claimed"]),
        ("judge", without("judge", "issues"), ["missing_issues"]),
        ("judge", without("judge", "decision", "target_holding"), ["holding_mismatch"]),
        ("judge", without("judge", "decision", "rationale"), ["brief_part_is_no_list"]),
        ("prosecutor", without("prosecutor", "prosecution_brief", "theory_of_case"), ["brief_without_evidence"]),
        ("defense", role("defense", hypotheticals=[{"is_asserted_fact": True}]), ["hypothetical_asserted"]),
        ("defense", role("defense", hypotheticals=[{}]), ["hypothetical_asserted"]),
        ("judge", role(hypotheticals=[{"is_asserted_fact": True}]), []),
        ("judge", role(reasoning_trace=[{"evidence_ids": ["E1"], "support_snippets": ["不在其中的話"]}]), ["snippet_not_in_sources"]),
        ("judge", ["no object"], ["wrong_role"]),
    ],
)
def test_roles(name, output, errors):
    assert grounding.role_errors(output, name, {"E1"}, [SOURCE], "有罪" if name == "judge" else None) == errors


def test_legal_rules_move():
    step = grounding.migrate_legal_rules([{"claim_type": "legal_rule", "evidence_ids": ["E1"], "support_snippets": ["隨即離去"]}], {"indictment": SOURCE, "judgment": ""})[0]
    assert step["evidence_ids"] == [] and step["legal_sources"] == ["indictment"]


def case():
    record = lambda: {"text": "被告甲到場", "evidence": [{"name": "照片"}], "analysis_plan": {"persons": [{"group_id": "g1", "role": "DEFENDANT", "mentions": ["許大明"]}]}}
    return {"raw": {"indictment": "許大明到場，照片可佐", "judgment": "許大明與林小甫到場"}, "indictment": record(), "judgment": record(), "registry": registry()}


LINK = {"op": "LINK_PERSON", "document": "judgment", "pair_person_id": "P01", "mentions": ["許大明"], "source_quote": "許大明"}


@pytest.mark.parametrize(
    "change, codes",
    [
        ({}, []),
        ({"source_quote": "沒有"}, ["source_quote_not_found"]),
        ({"pair_person_id": "P77"}, ["unknown_pair_person_id"]),
        ({"mentions": []}, ["missing_mentions"]),
        ({"op": "DROP_TABLE"}, ["unsupported_op"]),
        ({"document": "elsewhere"}, ["invalid_document"]),
        ({"op": "SET_ALIAS", "alias": "許大明"}, ["unsafe_or_invalid_alias"]),
        ({"op": "UPDATE_PERSON_ROLE", "role": "KING", "field_path": "/analysis_plan/persons/0/role"}, ["unsupported_person_role"]),
        ({"op": "MASK_SPAN", "field_path": "/doc_id", "old_text": "x", "replacement": "y"}, ["field_path_not_allowed"]),
        ({"op": "REGISTER_PERSON", "mentions": ["林小甫"], "alias": "證人乙", "role": "WITNESS", "pair_person_id": "P01"}, ["duplicate_pair_person_id"]),
        ({"op": "REMOVE_REGISTRY_MENTION", "mentions": ["別人"]}, ["registry_mention_not_found"]),
    ],
)
def test_operation_errors(change, codes):
    assert patching.operation_errors(LINK | change, case()) == codes


def test_plans():
    before = case()
    mask = {"op": "MASK_SPAN", "document": "judgment", "field_path": "/text", "old_text": "到場", "replacement": "[到]", "source_quote": "許大明"}
    plan = {"operations": [mask, LINK, {"op": "UPDATE_PERSON_ROLE", "document": "judgment", "role": "WITNESS", "field_path": "/analysis_plan/persons/0/role", "source_quote": "許大明"}, {"op": "MARK_FALSE_POSITIVE", "document": "pair"}, mask]}
    out = patching.apply_plan(before, plan)
    assert [o["status"] for o in out["operations"]] == ["applied", "applied", "applied", "skipped", "already_satisfied"]
    assert out["case"]["judgment"]["text"] == "被告甲[到]" and before["judgment"]["text"] == "被告甲到場"
    assert out["case"]["judgment"]["analysis_plan"]["persons"][0] == {"group_id": "g1", "role": "WITNESS", "mentions": ["許大明"], "linked_indictment_group_id": "P01"}
    assert patching.plan_summary({"operations": []}, case())["pass"] is False
    assert patching.plan_summary({"operations": [LINK]}, case())["pass"] is True


def test_aliases_change_in_both_records():
    out = patching.apply_plan(case(), {"operations": [{"op": "SET_ALIAS", "document": "pair", "pair_person_id": "P01", "alias": "被告丙"}]})["case"]
    assert out["indictment"]["text"] == out["judgment"]["text"] == "被告丙到場" and out["registry"]["unique_mentions"]["許大明"]["alias"] == "被告丙"


def test_pointers():
    document = {"a/b": [{"~": "x"}, "y"]}
    assert dict(jp.leaves(document)) == {"/a~1b/0/~0": "x", "/a~1b/1": "y"}
    jp.put(document, "/a~1b/0/~0", "z")
    assert jp.get(document, "/a~1b/0/~0") == "z"
    with pytest.raises(KeyError):
        jp.get(document, "/a~1b/7")
