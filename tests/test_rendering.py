"""Plans, rendering, cleaning and planning; all names are invented."""

import json

import pytest
from pyspark.sql import functions as F

from maskwright.operators import cleaning, rendering
from maskwright.plans import planner

COURT = {"year": "114", "case_word": "易", "number": 484}


def rendered(text, plan, **kw):
    return rendering.render(text, rendering.replacements(text, plan, **kw))


def person(role, *mentions, **more):
    return {"group_id": "g", "role": role, "mentions": list(mentions), **more}


def test_registry_fills_in_masked_names():
    registry = {"persons": [{"canonical_name": "林○浚", "mentions": ["林○浚"], "roles": ["CO_OFFENDER"], "role": "CO_OFFENDER"}]}
    text = "被告王大同與少年林○浚共同犯案,少年林○浚之供述可佐。"
    assert rendered(text, {"persons": [person("DEFENDANT", "王大同")]}, registry=registry) == "被告甲與少年甲共同犯案,少年甲之供述可佐。"


def test_court_codes_stay():
    assert rendering.replacements("被告A01到場", {"persons": [person("DEFENDANT", "A01")]}) == []


def test_professionals_are_neutral():
    text = "檢察官郭中明、書記官林小甫、法官陳小乙及選任辯護人何小丙均到庭。"
    plan = {"persons": [person("PROSECUTOR", "郭中明"), person("CLERK", "林小甫"), person("JUDGE", "陳小乙"), person("DEFENSE_COUNSEL", "何小丙")]}
    assert rendered(text, plan) == "檢察官〇〇〇、書記官〇〇〇、法官〇〇〇及選任辯護人〇〇〇均到庭。"


def test_mislabelled_defendants():
    registry = {"persons": [{"canonical_name": "林小甫", "mentions": ["林小甫"], "roles": ["WITNESS", "CO_OFFENDER"], "role": "WITNESS"}]}
    text = "被告王大同與共犯林小甫犯案,證人林小甫於警詢證述。"
    got = rendered(text, {"persons": [person("DEFENDANT", "王大同"), person("DEFENDANT", "林小甫")]}, registry=registry)
    assert got == "被告甲與共犯甲犯案,證人即共犯甲於警詢證述。"


def test_organizations():
    text = "於高雄市政府及大吉商行、小利商行"
    plan = {"organizations": [{"mentions": ["高雄市政府"], "action": "KEEP"}, {"mentions": ["大吉商行"], "action": "KEEP"}, {"mentions": ["小利商行"], "action": "MASK"}]}
    assert rendered(text, plan) == "於高雄市政府及機構甲、機構乙"
    note = '「高雄市政府(下稱市府)」應該遮罩成「機構甲(下稱機構甲)」'
    assert rendered(text, plan, notes=note) == "於機構甲及機構乙、機構丙"


def test_identifiers():
    plan = {"identifiers": [{"mention": "AB-1234", "category": "PLATE"}, {"mention": "000-0000", "category": "PLATE"}, {"mention": "x1", "category": "?", "replacement": "[x]"}]}
    assert rendered("車AB-1234與000-0000及x1", plan) == "車[車牌]與000-0000及[x]"


def test_dockets():
    assert rendering.mask_dockets("以112年度偵字第1234號起訴") == "以[案號]起訴"
    assert rendering.mask_dockets("最高法院99年度台上字第12號判決意旨") == "最高法院99年度台上字第12號判決意旨"
    text = rendering.mask_own_docket("臺灣某地方法院刑事判決114年度易字第484號 第663號\n被告甲 114年度易字第484號", COURT)
    assert text.count("[本案案號]") == 2 and "663" not in text
    with pytest.raises(ValueError):
        rendering.mask_own_docket("x", {"year": "114"})


def test_court_roles():
    text = "聲請人王大同與受刑人李大華均到庭。"
    table = rendering.court_replacements(text, {"persons": [person("PETITIONER", "王大同"), person("SENTENCED_PERSON", "李大華")]})
    assert rendering.render_court(text, table, COURT) == "聲請人甲與受刑人甲均到庭。"


def test_linked_aliases_win():
    registry = {"persons": [{"pair_person_id": "P01", "indictment_group_id": "g1", "alias": "被告丙"}], "unique_mentions": {}}
    table = rendering.court_replacements("被告王大同", {"persons": [person("DEFENDANT", "王大同", linked_indictment_group_id="g1")]}, pair_registry=registry)
    assert rendering.render("被告王大同", table) == "被告丙"


def test_fetched_decisions():
    text = rendering.normalize_court("分享 列印\n臺灣某某地方法院刑事判決\n主 文:被告無罪。\n犯罪事實及 理由 一、某事")
    assert text.startswith("臺灣某某地方法院刑事判決") and "\n主文\n被告無罪。" in text and "\n犯罪事實及理由\n一、某事" in text


def test_coarse_dates_keep_zero_births():
    assert rendering.generalize("民國000年00月00日生,民國75年3月4日生,112年3月4日10時20分") == "民國000年00月00日生,約西元1980年代出生,112年3月某日約10時"


def test_holdings():
    assert cleaning.clean_holding("被告甲犯犯罪事實欄所示之罪。 事實被告甲於某日行為。") == ("被告甲犯犯罪事實欄所示之罪。", True)
    cases = {"本件公訴不受理。": "procedural", "甲無罪。": "acquittal", "甲犯竊盜罪。": "conviction", "甲犯竊盜罪。乙無罪。": "mixed", "本件停止審判。": "interlocutory", "": "unknown"}
    assert {h: cleaning.classify_outcome(h) for h in cases} == cases


def documents():
    first = {"text": "被告王大同到場，甲○○亦在", "analysis_plan": {"persons": [person("DEFENDANT", "王大同", "阿明"), person("POLICE", "何小丙")], "identifiers": [{"mention": "ABC-1234", "category": "PLATE"}, {"mention": "000-000"}]}}
    second = {"text": "被告甲○○", "analysis_plan": {"persons": [person("DEFENDANT", "王大同"), person("JUDGE", "陳小乙")]}, "sections": {"主文": "甲犯竊盜罪。 理由 一"}}
    return first, second


def test_private_literals():
    first, second = documents()
    assert cleaning.private_literals(first) == {"王大同", "何小丙", "ABC-1234"}
    assert cleaning.private_replacements(first, second) == {"王大同": "被告甲", "何小丙": "員警甲", "陳小乙": "〇〇〇", "ABC-1234": "[車牌]"}
    assert cleaning.replace_literals({"王大同": ["王大同與ABC-1234"]}, {"王大同": "被告甲", "ABC-1234": "[車牌]"}) == ({"王大同": ["被告甲與[車牌]"]}, 1)
    assert cleaning.resolve_masks(["甲○○", "被告甲○○"], "被告甲○○到場") == (["被告甲", "被告甲"], 2)
    assert cleaning.resolve_masks(["甲○○"], "被告甲○○與證人甲○○") == (["甲○○"], 0)


def record(**more):
    step = {"claim_type": "fact", "evidence_ids": ["I-E001"], "support_snippets": ["到場"], "proposition": "王大同到場"}
    roles = {r: {"role": r, "reasoning_trace": [dict(step)], "new_evidence_claimed": []} for r in cleaning.ROLES}
    roles["judge"]["decision"] = {"target_holding": "x actual_target_holding"}
    return {"roles": roles, "evidence_catalog": [{"evidence_id": "I-E001"}], "target_holding": "x", "outcome_class": "unknown", **more}


def test_cleaning():
    out = cleaning.clean_record(record(), *documents())
    assert out["target_holding"] == "甲犯竊盜罪。" and out["outcome_class"] == "conviction" and out["quality"]["status"] == "recommended"
    assert "王大同" not in json.dumps(out["roles"]["defense"], ensure_ascii=False)
    assert out["cleaning"]["repairs_applied"] == ["holding_reextraction", "outcome_reclassification", "private_literal_replacement", "prompt_artifact_replacement"]
    assert cleaning.report([out])["status"] == {"recommended": 1}


def test_flags():
    assert cleaning.record_flags({"roles": {}}) == (["missing_role"], [])
    bad = record(outcome_class="interlocutory")
    bad["roles"]["prosecutor"]["reasoning_trace"][0]["evidence_ids"] = ["J-E001"]
    bad["roles"]["judge"]["note"] = "記載差異 甲○○"
    hard, review = cleaning.record_flags(bad, *documents())
    assert hard == ["judge_holding_mismatch", "non_final_interlocutory_order", "prosecutor_judgment_evidence_leak", "raw_private_literal_leak", "unknown_evidence_id", "unremoved_prompt_artifact"]
    assert review == ["cross_document_fact_conflict", "unresolved_masked_person_alias"]
    assert cleaning.broad_steps({"judge": {"reasoning_trace": [{"claim_type": "fact", "evidence_ids": list("abcdefgh")}, {"claim_type": "inference", "evidence_ids": list("abcdefgh")}]}}, 10) == 1


def test_planner(spark):
    plan = planner.local_plan("被告王大同持用0912345678號")
    assert plan["persons"][0]["mentions"] == ["王大同"] and plan["identifiers"][0]["category"] == "PHONE"
    assert planner.extract_json_object('```json\n[{"a": 1}]\n```') == {"a": 1}
    with pytest.raises(ValueError):
        planner.extract_json_object("[1, 2]")
    assert planner.canonical_digest({"b": 1, "a": 2}) != planner.canonical_digest({"b": 1, "a": 2}, spaced=True)
    assert [planner.retry_after(*a) for a in ((None, "Please retry in 59.5 s", 9), ("7", "", 9), (None, "", 9), ("1", "", 9))] == [62.5, 7.0, 9, 5.0]
    assert [planner.failure_kind(*a) for a in ((200, 10, True), (429, 10, None), (404, 1, None), (200, 30_000, True), (200, 1, None), (200, 1, False))] == [
        None, "transient_api_error", "api_request_error", "source_too_long_for_free_api", "empty_model_response", "invalid_model_response",
    ]
    cases = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c" * 160_001)], "id int, prompt string")
    plans = cases.where("id = 1").select(F.sha2("prompt", 256).alias("input_sha256"), F.lit("{}").alias("plan"))
    assert [[r.id for r in part.collect()] for part in planner.with_plans(cases, plans, F.col("prompt"))] == [[1], [2], [3]]
    done = spark.createDataFrame([("p", "prosecutor"), ("q", "prosecutor"), ("q", "defense"), ("q", "judge")], "pair_id string, role string")
    pairs = spark.createDataFrame([("p",), ("q",), ("r",)], "pair_id string")
    assert {r.pair_id: r.next_role for r in planner.role_order(done, pairs).collect()} == {"p": "defense", "q": None, "r": "prosecutor"}


def test_outline_of_a_decision():
    text = rendering.normalize_court("頁首\n福建某某地方法院刑事簡易判決\n聲 請 人 某\n判決如下: 主 文 甲無罪。 理由 一、某事。\n\n\n\n附 錄：法條")
    assert text.split("\n")[:6] == ["福建某某地方法院刑事簡易判決", "聲請人 某", "判決如下:", "主文", "甲無罪。", "理由"] and text.endswith("一、某事。\n\n附錄\n法條")


def test_docket_forms():
    text = "某法院108年度訴字第7、8號 第9號\n被告甲 另108年度訴字第7、8號，108,訴,7與108年 度訴字第7號及109年度訴字第7號"
    assert rendering.mask_own_docket(text, {"year": "108", "case_word": "訴", "number": "7"}) == (
        "某法院[本案案號]\n被告甲 另108年度訴字第7、8號，[本案案號]與[本案案號]及109年度訴字第7號"
    )
