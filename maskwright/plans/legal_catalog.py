"""Queries of the legal rule pack over a derived table, with what must come out written in SQL.

The driver's tables hold no Chinese text, so every customer becomes a small
document: a template filled with a name, a date, a number made from the key.
Both engines make the fields by the same expressions; SQL puts the expected
masks and aliases where Spark has to find them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import spread
from .catalog import query, table


def _pick(chars: str, shift: int) -> str:
    return f"substr('{chars}', cast((c_custkey + {shift}) % {len(chars)} + 1 as int), 1)"


def _name(surnames: str, shift: int) -> str:
    return f"concat({_pick(surnames, shift)}, {_pick('大小文志家美淑雅俊', shift)}, {_pick('華強偉芳娜敏靜傑勇慧濤', shift + 3)})"


#: fields of a document, in what both engines read alike
FIELDS = {
    "id": "c_custkey",
    "n1": _name("王李張劉陳楊趙", 0),
    "n2": _name("黃周吳徐孫", 1),
    "n3": _name("林郭何高羅鄭", 2),
    "n4": _name("謝宋唐許", 3),
    "y": "100 + c_custkey % 13",
    "m": "1 + c_custkey % 12",
    "d": "10 + c_custkey % 18",
    "h": "1 + c_custkey % 11",
    "p": "10000000 + c_custkey % 89999999",
    "q": "1000 + c_custkey % 8999",
    "k": "cast(c_custkey % 10 as int)",
    "x": _pick("甲乙丙丁戊己庚", 0),
    "city": "substr('臺北臺中臺南高雄桃園', cast(c_custkey % 5 as int) * 2 + 1, 2)",
    "shop": f"concat({_pick('日月星海', 1)}, {_pick('光輝昇', 2)}, {_pick('春夏秋冬', 3)})",
}
_BASE = f"(SELECT {', '.join(f'{v} AS {k}' for k, v in FIELDS.items())} FROM customer)"


def _fill(template: str) -> str:
    """A template with {fields} as a concatenation."""
    parts = []
    for i, piece in enumerate(template.replace("}", "{").split("{")):
        if piece:
            parts.append(piece if i % 2 else f"'{piece}'")
    return f"concat({', '.join(parts)})"


def _documents(spark, sf_dir, **columns: str) -> DataFrame:
    fields = table(spark, sf_dir, "customer").select(*[F.expr(v).alias(k) for k, v in FIELDS.items()])
    return fields.select("id", *[F.expr(v).alias(k) for k, v in columns.items()])


def _each(frame: DataFrame, f: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that ``f`` makes of each row."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([out for row in batch.itertuples(index=False) for out in f(*row)], columns=names)

    return spread(frame).mapInPandas(run, schema)


def _case(values: dict[int, str], other: str = "NULL") -> str:
    return "CASE k " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


# ---- the whole pack ----------------------------------------------------------------------------------------------

_STORY = "被告{n1}於民國{y}年{m}月{d}日{h}時20分持用09{p}號行動電話，致告訴人{n2}受有損害，證人{n3}於警詢證稱屬實（見警卷第{q}頁），處有期徒刑三月。檢察官{n4}提起公訴。"
#: normalisation makes commas narrow
_TOLD = "被告甲於民國{y}年{m}月某日約{h}時持用[電話]號行動電話，致告訴人乙受有損害，證人丙於警詢證稱屬實，處有期徒刑三月。檢察官〇〇〇提起公訴。".replace("，", ",")


@query(
    f"""SELECT id, {_fill(_TOLD)} AS text, concat(n1, '=甲|', n2, '=乙|', n3, '=丙|', n4, '=〇〇〇') AS people, 1::BIGINT AS n_references,
      true AS leak_pass, true AS semantic_pass FROM {_BASE}"""
)
def legal_deidentify(spark, sf_dir):
    """Normalisation, entities, references, masks and both checks over one document a customer."""
    from ..operators.documents import deidentify

    raw = _documents(spark, sf_dir, raw_text=_fill(_STORY)).withColumn("source_id", F.col("id").cast("string"))
    names = F.array_join(F.transform("people", lambda p: F.concat_ws("=", p["canonical_name"], p["alias"])), "|")
    return deidentify(raw).select(F.col("source_id").cast("long").alias("id"), "text", names.alias("people"), F.col("volume_citations_removed").alias("n_references"), "leak_pass", "semantic_pass")


# ---- people and organisations ------------------------------------------------------------------------------------

#: k -> (text, persons that must be found: name, role)
_PEOPLE = {
    0: ("被告{n1}於某日", [("n1", "DEFENDANT")]),
    1: ("被告 {n1} 男", [("n1", "DEFENDANT")]),
    2: ("證人{n1}、{n2}於警詢證稱", [("n1", "WITNESS"), ("n2", "WITNESS")]),
    3: ("署名「{n1}」之人", [("n1", "CO_OFFENDER")]),
    4: ("到場者有{n1}律師", [("n1", "DEFENSE_COUNSEL")]),
    5: ("其前妻{n1}。", [("n1", "CO_OFFENDER")]),
    6: ("向{n1}承租房屋", [("n1", "VICTIM")]),
    7: ("告訴人（{n1}）", [("n1", "COMPLAINANT")]),
    8: ("被告NGUYEN VAN AN於某日", [("'NGUYEN VAN AN'", "DEFENDANT")]),
    9: ("檢察官 {n1} 以上正本", [("n1", "PROSECUTOR")]),
}


@query(
    "SELECT * FROM (SELECT id, unnest([0, 1]) AS place, unnest(" + _case({k: "[" + ", ".join([*(n for n, _ in people), "NULL"][:2]) + "]" for k, (_, people) in _PEOPLE.items()})
    + ") AS name, unnest(" + _case({k: "[" + ", ".join([*(f"'{r}'" for _, r in people), "NULL"][:2]) + "]" for k, (_, people) in _PEOPLE.items()})
    + f") AS role FROM {_BASE}) WHERE name IS NOT NULL"
)
def legal_people(spark, sf_dir):
    """One cue of each kind."""

    def people(i: int, text: str) -> Iterator[tuple]:
        from ..functions.legal_zh import extract_people

        for place, person in enumerate(extract_people(text)):
            yield i, place, person["canonical_name"], person["role"]

    return _each(_documents(spark, sf_dir, text=_case({k: _fill(t) for k, (t, _) in _PEOPLE.items()})), people, "id long, place int, name string, role string")


_ORGS = "於臺灣{city}地方法院審理，前往{shop}股份有限公司(下稱{shop})，於{shop}旅館投宿，至台新銀行"


@query(
    f"""SELECT id, unnest([concat('臺灣', city, '地方法院'), concat(shop, '股份有限公司'), shop, concat(shop, '旅館'), '台新銀行']) AS name,
      unnest(['某地方法院', '機構甲', '機構甲', '機構乙', '機構丙']) AS alias FROM {_BASE}"""
)
def legal_organizations(spark, sf_dir):
    """Institutions, private organisations by cue and their short forms."""

    def organizations(i: int, text: str) -> Iterator[tuple]:
        from ..functions.legal_zh import extract_organizations

        for org in extract_organizations(text):
            yield i, org["canonical_name"], org["alias"]

    return _each(_documents(spark, sf_dir, text=_fill(_ORGS)), organizations, "id long, name string, alias string")


# ---- masks -------------------------------------------------------------------------------------------------------

_MARKED = (
    "證號B1{p}，信箱：u{q}@mail.tw，主機10.0.0.{d}，網址http://a.tw/{q}，手機09{p}，市話02-2{q}999，車AB-{q}，原車牌000-0000，"
    "{y}年度偵字第{q}號，帳戶：{p}11，LINE ID：user{q}，A0{d}在場，民國{y}年{m}月{d}日生，民國000年00月00日生，高雄市前金區中正路{d}號，{y}年{m}月{d}日{h}時5分"
)
_MASKS = (
    "證號[身分證字號]，信箱：[Email]，主機[IP]，網址[URL]，手機[電話]，市話[電話]，車[車牌]，原車牌000-0000，"
    "[案號]，帳戶[銀行帳號]，LINE帳號[社群帳號]，A0{d}在場，約西元{decade}年代出生，民國000年00月00日生，高雄市某處，{y}年{m}月某日約{h}時"
)
_DECADE = "(y + 1911) - (y + 1911) % 10"


@query(
    f"""SELECT id, {_fill(_MASKS)} AS text, 'BANK_ACCOUNT=1|CASE_NO=1|COURT_CODE_PRESERVED=1|EMAIL=1|EXACT_DATE=1|EXACT_TIME=1|IP=1|LANDLINE=1|MOBILE=1|PLATE=1|'
      || 'SOCIAL_ID=1|SOURCE_MASKED_BIRTH_PRESERVED=1|SOURCE_MASKED_PLATE_PRESERVED=1|TW_ID=1|URL=1' AS counts FROM (SELECT *, {_DECADE} AS decade FROM {_BASE})"""
)
def legal_masking(spark, sf_dir):
    """Every kind of identifier, what the source has masked, births, addresses, dates and times."""

    def masked(i: int, text: str) -> Iterator[tuple]:
        from ..functions.legal_zh import mask_identifiers

        out, counts = mask_identifiers(text)
        yield i, out, "|".join(f"{k}={n}" for k, n in sorted(counts.items()))

    return _each(_documents(spark, sf_dir, text=_fill(_MARKED)), masked, "id long, text string, counts string")


@query(f"SELECT id, {_fill('甲{q}乙丙，照片可佐丁')} AS text, 3::BIGINT AS n_references FROM {_BASE}")
def legal_file_references(spark, sf_dir):
    """References into the court's files, in and outside brackets."""

    def stripped(i: int, text: str) -> Iterator[tuple]:
        from ..functions.legal_zh import strip_file_references

        yield i, *strip_file_references(text)

    raw = "甲{q}（見本院卷第{d}頁）乙（警卷第{d}至{q}頁）丙，照片見警卷第{q}頁可佐丁"
    return _each(_documents(spark, sf_dir, text=_fill(raw)), stripped, "id long, text string, n_references long")


# ---- rendering ---------------------------------------------------------------------------------------------------

_CASE_TEXT = "被告{n1}與證人{n2}、{n3}到場，{n3}持{shop}商行之AB-{q}號車牌，車主{n4}律師未到"
_RENDERED = "被告甲與證人甲、人物甲到場，人物甲持機構甲之[車牌]號車牌，車主〇〇〇律師未到"


@query(f"SELECT id, {_fill(_RENDERED)} AS text, 5::BIGINT AS n_replacements FROM {_BASE}")
def legal_render(spark, sf_dir):
    """A plan's persons, organisations and identifiers as literal replacements."""

    def rendered(i: int, text: str, n1: str, n2: str, n3: str, n4: str, shop: str, plate: str) -> Iterator[tuple]:
        from ..operators.rendering import render, replacements

        persons = [("DEFENDANT", n1), ("WITNESS", n2), ("OTHER", n3), ("DEFENSE_COUNSEL", n4)]
        plan = {
            "persons": [{"role": r, "mentions": [n]} for r, n in persons],
            "organizations": [{"mentions": [f"{shop}商行"], "action": "MASK"}, {"mentions": ["不在文中之商行"], "action": "MASK"}],
            "identifiers": [{"mention": plate, "category": "PLATE"}, {"mention": "000-000"}],
        }
        table = replacements(text, plan)
        yield i, render(text, table), len(table) - 1  # the plate is counted apart

    columns = {"text": _fill(_CASE_TEXT), **{n: n for n in ("n1", "n2", "n3", "n4", "shop")}, "plate": _fill("AB-{q}")}
    return _each(_documents(spark, sf_dir, **columns), rendered, "id long, text string, n_replacements long")


# ---- pairs, roles, patches, cleaning -----------------------------------------------------------------------------


@query(
    f"""SELECT id, {_case({0: "'P01:甲'", 1: "'P02:乙'", 2: "'P01:甲'"}, "'none'")} AS resolved, k = 4 AS ambiguous, k <> 4 AND k <> 5 AS passes, {_case({5: "n1"}, "''")} AS leaks FROM {_BASE}"""
)
def pair_registry(spark, sf_dir):
    """A case's registry, the other document's person found in it, and the checks of the clean texts."""

    def paired(i: int, k: int, n1: str, n2: str) -> Iterator[tuple]:
        from ..functions.legal_zh import PROFESSIONAL
        from ..operators.pairing import augmented, build_registry, deterministic_checks, resolve

        second = n1 if k == 4 else n2
        persons = [{"group_id": "g1", "role": "DEFENDANT", "mentions": [n1]}, {"group_id": "g2", "role": "WITNESS", "mentions": [second]}]
        registry = build_registry(persons, [(n1, "甲"), (n2, "乙")])
        asked = {0: {"mentions": [" ".join(n1)]}, 1: {"mentions": [n2, "某人"]}, 2: {"mentions": ["某人"], "linked_indictment_group_id": "g1"}}.get(k, {"mentions": [n1 if k == 4 else "某人"]})
        hit = resolve(asked, registry)
        registry = augmented(registry, [asked])
        checks = deterministic_checks({"indictment": f"被告甲與{n1 if k == 5 else '乙'}到場"}, {"indictment": [n1, "A01"]}, registry["persons"], PROFESSIONAL)
        leaks = "|".join(x["mention"] for x in checks["exact_person_mention_leaks"])
        yield i, f"{hit['pair_person_id']}:{hit['alias']}" if hit else "none", registry["manual_review_required"], checks["pass"], leaks

    return _each(_documents(spark, sf_dir, k="k", n1="n1", n2="n2"), paired, "id long, resolved string, ambiguous boolean, passes boolean, leaks string")


_ROLE_FAULTS = {1: "unknown_evidence_id", 2: "snippet_not_in_sources", 3: "holding_mismatch", 4: "new_evidence_claimed", 5: "brief_without_evidence", 6: "missing_issues", 7: "step_without_snippet"}


@query(f"SELECT id, {_case({k: f'{chr(39)}{v}{chr(39)}' for k, v in _ROLE_FAULTS.items()}, chr(39) * 2)} AS errors FROM {_BASE}")
def role_validation(spark, sf_dir):
    """A judge's role with one fault or none."""

    def validated(i: int, k: int, source: str, holding: str) -> Iterator[tuple]:
        from ..operators.grounding import role_errors

        cite = [{"evidence_ids": ["I-E001"]}]
        step = {"evidence_ids": ["J-E9" if k == 1 else "I-E001"], "support_snippets": [] if k == 7 else ["另一句話" if k == 2 else source[2:12].replace("於", " 於")]}
        decision = {"target_holding": holding + "。" * (k == 3), "issue_findings": cite, "response_to_prosecution": cite, "response_to_defense": cite, "rationale": [{}] if k == 5 else cite}
        role = {"role": "judge", "issues": [] if k == 6 else ["罪責"], "reasoning_trace": [step], "decision": decision, "new_evidence_claimed": ["新證人"] if k == 4 else []}
        yield i, "|".join(role_errors(role, "judge", {"I-E001"}, [source], holding))

    return _each(_documents(spark, sf_dir, k="k", source=_fill("被告{n1}於{y}年間到場，隨即離去"), holding=_fill("{n1}無罪")), validated, "id long, errors string")


@query(
    f"""SELECT id, {_case({0: "'acquittal'", 1: "'conviction'", 2: "'procedural'", 3: "'mixed'"}, "'conviction'")} AS outcome,
      {_case({4: "'rejected'", 5: "'needs_review'"}, "'recommended'")} AS status, {_case({4: "'unknown_evidence_id'", 5: "'cross_document_fact_conflict'"}, "''")} AS flags,
      {_case({6: "'holding_reextraction|private_literal_replacement'", 7: "'holding_reextraction|legal_rule_citation_migration'"}, "'holding_reextraction'")} AS repairs FROM {_BASE}"""
)
def record_cleaning(spark, sf_dir):
    """Records repaired, flagged and tiered."""

    def cleaned(i: int, k: int, n1: str) -> Iterator[tuple]:
        from ..operators.cleaning import ROLES, clean_record

        holding = {0: "甲無罪。", 2: "本件公訴不受理。", 3: "甲犯竊盜罪。乙無罪。"}.get(k, "甲犯竊盜罪。")
        step = {"claim_type": "fact", "evidence_ids": ["X-E9" if k == 4 else "I-E001"], "support_snippets": ["到場"], "proposition": f"{n1 if k == 6 else '被告甲'}到場"}
        rule = {"claim_type": "legal_rule", "evidence_ids": ["I-E001"], "support_snippets": ["到場"]}
        roles = {r: {"role": r, "reasoning_trace": [dict(rule if k == 7 and r == "judge" else step)], "new_evidence_claimed": []} for r in ROLES}
        roles["judge"]["decision"] = {"target_holding": "x", "note": "兩者記載差異" if k == 5 else ""}
        outcome = {0: "acquittal", 2: "procedural", 3: "mixed"}.get(k, "conviction")
        record = {"roles": roles, "evidence_catalog": [{"evidence_id": "I-E001"}], "target_holding": "x", "outcome_class": outcome}
        first = {"text": f"被告{n1}到場", "analysis_plan": {"persons": [{"role": "DEFENDANT", "mentions": [n1]}]}}
        out = clean_record(record, first, {"text": "被告甲", "analysis_plan": {"persons": []}, "sections": {"主文": holding}})
        yield i, out["outcome_class"], out["quality"]["status"], "|".join(out["quality"]["hard_flags"] + out["quality"]["review_flags"]), "|".join(out["cleaning"]["repairs_applied"])

    return _each(_documents(spark, sf_dir, k="k", n1="n1"), cleaned, "id long, outcome string, status string, flags string, repairs string")


_PATCHED = {
    0: ("'被告甲到場'", "''"), 1: ("'被告丙到場'", "'applied'"), 2: ("'被告丙[略]'", "'applied|applied'"), 3: ("'被告甲到場'", "'skipped'"),
    4: ("'被告甲到場'", "'applied'"), 5: ("'被告甲到場'", "'skipped'"), 6: ("'被告甲到場'", "'applied'"), 7: ("'被告甲到場'", "'already_satisfied'"),
}


@query(f"SELECT id, {_case({k: t for k, (t, _) in _PATCHED.items()}, _PATCHED[0][0])} AS text, {_case({k: s for k, (_, s) in _PATCHED.items()}, _PATCHED[0][1])} AS statuses FROM {_BASE}")
def patch_apply(spark, sf_dir):
    """Patch plans applied to linked records, structural operations first."""

    def patched(i: int, k: int, n1: str) -> Iterator[tuple]:
        from ..operators.patching import apply_plan

        record = {"text": "被告甲到場", "evidence": [], "analysis_plan": {"persons": [{"group_id": "g1", "role": "DEFENDANT", "mentions": [n1]}]}}
        person = {"pair_person_id": "P01", "alias": "被告甲", "role": "DEFENDANT", "indictment_mentions": [n1], "judgment_mentions": []}
        case = {"raw": {"indictment": f"{n1}到場", "judgment": f"{n1}到場"}, "indictment": record, "judgment": json.loads(json.dumps(record)), "registry": {"persons": [person], "unique_mentions": {}}}
        alias = {"op": "SET_ALIAS", "document": "pair", "pair_person_id": "P01", "alias": "被告丙"}
        span = {"op": "MASK_SPAN", "document": "judgment", "field_path": "/text", "old_text": "到場", "replacement": "[略]", "source_quote": n1}
        link = {"op": "LINK_PERSON", "document": "judgment", "pair_person_id": "P01", "mentions": [n1], "source_quote": n1}
        plans = {1: [alias], 2: [span, alias], 3: [{**link, "pair_person_id": "P99"}], 4: [link], 5: [{"op": "MARK_FALSE_POSITIVE"}]}
        plans[6] = [{"op": "REMOVE_REGISTRY_MENTION", "document": "pair", "pair_person_id": "P01", "mentions": [n1]}]
        plans[7] = [{**span, "old_text": "離去", "replacement": "到場"}]
        done = apply_plan(case, {"operations": plans.get(k, [])})
        yield i, done["case"]["judgment"]["text"], "|".join(o["status"] for o in done["operations"])

    return _each(_documents(spark, sf_dir, k="k", n1="n1"), patched, "id long, text string, statuses string")


# ---- evidence, history, review -----------------------------------------------------------------------------------

_THING = "substr('手機帳冊現金', cast(l_partkey % 3 as int) * 2 + 1, 2)"


@query(
    f"""WITH a AS (SELECT l_orderkey AS pair, {_THING} AS key, 'indictment' AS src FROM lineitem UNION ALL SELECT l_orderkey, CASE WHEN l_linenumber = 4 THEN 'given' ELSE {_THING} END, 'judgment' FROM lineitem)
    SELECT pair, key, array_to_string(list_sort(list(DISTINCT src)), '|') AS provenance, count(*)::BIGINT AS n_source_records FROM a GROUP BY 1, 2"""
)
def evidence_content_union(spark, sf_dir):
    """Evidence named in different words, merged by content."""
    from ..operators.cases import evidence_keys
    from ..operators.relational import union_with_provenance

    items = table(spark, sf_dir, "lineitem")
    place = F.expr("l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + bigint(l_quantity)").alias("ord")
    counted = F.expr(f"concat({_THING}, ' ', cast(cast(l_quantity as int) as string), '支')")
    filed = F.expr(f"concat({_THING}, '（卷內可佐）', '１', '件')")
    given = F.when(F.col("l_linenumber") == 4, " given ")
    left = items.select(F.col("l_orderkey").alias("pair"), place, counted.alias("name"), F.lit(None).cast("string").alias("given"))
    right = items.select(F.col("l_orderkey").alias("pair"), place, filed.alias("name"), given.alias("given"))
    keyed = {k: v.withColumn("key", evidence_keys(F.col("given"), F.lit("物"), F.col("name"))) for k, v in (("indictment", left), ("judgment", right))}
    merged = union_with_provenance(keyed, F.col("key"), ["key"], scope=["pair"])
    return merged.select("pair", F.element_at(F.split("key", ":"), -1).alias("key"), "provenance", "n_source_records")


@query(
    """WITH n AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber <= 2)::BIGINT AS now, count(*) FILTER (WHERE l_linenumber > 2)::BIGINT AS before FROM lineitem GROUP BY 1)
    SELECT l_orderkey, greatest(now, before) AS n_kept, CASE WHEN before > now THEN 'previous_human_reviewed_best' ELSE 'hybrid_analysis' END AS evidence_source FROM n"""
)
def prior_evidence(spark, sf_dir):
    """An earlier evidence list stays where it is the longer one."""
    from ..operators.cases import longer_evidence

    part = lambda when: F.collect_list(F.when(when, F.col("l_partkey")))
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(part(F.col("l_linenumber") <= 2).alias("now"), part(F.col("l_linenumber") > 2).alias("before"))
    kept, source = longer_evidence(F.col("now"), F.col("before"))
    return lists.select("l_orderkey", F.size(kept).cast("long").alias("n_kept"), source.alias("evidence_source"))


@query(
    """WITH h AS (SELECT event_id AS id, user_id, event_type FROM events WHERE event_id % 500 <> 0)
    SELECT * FROM h UNION ALL SELECT (SELECT max(id) FROM h) + row_number() OVER (ORDER BY event_id) AS id, user_id, event_type FROM events WHERE event_id % 500 = 0"""
)
def history_append(spark, sf_dir):
    """Saved reviews numbered on at the end of the history."""
    from ..operators.review import append_history

    events = table(spark, sf_dir, "events")
    return append_history(events.where("event_id % 500 <> 0").select(F.col("event_id").alias("id"), "user_id", "event_type"), events.where("event_id % 500 = 0"), "event_id")


@query(
    """SELECT o_orderkey AS pair_id, md5(c_name) AS raw_indictment_md5, length(d.text)::BIGINT AS n_judgment FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN documents d ON d.doc_id = o_orderkey WHERE d.text IS NOT NULL"""
)
def reaudit_cases(spark, sf_dir):
    """Patched copies joined with the raw texts of both documents."""
    from ..operators import cases

    patched = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pair_id"), F.col("o_orderkey").alias("judgment_internal_id"), F.col("o_custkey").alias("linked_indictment_doc_id"))
    indictments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.col("c_name").alias("text"))
    judgments = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("judgment_internal_id"), "text")
    found = cases.reaudit_cases(patched, indictments, judgments)
    return found.select("pair_id", F.md5("raw_indictment").alias("raw_indictment_md5"), F.length("raw_judgment").cast("long").alias("n_judgment"))


_TERMS = ["the", "them", "th", "a.", "é"]
_TERM_SQL = "them|the|a\\.|th|é"


@query(
    f"""WITH t AS (SELECT conv_id, turn, text, regexp_extract_all(text, '{_TERM_SQL}') AS f, string_split_regex(text, '{_TERM_SQL}') AS g FROM conversations WHERE text IS NOT NULL)
    SELECT conv_id, turn, array_to_string(list_transform(range(1, len(f) + 1), lambda i: (list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: len(x))), 0))::BIGINT
      || '-' || (list_sum(list_transform(g[1:i], lambda x: len(x))) + list_sum(list_transform(f[1:i], lambda x: len(x))))::BIGINT), ',') AS spans FROM t"""
)
def highlight_spans(spark, sf_dir):
    """Where a reviewer's terms are highlighted."""
    from ..functions.identifiers import highlight_spans as spans

    joined = F.array_join(F.transform(spans(F.col("text"), _TERMS), lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", joined.alias("spans"))
