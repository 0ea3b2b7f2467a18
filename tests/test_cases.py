"""Assembly of linked cases; all names are invented."""

from pyspark.sql import functions as F

from maskwright.operators import cases


def frames(spark):
    evidence = "array<struct<name:string>>"
    indictments = spark.createDataFrame([("i1", "M-1", "abc", [("照片",)]), ("i2", "other", "abc", [])], f"doc_id string, model string, text string, evidence {evidence}")
    rows = [("j1", "p1", "i1", "m-1", "xy", {"主文": "有罪"}, 1, [("筆錄",)]), ("j2", "p1", "i1", "m-1", "late", {"主文": "有罪"}, 2, []), ("j3", "p3", "i1", "m-1", "z", {"主文": " "}, 3, []), ("j4", "p4", "i2", "m-1", "z", {"主文": "有罪"}, 4, [])]
    judgments = spark.createDataFrame(rows, f"doc_id string, pair_id string, linked_indictment_doc_id string, model string, text string, sections map<string,string>, ord int, evidence {evidence}")
    return indictments, judgments


def test_generation_pairs(spark):
    pairs = cases.generation_pairs(*frames(spark), "M-1")
    assert [(r.pair_id, r.doc_id, r.source_chars) for r in pairs.collect()] == [("p1", "j1", 5)]
    row = cases.case_materials(pairs).first()
    assert [e.evidence_id for e in row.all_evidence] == ["I-E001", "J-E001"] and row.prosecutor_sources == ["abc"] and row.court_sources == ["abc", "xy"]


def test_complete_cases(spark):
    indictments, judgments = frames(spark)
    raw = spark.createDataFrame([("j1", "raw"), ("j2", " ")], "doc_id string, text string")
    full, missing = cases.complete_cases(judgments, indictments, indictments.where("doc_id = 'i1'"), raw)
    assert [r.doc_id for r in full.collect()] == ["j1"] and sorted(r.doc_id for r in missing.collect()) == ["j2", "j3", "j4"]


def test_links_and_ids(spark):
    df = spark.createDataFrame([([("a ",), (" ",)], "http://x")], "links array<struct<barcode:string>>, url string")
    row = df.select(cases.linked_source_ids(F.col("links"), "NS").alias("l"), cases.judgment_internal_id(F.col("url")).alias("i")).first()
    assert row.l == ["NS:a"] and len(row.i) == 64


def test_public_pairs_show_no_mentions(spark):
    people = spark.createDataFrame([("p1", "P02", "WITNESS", "證人甲", "林小甫"), ("p1", "P01", "DEFENDANT", "被告甲", "王大同")], "pair_id string, pair_person_id string, role string, alias string, mention string")
    texts = spark.createDataFrame([("p1", "a", "b")], "pair_id string, clean_indictment string, clean_judgment string")
    row = cases.public_pairs(texts, people).first().asDict(recursive=True)
    assert [e["pair_person_id"] for e in row["pair_entities"]] == ["P01", "P02"] and "王大同" not in str(row)


def test_answers(spark):
    good = '{"role": "judge", "reasoning_trace": [{"claim_type": "fact"}]}'
    answers = [good, good.replace("fact", "guess"), "{}", "no", '{"role": "judge", "reasoning_trace": []}']
    df = spark.createDataFrame([(a,) for a in answers], "answer string")
    assert [r.parse_error for r in cases.parse_role(df).collect()] == [None, "unknown_claim_type", "missing_role", "not_json", "missing_trace"]
