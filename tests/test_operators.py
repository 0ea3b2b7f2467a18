"""Relational operators, sources and incremental runs on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from maskwright.functions import identifiers as ids
from maskwright.operators import documents, ranking, relational, review, tiering
from maskwright.sources import html, jsonl
from maskwright.streaming import incremental


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_scopes(spark):
    cases = spark.createDataFrame([(i,) for i in "abcd"], "id string")
    done, failed = spark.createDataFrame([("a",), ("d",)], "id string"), spark.createDataFrame([("b",), ("d",), ("b",)], "id string")
    for scope, want in {"pending": "c", "errors": "b", "rendered": "ad", "all": "abcd"}.items():
        assert "".join(r[0] for r in rows(relational.select_scope(cases, "id", scope, done, failed, [F.col("id")]))) == want
    assert relational.select_scope(cases, "id", "all", done, failed, [F.col("id")], 2).count() == 2
    with pytest.raises(ValueError):
        relational.select_scope(cases, "id", "some", done, failed)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_order_does_not_depend_on_partitions(spark, partitions):
    df = spark.createDataFrame([("k", i, f"v{i}") for i in range(50)], "k string, ord int, v string").repartition(partitions)
    assert rows(relational.last_wins(df, ["k"], "ord")) == [("k", 49, "v49")]
    assert rows(relational.first_wins(df, ["k"], "ord")) == [("k", 0, "v0")]
    merged = relational.upsert(df.where("ord < 5"), df.where("ord >= 5").withColumn("v", F.concat("v", F.lit("!"))), ["k"], "ord", ["v"])
    assert rows(merged.select("k", "ord", "v")) == [("k", 49, "v0")]


def test_lookup_keeps_the_order_asked_for(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r[0] for r in relational.ordered_lookup(df, "k", [7, 3, 7, 99, 1]).collect()] == [7, 3, 1]


def test_exactly_one_link(spark):
    links = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 9), ("c", 2)], "s string, t int")
    targets = spark.createDataFrame([(1,), (2,)], "t int")
    assert rows(relational.exactly_one_link(links, targets, "s", "t"), "s") == [("a", 1), ("c", 2)]


def test_union_with_provenance(spark):
    left = spark.createDataFrame([("p", 0, "照片3張"), ("p", 1, ""), ("p", 2, "")], "pair string, ord int, name string")
    right = spark.createDataFrame([("p", 0, "照片"), ("p", 1, "筆錄")], "pair string, ord int, name string")
    key = F.regexp_replace("name", "各?[0-9]+[份張件]", "")
    out = relational.union_with_provenance({"indictment": left, "judgment": right}, key, ["name"], "E%03d", ["pair"])
    assert rows(out.select("evidence_id", "name", "provenance", "n_source_records"), "evidence_id") == [
        ("E001", "照片3張", "indictment|judgment", 2), ("E002", "", "indictment", 1), ("E003", "", "indictment", 1), ("E004", "筆錄", "judgment", 1),
    ]


def test_contains_pairs(spark):
    texts = spark.createDataFrame([(1, "x one two three four five y"), (2, "nothing here"), (3, None)], "t int, text string")
    quotes = spark.createDataFrame([(1, "ne two three four fiv"), (2, "here"), (3, "zzz one two three q")], "q int, quote string")
    assert rows(relational.contains_pairs(texts, quotes, "text", "quote").select("t", "q"), "t", "q") == [(1, 1), (2, 2)]


def test_map_merge(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 3})], "l map<string,int>, r map<string,int>")
    assert df.select(relational.map_merge("l", "r")).first()[0] == {"a": 1, "b": 3}


def test_budget_latches(spark):
    df = spark.createDataFrame([("s", i, c) for i, c in enumerate([4, 4, 4, 0])], "s string, ord int, cost int")
    assert [r.admitted for r in ranking.admit_within_budget(df, ["s"], "ord", "cost", 8).orderBy("ord").collect()] == [True, True, False, False]


def test_percentile_is_nearest_rank(spark):
    values = [5, 1, 9, 9, 3, 7, 2]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for share in (0.0, 0.5, 0.95, 1.0):
        assert ranking.percentile_floor(df, "v", share) == sorted(values)[int(share * (len(values) - 1))]
    assert ranking.percentile_floor(df.where("v > 99"), "v", 0.5) is None


def test_aliases(spark):
    df = spark.range(25).select(ranking.alias_suffix(F.col("id")).alias("a"), ranking.alias_suffix(F.col("id"), legacy=True).alias("l"))
    got = df.collect()
    assert got[0].a == "甲" and got[21].a == "亥" and got[22].a == "23" and got[22].l == "甲"


def test_limits():
    assert [ranking.clamp(v, 1, 1000, 200) for v in ("5", "-1", "9999", "x", None)] == [5, 1, 1000, 200, 200]


def test_generic_masks_leave_nothing(spark):
    text = 'mail a.b@c.org from 10.1.2.3, card 4111111111111111, +1 (555) 555-0100, token = "abcdef1234", https://x.org/a?b=1 AB-1234'
    df = spark.createDataFrame([(text,), ("",), (None,)], "text string")
    masked, counts = ids.apply_rules(F.coalesce("text", F.lit("")))
    first = df.select(masked.alias("m"), counts.alias("c")).withColumn("left", ids.leak_counts(F.col("m"))).collect()
    assert first[0].c == {k: 1 for k in ("SECRET", "EMAIL", "URL", "IP", "CARD", "PHONE", "PLATE")}
    assert sum(first[0].left.values()) == 0 and first[1].m == "" and first[2].m == ""


def test_reviews(spark):
    cases = spark.createDataFrame([(1, "a", True, 2), (2, "a", True, 1), (3, "b", False, None)], "id int, case_type string, in_sample boolean, sample_rank int")
    reviews = spark.createDataFrame([(1, "pass", ["x", "y"])], "id int, decision string, issues array<string>")
    desk = review.ReviewStore(cases, reviews, "id", ["case_type"])
    assert [r.id for r in desk.cases().collect()] == [2, 1] and [r.id for r in desk.cases("all", "pending").collect()] == [2, 3]
    assert rows(desk.stats()) == [(3, 2, 1, 0, 0)] and rows(desk.facets()) == [("a", 2), ("b", 1)]
    assert desk.export().first().issues == "x|y" and [r.id for r in desk.public(["id"]).orderBy("id").collect()] == [2, 3]
    body = spark.createDataFrame([("pass", "low", ["x"], "n", "r"), ("maybe", "huge", ["z"], "n" * 10001, "r" * 101)], "d string, s string, i array<string>, n string, r string")
    errors = [r[0] for r in body.select(review.review_errors(F.col("d"), F.col("s"), F.col("i"), F.col("n"), F.col("r"), ["x"])).collect()]
    assert errors == [[], ["invalid_decision", "invalid_severity", "unknown_issue", "notes_too_long", "reviewer_too_long"]]


def test_tiers(spark):
    df = spark.createDataFrame([("無罪",), ("有期徒刑並無罪",), ("不明",)], "t string")
    assert [r[0] for r in df.select(tiering.classify(F.col("t"), {"acquittal": "無罪", "conviction": "有期徒刑"})).collect()] == ["acquittal", "mixed", "unknown"]
    tiers = spark.createDataFrame([(["x"], []), ([], ["y"]), ([], [])], "hard_flags array<string>, review_flags array<string>")
    assert [r.status for r in tiering.with_tier(tiers).collect()] == ["rejected", "needs_review", "recommended"]


def test_documents(spark):
    df = spark.createDataFrame([("s1", "被告王大同於某日持用0912345678號，處有期徒刑。"), ("s2", None)], "source_id string, raw_text string")
    out = documents.with_stable_ids(documents.deidentify(df), spark.createDataFrame([("s1", "known")], "source_id string, doc_id string")).persist()
    tables = documents.output_tables(out)
    assert tables["clean"].where("doc_id = 'known'").first().text == "被告甲於某日持用[電話]號,處有期徒刑。"  # folded
    assert all(t.count() == 2 for t in tables.values())
    report = json.loads(documents.manifest_json(out))
    assert report["documents"] == 2 and report["mask_counts"]["MOBILE"] == 1 and report["leakage_passed"] == 2
    out.unpersist()


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    (tmp_path / "a.jsonl").write_text('{"a": 1, "b": null}\n\n{"a": 2, "b": "x y"}\n', encoding="utf-8")
    assert rows(jsonl.read_jsonl(spark, path, "a int, b string"), "a") == [(1, None), (2, "x y")]
    assert jsonl.read_jsonl(spark, path + ".none", "a int", missing_ok=True).count() == 0
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n[1]\nnot json\n', encoding="utf-8")
    good, bad = jsonl.read_jsonl_quarantined(spark, str(tmp_path / "b.jsonl"), "a int")
    assert rows(good) == [(1,)] and sorted(r.line for r in bad.collect()) == ["[1]", "not json"]
    jsonl.write_jsonl(jsonl.read_jsonl(spark, path, "a int, b string").coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert '"b":null' in text
    jsonl.write_csv(jsonl.read_jsonl(spark, path, "a int, b string"), str(tmp_path / "csv"))
    assert next((tmp_path / "csv").glob("part-*")).read_text(encoding="utf-8").startswith("﻿a,b")
    order = spark.createDataFrame([(2, 0), (1, 1)], "a int, ord int")
    jsonl.write_snapshot(jsonl.read_jsonl(spark, path, "a int, b string"), str(tmp_path / "snap"), order, "a")
    assert jsonl.read_jsonl(spark, str(tmp_path / "snap"), "a int, b string").count() == 2


def test_html():
    page = '<html><head><title> A  b </title><style>x</style></head><body><p>one<br>two</p><script>s()</script><div id="jud"> in <b>side</b></div></body></html>'
    assert html.read_html(page, ()) == ("A b", "one\ntwo\nin side")
    assert html.read_html(page) == ("A b", "in side")
    assert html.read_html("") == ("", "")


def test_links(spark):
    df = spark.createDataFrame([("<a href='/x'>1</a><a href=\"http:\\/\\/h.org\\/y\">2</a><a href='/x'>3</a>", "http://b.org/p")], "h string, u string")
    assert df.select(html.absolute_links(F.col("h"), F.col("u"))).first()[0] == ["http://b.org/x", "http://h.org/y"]
    urls = spark.createDataFrame([(["u?d=2024%2D01", "u?d=2"], "2024-01"), (["only"], "z"), (["a", "b"], "z")], "u array<string>, p string")
    assert [r[0] for r in urls.select(html.choose_url(F.col("u"), F.col("p"))).collect()] == ["u?d=2024%2D01", "only", None]


def test_resuming_does_each_row_once(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = spark.range(5).withColumnRenamed("id", "k")
    first.write.parquet(source)
    work = lambda df: df.withColumn("done", F.col("k") * 2)
    run = lambda: incremental.run_available(spark, source, first.schema, out, check, work)
    run()
    run()
    spark.range(5, 8).withColumnRenamed("id", "k").write.mode("append").parquet(source)
    run()
    assert rows(spark.read.parquet(out).select("k", "done"), "k") == [(i, 2 * i) for i in range(8)]
    left = incremental.resume_batch(spark.range(9).withColumnRenamed("id", "k"), spark.read.parquet(out), "k", work)
    assert rows(left) == [(8, 16)]
    tries = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "x"), ("b", 3, "y")], "k string, ord int, error string")
    assert rows(incremental.dead_letters(tries, "k", "ord").select("k", "error")) == [("b", "y")]


def test_highlights_are_regex_safe(spark):
    from maskwright.functions.identifiers import highlight_spans

    df = spark.createDataFrame([("a+b a+b+c (x) é",), ("",), (None,)], "t string")
    got = [r.s for r in df.select(highlight_spans(F.col("t"), ["a+b", "a+b+c", "(x)", "é", ""]).alias("s")).collect()]
    assert [tuple(x) for x in got[0]] == [(0, 3), (4, 9), (10, 13), (14, 15)] and not got[1] and not got[2]


def test_growing_checkpoint(spark, tmp_path):
    from maskwright.streaming.incremental import sync_checkpoint

    def sync():
        return sorted(tuple(r) for r in sync_checkpoint(spark, str(tmp_path / "in"), "k string, n int, v string", str(tmp_path / "state"), str(tmp_path / "log"), "k", "n").collect())

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": "x", "n": 1, "v": "old"}\n{"k": "y", "n": 1, "v": "only"}\n')
    assert sync() == [("x", 1, "old"), ("y", 1, "only")]
    (tmp_path / "in" / "b.json").write_text('{"k": "x", "n": 2, "v": "new"}\n{"k": "y", "n": 0, "v": "late"}\n')
    assert sync() == [("x", 2, "new"), ("y", 1, "only")] == sync()
