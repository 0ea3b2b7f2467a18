"""What made queries grow faster than their input, or run in one task."""

import re

import pytest

from maskwright.functions import legal_zh as zh
from maskwright.operators import documents, relational


def _stories(n):
    given = "大小文志家美淑雅俊華強偉芳娜敏靜傑勇慧濤"
    name = lambda s, i: s + given[i % 20] + given[i // 20 % 20]
    return [f"被告{name('王', i)}於民國104年3月15日7時20分持用0912345{i % 1000:03d}號行動電話，致告訴人{name('黃', i)}受有損害，證人{name('林', i)}於警詢證稱屬實（見警卷第{i}頁）。" for i in range(n)]


@pytest.fixture
def compiled(monkeypatch):
    seen = []
    compile_ = re._compiler.compile
    monkeypatch.setattr(re._compiler, "compile", lambda p, *a: seen.append(p) or compile_(p, *a))
    return seen


def test_no_pattern_is_compiled_for_a_text(compiled):
    texts = _stories(800)
    zh.deidentify(texts[0])
    compiled.clear()
    for text in texts:
        assert zh.deidentify(text)["text"].startswith("被告甲於民國104年3月某日約7時持用[電話]號")
    assert not compiled


def test_long_work_is_dealt_to_all_cores(spark):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(_stories(64))], "source_id string, raw_text string").coalesce(1)
    results = documents.deidentify(rows)
    cores = spark.sparkContext.defaultParallelism
    assert results.rdd.getNumPartitions() >= cores
    assert results.where("leak_pass and semantic_pass and size(people) = 3 and mask_counts['MOBILE'] = 1").count() == 64
    assert relational.spread(rows).rdd.getNumPartitions() >= cores


def test_words_are_replaced_as_by_an_alternation():
    table = {"王大": "1", "王大華": "2", "大華": "3", "華": "4", "甲": "王"}
    for text in ("", "王大華", "王大大華華", "甲大華王", "王王大甲華"):
        assert zh.replace_words(text, table) == re.sub("王大華|王大|大華|華|甲", lambda m: table[m[0]], text)
    assert zh.replace_words("ab", {"": "-"}) == "-a-b-"


def test_few_stretches_are_compared_in_full(monkeypatch):
    from difflib import SequenceMatcher

    from maskwright.operators.grounding import closest_quote

    tried = []
    set_seq1 = SequenceMatcher.set_seq1
    monkeypatch.setattr(SequenceMatcher, "set_seq1", lambda self, a: tried.append(a) or set_seq1(self, a))
    filler = " ".join(f"there were then {i} other things of the other kind" for i in range(200))
    quote = "the thing that there was then was none of the other kind at all"
    text = f"{filler}. So {quote}, {filler}"
    assert closest_quote(quote[:20] + "#" + quote[21:], [filler, text]) == quote
    assert len(tried) < 200  # all stretches with a piece in common are some 50,000


AWKWARD = (
    None, "", "no identifier at all", "password: abcdefgh", "api_key=abc123XYZ and token = \"abcdef\"", "secret abcdef", "a.b@c.org,@,x@y", "see www.a.b/c https://x http://", "1.2.3.4 and 10.0.0.1.5, 1.2",
    "4111111111111111 41111111111111112", "+1 (555) 123-4567 (555) 1234567", "AB-1234, ab-12, A-B, --AB-CD", "token=ab@c.org www.x-y.zz 1.2.3.4-AB-12", "é@ü.org Ａ-Ｂ １.２.３.４",
)


def test_a_rule_finds_the_same_with_and_without_its_words(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from maskwright.functions import identifiers as ids

    bare = tuple(replace(r, needs=(), hint=None) for r in ids.GENERIC)
    df = spark.createDataFrame([(t,) for t in AWKWARD], "t string")
    for text in (F.col("t"), F.coalesce("t", F.lit(""))):
        for row in df.select("t", ids.masked(text).alias("a"), ids.masked(text, bare).alias("b"), ids.leak_counts(text).alias("c"), ids.leak_counts(text, bare).alias("d")).collect():
            assert row.a == row.b and row.c == row.d, row.t


def test_rules_are_tried_where_their_words_are(spark):
    from maskwright.plans import catalog

    from tests.test_catalog import SF_DIR

    for name in ("leak_manifest", "mask_identifiers"):
        plan = catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "contains(" in plan and "rlike" in plan


def test_a_text_is_read_once_for_its_content(spark, tmp_path):
    from maskwright.plans import catalog

    plan = catalog.QUERIES["fact_union"]
    texts = ["Ab, c1!", "aB c１1", "a.b.c.1", "É—", "", None, "zz"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "ABC1"), (8, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = plan(spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 2
    assert sorted(map(tuple, found.select("provenance", "n_source_records", "first_id").collect())) == [("document", 1, 6), ("document|item", 4, 0)]


def test_count_maps_are_made_once(spark):
    from pyspark.sql import functions as F

    from maskwright.operators.ranking import explode_counts
    from maskwright.plans import catalog

    from tests.test_catalog import SF_DIR

    plan = catalog.QUERIES["mask_counts_manifest"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[A-Za-z0-9.-]+\\.[A-Za-z]{2,}") <= 2  # to count and to mask
    maps = spark.createDataFrame([("a", {"x": 1, "y": 0}), ("a", {"x": 2}), ("b", {}), ("c", None)], "s string, m map<string,bigint>")
    assert sorted(map(tuple, explode_counts(maps, "m", ["s"]).collect())) == [("a", "x", 3), ("a", "y", 0)]
    assert sorted(map(tuple, explode_counts(maps.withColumn("m", F.col("m")), "m", []).collect())) == [("x", 3), ("y", 0)]


def test_a_text_is_searched_once_for_its_highlights(spark):
    from pyspark.sql import functions as F

    from maskwright.functions.identifiers import highlight_spans

    texts = [None, "", "aéa+b 𝒳aa", "a" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", highlight_spans(F.col("t"), ["a", "a+b", "é", ""]).alias("s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan
    got = [None if r.s is None else [tuple(x) for x in r.s] for r in df.orderBy("i").collect()]
    assert got == [None, [], [(0, 1), (1, 2), (2, 5), (7, 8), (8, 9)], [(k, k + 1) for k in range(5000)]]


def test_citations_are_looked_for_once_a_text(spark):
    from maskwright.plans import catalog

    from tests.test_catalog import SF_DIR

    plan = catalog.QUERIES["semantic_check"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("licensed under the") <= 2  # before and after masking


def test_replacing_literals_compiles_no_pattern(compiled):
    from maskwright.operators.cleaning import replace_literals

    for i in range(20):
        assert replace_literals({"a": [f"王{i}到場"]}, {f"王{i}": "被告甲"}) == ({"a": ["被告甲到場"]}, 1)
    assert not compiled


@pytest.mark.parametrize("name", ["legal_render", "record_cleaning", "legal_masking"])
def test_rule_pack_queries_use_all_cores(spark, name):
    from maskwright.plans import legal_catalog

    from tests.test_catalog import SF_DIR

    assert legal_catalog.query and getattr(legal_catalog, name)(spark, SF_DIR).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
