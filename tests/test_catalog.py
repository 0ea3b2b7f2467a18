"""Every catalogue query with a SQL form against DuckDB, where the driver's tables are at hand."""

import os

import pytest

from maskwright.plans import catalog, legal_catalog  # noqa: F401  (registers its queries)

SF_DIR = os.environ.get("MASKWRIGHT_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    result = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert got == want


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.QUERIES["year_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate" in plan
    joined = catalog.QUERIES["pair_exactly_one_link"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in joined


def test_no_nested_loop_and_one_read_a_rule(spark):
    from maskwright.functions.identifiers import GENERIC

    plan = lambda name: catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    found = catalog.QUERIES["quote_containment"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in found and "Cartesian" not in found
    assert plan("leak_manifest").count("regexp_replace(") <= len(GENERIC)


def test_folding_against_plain_python(spark):
    import hashlib
    import unicodedata

    got = {r.doc_id: r.folded_sha256 for r in catalog.QUERIES["nfkc_normalize"](spark, SF_DIR).collect()}
    texts = {r.doc_id: r.text for r in catalog.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    want = {i: None if t is None else hashlib.sha256("".join(unicodedata.normalize("NFKC", t).split()).encode()).hexdigest() for i, t in texts.items()}
    assert got == want


def test_page_text_against_a_plain_parser(spark):
    """The characters of a page outside title, script and style, by the standard library's parser."""
    from html.parser import HTMLParser

    class Visible(HTMLParser):
        def __init__(self):
            super().__init__()
            self.hidden, self.data = 0, ""

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "noscript", "title")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style", "noscript", "title")

        def handle_data(self, data):
            self.data += "" if self.hidden else data

    pages = {r.page_id: r.html for r in catalog.table(spark, SF_DIR, "pages").select("page_id", "html").collect()}
    for row in catalog.QUERIES["html_text"](spark, SF_DIR).collect():
        parser = Visible()
        parser.feed(pages[row.page_id] or "")
        parser.close()
        assert "".join((row.body or "").split()) == "".join(parser.data.split())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
