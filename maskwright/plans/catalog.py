"""Named queries over the standard tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..operators import ranking as rk
from ..operators import relational as rel
from ..operators.review import ReviewStore, history_latest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- masking -----------------------------------------------------------------------------------------------------


def _sql_mask(column: str) -> tuple[str, dict[str, str]]:
    """The generic rules as nested RE2 replacements, and a count for each kind."""
    counts = {}
    for rule in ids.GENERIC:
        pattern = rule.pattern.replace("'", "''")
        counts[rule.kind] = f"len(regexp_extract_all({column}, '{pattern}'))::BIGINT"
        column = f"regexp_replace({column}, '{pattern}', '\\1{rule.mask}', 'g')"
    return column, counts


_MASKED, _COUNTS = _sql_mask("t")


def _masked(docs: DataFrame) -> DataFrame:
    ruled = docs.select("doc_id", "source", "text", ids.masked(F.coalesce("text", F.lit(""))).alias("ruled"))
    return ruled.select("doc_id", "source", "text", F.col("ruled.text").alias("masked"), "ruled.counts")


@query(
    f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, sha256({_MASKED}) AS masked_sha256, {', '.join(f'{c} AS n_{k.lower()}' for k, c in _COUNTS.items())} FROM t"""
)
def mask_identifiers(spark, sf_dir):
    masked = _masked(table(spark, sf_dir, "documents"))
    return masked.select("doc_id", F.sha2("masked", 256).alias("masked_sha256"), *[F.col("counts")[r.kind].alias(f"n_{r.kind.lower()}") for r in ids.GENERIC])


@query(
    f"""WITH t AS (SELECT source, coalesce(text, '') AS t FROM documents),
    c AS (SELECT source, unnest([{', '.join(f"struct_pack(kind := '{k}', n := {c})" for k, c in _COUNTS.items())}]) AS x FROM t)
    SELECT source, x.kind AS kind, sum(x.n)::BIGINT AS n_masked FROM c GROUP BY 1, 2"""
)
def mask_counts_manifest(spark, sf_dir):
    return rk.explode_counts(_masked(table(spark, sf_dir, "documents")), "counts", ["source"])


_LEAKS = " + ".join(f"len(regexp_extract_all(m, '{r.pattern.replace(chr(39), chr(39) * 2)}'))" for r in ids.GENERIC)


@query(
    f"""WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
    x AS (SELECT doc_id, source, {_MASKED} AS m, ({' + '.join(_COUNTS.values())})::BIGINT AS n FROM t),
    y AS (SELECT *, ({_LEAKS})::BIGINT AS l FROM x)
    SELECT source, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_masked, count(*) FILTER (WHERE l > 0)::BIGINT AS n_leaking, sum(l)::BIGINT AS n_leaks
    FROM y GROUP BY source"""
)
def leak_manifest(spark, sf_dir):
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, x: a + x)
    # one lambda more, so that the masked text is made once for both
    # and where no rule found anything, every rule has seen this very text
    leaks = lambda s: F.when(s["n"] == 0, F.lit(0).cast("long")).otherwise(total(ids.leak_counts(s["text"])))
    summed = lambda s: F.struct(s["text"].alias("text"), total(s["counts"]).alias("n"))
    of = lambda s: F.struct(s["n"].alias("n"), leaks(s).alias("leaks"))
    docs = table(spark, sf_dir, "documents")
    scanned = docs.select("source", ids.then(ids.then(ids.masked(F.coalesce("text", F.lit(""))), summed), of).alias("s")).select("source", "s.*")
    return scanned.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_masked"), F.count_if(F.col("leaks") > 0).alias("n_leaking"), F.sum("leaks").alias("n_leaks")
    )


@query(
    r"""SELECT page_id, regexp_replace('see ' || url || ' 附件', '()(?:https?://|www\.)[A-Za-z0-9][A-Za-z0-9._~:/?#\[\]@!$&''()*+,;=%-]*', '\1[url]', 'g') AS masked FROM pages"""
)
def mask_url_keep_tail(spark, sf_dir):
    rule = next(r for r in ids.GENERIC if r.kind == "URL")
    text = F.concat(F.lit("see "), "url", F.lit(" 附件"))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(text, rule.pattern, "$1" + rule.mask).alias("masked"))


@query(
    r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
      '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n +', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')) AS normalized_hash
    FROM documents"""
)
def normalize_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(ids.squeeze(F.coalesce("text", F.lit(""))), 256).alias("normalized_hash"))


_CITATION = r"(?i)licensed under the [A-Z]+|[0-9]+ words|all rights reserved"


@query(
    f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, t, {_MASKED} AS m FROM t)
    SELECT doc_id, list_sort(regexp_extract_all(t, '{_CITATION}')) = list_sort(regexp_extract_all(m, '{_CITATION}')) AS citations_preserved,
      round(length(m) / greatest(1, length(t)), 4) AS length_ratio,
      list_sort(regexp_extract_all(t, '{_CITATION}')) = list_sort(regexp_extract_all(m, '{_CITATION}')) AND length(m) >= 0.45 * length(t) AS passed FROM m"""
)
def semantic_check(spark, sf_dir):
    masked = _masked(table(spark, sf_dir, "documents")).select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.col("masked").alias("m"))
    cited = lambda c: F.array_sort(F.regexp_extract_all(c, F.lit(_CITATION), F.lit(0)))
    # a text in which nothing is masked has all its citations
    masked = masked.withColumn("same", F.when(F.col("t") == F.col("m"), F.lit(True)).otherwise(cited("t") == cited("m")))
    same = F.col("same")
    return masked.select(
        "doc_id", same.alias("citations_preserved"), F.round(F.length("m") / F.greatest(F.lit(1), F.length("t")), 4).alias("length_ratio"),
        (same & (F.length("m") >= 0.45 * F.length("t"))).alias("passed"),
    )


_LITERALS = {"the": "[DET]", "them": "[PRON]", "they": "[PRON2]", "an": "[ART]", "and": "[CONJ]", "of": "[PREP]"}


def _sql_literals(column: str) -> str:
    for word in sorted(_LITERALS, key=len, reverse=True):
        column = f"replace({column}, '{word}', '{_LITERALS[word]}')"
    return column


@query(f"SELECT conv_id, turn, md5({_sql_literals('text')}) AS replaced FROM conversations")
def replace_longest_first(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(ids.replace_longest_first(F.col("text"), _LITERALS)).alias("replaced"))


# ---- adapters, projections, filters ------------------------------------------------------------------------------


@query(
    """SELECT sha256('DOC:' || doc_id) AS internal_doc_id, 'DOC:' || doc_id AS source_id, coalesce(nullif(trim(lang), ''), 'unknown') AS case_type,
      coalesce(nullif(trim(source), ''), 'unknown') AS agency_group, length(text)::BIGINT AS n_code_points FROM documents"""
)
def adapt_documents(spark, sf_dir):
    adapted = rel.adapt_records(table(spark, sf_dir, "documents"), "doc_id", "DOC", F.col("lang"), F.col("source"))
    return adapted.withColumn("n_code_points", F.length("raw_text").cast("long")).drop("raw_text")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1995")
def year_filter(spark, sf_dir):
    # a range on the bare column reaches the Parquet scan; year(...) would not
    in_year = (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp")) & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
    return table(spark, sf_dir, "orders").where(in_year).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_custkey // 7 AS k, count(*)::BIGINT AS n_rows FROM customer GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return rel.repeated_keys(table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 7).cast("long").alias("k")), "k")


@query(
    """SELECT o_orderkey, (year(o_orderdate) // 10 * 10)::VARCHAR || 's' AS decade, strftime(o_orderdate, '%Y-%m') || '-XX' AS coarse_day,
      (year(o_orderdate) - 1911)::BIGINT AS roc_year FROM orders"""
)
def date_coarsen(spark, sf_dir):
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")).alias("decade"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-XX")).alias("coarse_day"), (year - 1911).cast("long").alias("roc_year"),
    )


@query("SELECT doc_id, source FROM documents WHERE source ILIKE '%SRC1%' OR text ILIKE '%rights_res%'")
def search_like(spark, sf_dir):
    from ..operators.review import like_any

    docs = table(spark, sf_dir, "documents")
    return docs.where(like_any(["source"], "SRC1") | like_any(["text"], "rights_res")).select("doc_id", "source")


# ---- scopes and joins --------------------------------------------------------------------------------------------

_DONE, _FAILED = "quality = 1", "quality = 0"


def _scope(spark, sf_dir, scope):
    labels = table(spark, sf_dir, "labels")
    return rel.select_scope(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", scope, labels.where(_DONE), labels.where(_FAILED))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IN (0, 1))")
def pending_scope(spark, sf_dir):
    return _scope(spark, sf_dir, "pending")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def error_scope(spark, sf_dir):
    return _scope(spark, sf_dir, "errors")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def rendered_scope(spark, sf_dir):
    return _scope(spark, sf_dir, "rendered")


@query(
    """SELECT l_orderkey, min(l_partkey) AS l_partkey FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem
      WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)) GROUP BY 1 HAVING count(*) = 1"""
)
def pair_exactly_one_link(spark, sf_dir):
    small = table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    return rel.exactly_one_link(table(spark, sf_dir, "lineitem"), small, "l_orderkey", "l_partkey").select("l_orderkey", "l_partkey")


@query(
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey WHERE coalesce(c_name, '') <> ''"""
)
def four_way_case_join(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("coalesce(c_name, '') <> ''")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.join(region, nation.n_regionkey == region.r_regionkey).select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    """SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE l.quality IS NULL)::BIGINT AS pending, count(*) FILTER (WHERE l.quality = 1)::BIGINT AS passed,
      count(*) FILTER (WHERE l.quality = 0)::BIGINT AS failed, count(*) FILTER (WHERE a.toxic = 1)::BIGINT AS audit_fail,
      coalesce(sum(length(d.text)) FILTER (WHERE a.doc_id IS NOT NULL), 0)::BIGINT AS audited_chars
    FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE doc_id % 2 = 0) a USING (doc_id)"""
)
def two_left_joins_stats(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    audits = labels.where("doc_id % 2 = 0").select("doc_id", F.col("toxic").alias("audit"))
    joined = table(spark, sf_dir, "documents").join(labels.select("doc_id", "quality"), "doc_id", "left").join(audits.withColumn("audited", F.lit(True)), "doc_id", "left")
    return joined.agg(
        F.count("*").alias("total"), F.count_if(F.col("quality").isNull()).alias("pending"), F.count_if(F.col("quality") == 1).alias("passed"),
        F.count_if(F.col("quality") == 0).alias("failed"), F.count_if(F.col("audit") == 1).alias("audit_fail"),
        F.coalesce(F.sum(F.when(F.col("audited"), F.length("text"))), F.lit(0)).cast("long").alias("audited_chars"),
    )


@query("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)")
def quote_containment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"))
    return rel.contains_pairs(docs, items, "text", "quote", "doc_id", "item_id").select("doc_id", "item_id")


@query(
    """SELECT mention, count(DISTINCT owner)::BIGINT AS n_owners, CASE WHEN count(DISTINCT owner) = 1 THEN min(owner) ELSE -1 END AS owner, count(DISTINCT owner) > 1 AS ambiguous
      FROM (SELECT s_nationkey::VARCHAR || ':' || right(s_name, 1) AS mention, s_suppkey AS owner FROM supplier) GROUP BY 1"""
)
def unique_mention_resolution(spark, sf_dir):
    mentions = table(spark, sf_dir, "supplier").select(F.concat_ws(":", F.col("s_nationkey").cast("string"), F.expr("right(s_name, 1)")).alias("mention"), F.col("s_suppkey").alias("owner"))
    return rel.unique_and_ambiguous(mentions, "mention", "owner").fillna(-1, ["owner"])


@query(
    """WITH t AS (SELECT doc_id, md5(text) AS digest FROM documents), b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE digest END AS digest FROM t WHERE doc_id % 3 = 0)
      SELECT t.doc_id, CASE WHEN b.digest IS NULL THEN 'missing_source' WHEN b.digest = t.digest THEN 'match' ELSE 'prompt_mismatch' END AS status
      FROM t LEFT JOIN b USING (doc_id)"""
)
def digest_guard(spark, sf_dir):
    """Recorded digests against recomputed ones."""
    now = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    kept = now.where("doc_id % 3 = 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("digest")).alias("recorded"))
    status = F.when(F.col("recorded").isNull(), "missing_source").when(F.col("recorded") == F.col("digest"), "match").otherwise("prompt_mismatch")
    return now.join(kept, "doc_id", "left").select("doc_id", status.alias("status"))


_ASKED = [7, 3, 11, 7, 999_999_999, 1, 5]


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (7, 3, 11, 1)")
def ordered_id_lookup(spark, sf_dir):
    return rel.ordered_lookup(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", _ASKED, limit=4)


@query(
    """SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'hybrid' WHEN b.item_id IS NOT NULL THEN 'ai' ELSE 'clean' END AS text_source,
      length(coalesce(CASE WHEN l.quality = 1 THEN '*' || d.text END, b.text, d.text))::BIGINT AS n
    FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id"""
)
def text_by_priority(spark, sf_dir):
    """The best version there is: hybrid, else generated, else clean."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    ai = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("ai"))
    hybrid = F.when(F.col("quality") == 1, F.concat(F.lit("*"), "text"))
    joined = docs.join(labels, "doc_id", "left").join(ai, "doc_id", "left")
    source = F.when(hybrid.isNotNull(), "hybrid").when(F.col("ai").isNotNull(), "ai").otherwise("clean")
    return joined.select("doc_id", source.alias("text_source"), F.length(F.coalesce(hybrid, "ai", "text")).cast("long").alias("n"))


# ---- upserts and unions ------------------------------------------------------------------------------------------


@query(
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
      WHERE rn = 1"""
)
def latest_checkpoint(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ord", F.struct("ts", "event_id"))
    return rel.last_wins(events.select("user_id", "event_type", "event_id", "value", "ord"), ["user_id", "event_type"], "ord").drop("ord")


@query("SELECT digest, doc_id, source FROM (SELECT md5(text) AS digest, doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("digest"), "doc_id", "source")
    return rel.first_wins(docs, ["digest"], "doc_id").select("digest", "doc_id", "source")


@query(
    """WITH r AS (SELECT user_id, event_id, value, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS new FROM events)
      SELECT user_id, arg_max(value, new * 1000000000 + event_id) AS value, arg_min(event_id, new * 1000000000 + event_id) AS created_id, arg_max(event_id, new * 1000000000 + event_id) AS updated_id
      FROM r GROUP BY user_id"""
)
def upsert_last_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "value", F.col("event_id").alias("created_id"), F.col("event_id").alias("updated_id"), F.col("event_id").alias("ord"))
    return rel.upsert(events.where("ord % 4 <> 0"), events.where("ord % 4 = 0"), ["user_id"], "ord", keep_first=["created_id"]).select("user_id", "value", "created_id", "updated_id")


@query("SELECT doc_id, toxic FROM labels WHERE quality = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0 AND doc_id % 3 = 0)")
def failures_without_success(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return rel.failures_without_success(labels.where("quality = 0").select("doc_id", "toxic"), labels.where("toxic = 0 and doc_id % 3 = 0"), "doc_id")


@query(
    """SELECT doc_id, 'success' AS status, quality AS verdict FROM labels WHERE doc_id % 3 <> 0
      UNION ALL SELECT doc_id, 'failure', -1 FROM labels WHERE doc_id % 2 = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id % 3 <> 0)"""
)
def audit_refresh(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    good = labels.where("doc_id % 3 <> 0").select("doc_id", F.col("quality").alias("verdict"))
    return rel.audit_index(good, labels.where("doc_id % 2 = 0").select("doc_id"), "doc_id").fillna(-1, ["verdict"]).select("doc_id", "status", "verdict")


_KEY_SQL = "lower(regexp_replace({0}, '[^0-9A-Za-z]+', '', 'g'))"


@query(
    f"""WITH a AS (
      SELECT l_orderkey AS pair, 'indictment' AS src, 0 AS place, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + l_quantity::BIGINT AS ord, l_returnflag || l_linestatus AS name FROM lineitem
      UNION ALL SELECT l_orderkey, 'judgment', 1, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + l_quantity::BIGINT, l_linestatus || '-' || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag END FROM lineitem WHERE l_linenumber <= 4),
    k AS (SELECT *, CASE WHEN {_KEY_SQL.format('name')} = '' THEN src || ord::VARCHAR ELSE {_KEY_SQL.format('name')} END AS key FROM a),
    m AS (SELECT pair, key, arg_min(name, place * 1000000000000000 + ord) AS name, array_to_string(list_sort(list(DISTINCT src)), '|') AS provenance,
      count(*)::BIGINT AS n_source_records, min(place * 1000000000000000 + ord) AS first FROM k GROUP BY 1, 2)
    SELECT pair, name, provenance, n_source_records, printf('E%03d', row_number() OVER (PARTITION BY pair ORDER BY first)) AS evidence_id FROM m"""
)
def evidence_union(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    place = F.expr("l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + bigint(l_quantity)").alias("ord")
    left = items.select(F.col("l_orderkey").alias("pair"), place, F.concat("l_returnflag", "l_linestatus").alias("name"))
    flag = F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_returnflag"))
    right = items.where("l_linenumber <= 4").select(F.col("l_orderkey").alias("pair"), place, F.concat("l_linestatus", F.lit("-"), flag).alias("name"))
    key = F.lower(F.regexp_replace("name", "[^0-9A-Za-z]+", ""))
    return rel.union_with_provenance({"indictment": left, "judgment": right}, key, ["name"], "E%03d", ["pair"])


#: bytes of no ASCII letter or digit; none of those stands within a character of several bytes
_NO_CONTENT = bytes(b for b in range(256) if not (b < 128 and chr(b).isalnum()))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _content_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each text's letters and digits in lower case, one read a text; rows without any are left out."""
    for batch in batches:
        contents = (t and t.translate(_LOWER, _NO_CONTENT) for t in batch.column("text").to_pylist())
        keys = pa.array([hashlib.sha256(c).digest() if c else None for c in contents], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("src"), batch.column("first_id"), keys], ["src", "first_id", "key"]).filter(keys.is_valid())


@query(
    """SELECT array_to_string(list_sort(list(DISTINCT src)), '|') AS provenance, count(*)::BIGINT AS n_source_records, min(id)::BIGINT AS first_id FROM (
      SELECT 'document' AS src, doc_id AS id, lower(regexp_replace(text, '[^0-9A-Za-z]+', '', 'g')) AS key FROM documents
      UNION ALL SELECT 'item', item_id, lower(regexp_replace(text, '[^0-9A-Za-z]+', '', 'g')) FROM benchmark WHERE text IS NOT NULL) WHERE key <> '' GROUP BY key"""
)
def fact_union(spark, sf_dir):
    """Texts of two tables merged by their letters and digits."""
    part = lambda name, source, key: table(spark, sf_dir, name).select(F.lit(source).alias("src"), F.col(key).cast("long").alias("first_id"), F.col("text").cast("binary").alias("text"))
    both = part("documents", "document", "doc_id").unionByName(part("benchmark", "item", "item_id"))
    tagged = both.mapInArrow(_content_digests, "src string, first_id long, key binary")
    return tagged.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("src")), "|").alias("provenance"), F.count("*").alias("n_source_records"), F.min("first_id").alias("first_id")).drop("key")


@query(
    """WITH u AS (SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') AS p FROM lineitem GROUP BY 1)
      SELECT l_orderkey, p AS provenance FROM u WHERE contains(p, '|') AND list_contains(string_split(p, '|'), 'R')"""
)
def provenance_filter(spark, sf_dir):
    merged = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), "|").alias("provenance"))
    return merged.where(rel.provenance_filter(F.col("provenance"), "both") & rel.provenance_filter(F.col("provenance"), "R"))


# ---- aggregates and rankings -------------------------------------------------------------------------------------


@query(
    """WITH f AS (SELECT conv_id, role, min(turn) AS first_at FROM conversations GROUP BY 1, 2),
    r AS (SELECT conv_id, role, (row_number() OVER (PARTITION BY conv_id ORDER BY first_at, role) - 1)::INTEGER AS idx FROM f)
    SELECT conv_id, role, idx, substr('甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥', idx + 1, 1) AS alias FROM r"""
)
def speaker_alias(spark, sf_dir):
    numbered = rk.running_index(table(spark, sf_dir, "conversations"), ["conv_id"], "role", "turn")
    return numbered.select("conv_id", "role", "idx", rk.alias_suffix(F.col("idx")).alias("alias"))


@query("SELECT conv_id, substr(text, 1, 1) AS alias, count(DISTINCT role)::BIGINT AS n_owners FROM conversations WHERE role <> 'system' GROUP BY 1, 2 HAVING count(DISTINCT role) > 1")
def alias_collision(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("alias", F.substring("text", 1, 1))
    return rk.alias_collisions(turns, ["conv_id"], "alias", "role", exempt=F.col("role") == "system")


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)
      SELECT user_id, event_type, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS rn FROM c) WHERE rn = 1"""
)
def most_common_label(spark, sf_dir):
    return rk.most_common(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("SELECT l_orderkey, l_linenumber, printf('E%03d', row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)) AS evidence_id FROM lineitem")
def evidence_catalog_ids(spark, sf_dir):
    return rk.numbered(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"], "E%03d")


@query(
    """SELECT o_custkey, count(*)::BIGINT AS n_links, array_to_string(list(o_orderkey::VARCHAR ORDER BY o_orderkey), '|') AS links, arg_min(o_orderpriority, o_orderkey) AS first_priority
      FROM orders GROUP BY 1"""
)
def group_links(spark, sf_dir):
    """Links gathered per target, metadata of the first (C4)."""
    orders = table(spark, sf_dir, "orders")
    links = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), "|")
    return orders.groupBy("o_custkey").agg(F.count("*").alias("n_links"), links.alias("links"), F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))


@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, (o_totalprice * 100)::BIGINT AS cents FROM orders),
    r AS (SELECT *, sum(cents) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::BIGINT AS running_cost FROM o)
    SELECT o_custkey, o_orderkey, running_cost, running_cost <= 50000000 AS admitted FROM r"""
)
def budget_admission(spark, sf_dir):
    cents = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return rk.admit_within_budget(cents, ["o_custkey"], "o_orderkey", "cents", 50_000_000).drop("cents")


@query(
    """WITH s AS (SELECT *, count(*) OVER (PARTITION BY source) AS g FROM documents),
    l AS (SELECT n_chars AS p95 FROM (SELECT n_chars, row_number() OVER (ORDER BY n_chars) - 1 AS rn, count(*) OVER () AS n FROM documents) WHERE rn = floor(0.95 * (n - 1))),
    p AS (SELECT doc_id, source, n_chars, CASE WHEN g <= 2 THEN 0 WHEN n_chars >= (SELECT p95 FROM l) THEN 1 ELSE 2 END AS priority, sha256('20260906:' || doc_id) AS h FROM s)
    SELECT doc_id, source, priority, row_number() OVER (ORDER BY priority, h, doc_id)::INTEGER AS sample_rank FROM p ORDER BY priority, h, doc_id LIMIT 100"""
)
def risk_priority_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return rk.risk_priority_sample(docs, "doc_id", "source", "n_chars", 100, "20260906").select("doc_id", "source", "priority", "sample_rank")


@query(
    """WITH r AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS rn FROM documents)
      SELECT doc_id, lang, n_chars FROM r ORDER BY CASE WHEN rn = 1 THEN 0 ELSE 1 END, n_chars, doc_id LIMIT 25"""
)
def shortest_per_class(spark, sf_dir):
    return rk.best_of_each(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "lang", ["n_chars", "doc_id"], 25).select("doc_id", "lang", "n_chars")


@query(
    """WITH t AS (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS turn FROM documents)
      SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY turn, lang, sha256(doc_id::VARCHAR), doc_id) AS rn FROM t) WHERE rn <= 5"""
)
def quota_sample(spark, sf_dir):
    return rk.quota_sample(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "source", "lang", "doc_id", 5).select("doc_id", "source", "lang")


@query(
    """SELECT d.doc_id, l.quality, d.n_chars FROM documents d LEFT JOIN labels l USING (doc_id)
      ORDER BY CASE l.quality WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END, d.n_chars DESC NULLS LAST, d.doc_id LIMIT 50"""
)
def case_sorted_topk(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.orderBy(rk.rank_key("quality", 0, 1), F.col("n_chars").desc_nulls_last(), "doc_id").limit(50).select("doc_id", "quality", "n_chars")


@query("SELECT lang, source, count(*)::BIGINT AS n FROM documents GROUP BY 1, 2")
def facet_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query(
    """SELECT min(length(text))::BIGINT AS shortest, max(length(text))::BIGINT AS longest, count(*) FILTER (WHERE length(text) > 24000)::BIGINT AS oversize,
      sum(octet_length(encode(text)))::BIGINT AS n_bytes FROM documents"""
)
def prompt_length_stats(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "documents").agg(
        F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"), F.count_if(n > 24000).alias("oversize"), F.sum(F.octet_length("text")).cast("long").alias("n_bytes")
    )


@query("SELECT o_orderpriority, round(sum((o_totalprice * 100)::BIGINT) / 100, 2) AS cost, count(*)::BIGINT AS n_calls FROM orders GROUP BY 1")
def cost_totals(spark, sf_dir):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.round(F.sum(cents) / 100, 2).alias("cost"), F.count("*").alias("n_calls"))


# ---- tiers and flags ---------------------------------------------------------------------------------------------

_CLASSES = {"licence": "(?i)licen[sc]e", "secret": "(?i)token|password", "contact": "[a-z0-9.]+@[a-z0-9.]+", "rights": "(?i)rights reserved"}


@query(
    f"""WITH c AS (SELECT doc_id, list_filter([{', '.join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in _CLASSES.items())}], lambda x: x IS NOT NULL) AS c FROM documents)
    SELECT doc_id, CASE len(c) WHEN 0 THEN 'unknown' WHEN 1 THEN c[1] ELSE 'mixed' END AS outcome FROM c"""
)
def outcome_classes(spark, sf_dir):
    from ..operators.tiering import classify

    return table(spark, sf_dir, "documents").select("doc_id", classify(F.col("text"), _CLASSES).alias("outcome"))


_FLAG_SQL = """WITH f AS (SELECT d.doc_id, list_filter([CASE WHEN l.quality = 0 THEN 'low_quality' END, CASE WHEN l.toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS hard,
    list_filter([CASE WHEN d.n_chars > 8000 THEN 'very_long' END, CASE WHEN d.n_chars < 60 THEN 'very_short' END, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END], lambda x: x IS NOT NULL) AS review
    FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _flags(spark, sf_dir):
    from ..operators.tiering import flags, with_tier

    joined = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True)), "doc_id", "left")
    hard = flags({"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    review = flags({"very_long": F.col("n_chars") > 8000, "very_short": F.col("n_chars") < 60, "unlabelled": F.col("labelled").isNull()})
    return with_tier(joined.select("doc_id", hard.alias("hard_flags"), review.alias("review_flags")))


@query(
    _FLAG_SQL
    + """ SELECT doc_id, CASE WHEN len(hard) > 0 THEN 'rejected' WHEN len(review) > 0 THEN 'needs_review' ELSE 'recommended' END AS status,
      array_to_string(list_sort(list_concat(hard, review)), '|') AS flags FROM f"""
)
def quality_tiers(spark, sf_dir):
    return _flags(spark, sf_dir).select("doc_id", "status", F.array_join(F.array_sort(F.concat("hard_flags", "review_flags")), "|").alias("flags"))


@query(_FLAG_SQL + " SELECT flag, count(*)::BIGINT AS n FROM (SELECT unnest(list_concat(hard, review)) AS flag FROM f) GROUP BY 1")
def flag_histogram(spark, sf_dir):
    return rk.histogram(_flags(spark, sf_dir).select(F.explode(F.concat("hard_flags", "review_flags")).alias("flag")), "flag")


@query(
    """WITH c AS (SELECT o_orderkey, list(DISTINCT l_partkey) AS ids FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_partkey IS NOT NULL GROUP BY 1),
    n AS (SELECT l_orderkey, count(*) AS total FROM lineitem GROUP BY 1)
    SELECT l_orderkey, count(DISTINCT l_suppkey)::BIGINT AS n_cited, count(*)::BIGINT AS n_catalog,
      count(DISTINCT l_suppkey) >= 3 AND count(DISTINCT l_suppkey) / count(*) >= 0.65 AS overbroad FROM lineitem GROUP BY 1"""
)
def overbroad_citation(spark, sf_dir):
    from ..operators.tiering import overbroad

    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("cited"), F.count("*").alias("n_catalog"))
    return grouped.select("l_orderkey", F.size("cited").cast("long").alias("n_cited"), "n_catalog", overbroad(F.col("cited"), F.col("n_catalog"), 3, 0.65).alias("overbroad"))


@query(
    """SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_partkey)), '|') AS unknown_ids FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY 1"""
)
def ids_not_in_catalog(spark, sf_dir):
    catalog = table(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    unknown = table(spark, sf_dir, "lineitem").join(catalog, "l_partkey", "left_anti").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("ids"))
    return unknown.select("l_orderkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), "|").alias("unknown_ids"))


# ---- pages and JSON ----------------------------------------------------------------------------------------------


@query(
    """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<script'))::BIGINT AS n_scripts,
      array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))), '|') AS links FROM pages"""
)
def html_title_links(spark, sf_dir):
    links = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))), "|")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<script")).cast("long").alias("n_scripts"), links.alias("links")
    )


@query()
def html_text(spark, sf_dir):
    from ..sources.html import html_text as extract

    return table(spark, sf_dir, "pages").select("page_id", extract(F.col("html")).alias("h")).select("page_id", "h.*")


@query(
    """SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host,
      regexp_extract(url, '://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query FROM pages"""
)
def url_parts(spark, sf_dir):
    part = lambda p: F.regexp_extract("url", p, 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", part("^([a-z]+)://").alias("scheme"), F.lower(part("://([^/?#:]+)")).alias("host"), part("://[^/?#]+([^?#]*)").alias("path"), part(r"\?([^#]*)").alias("query")
    )


@query(
    """WITH u AS (SELECT regexp_extract(url, '://([^/?#:]+)', 1) AS host, list(url ORDER BY page_id) AS urls FROM pages GROUP BY 1)
      SELECT host, coalesce(list_filter(urls, lambda x: contains(x, '/en/'))[1], CASE WHEN len(urls) = 1 THEN urls[1] END) AS chosen FROM u"""
)
def pick_dated_url(spark, sf_dir):
    from ..sources.html import choose_url

    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#:]+)", 1).alias("host"), "page_id", "url")
    grouped = pages.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))), lambda x: x["url"]).alias("urls"))
    return grouped.select("host", choose_url(F.col("urls"), F.lit("/en/")).alias("chosen"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_type(props) AS kind FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.when(F.col("props").startswith("{"), "OBJECT").otherwise("ARRAY").alias("kind"))


@query(
    """SELECT event_id, unnest(['/event_type', '/parts/0/a~1b']) AS pointer, unnest([event_type, props]) AS value FROM events"""
)
def json_walk_pointers(spark, sf_dir):
    from ..functions.json_pointer import register_walk

    register_walk(spark)
    nested = F.to_json(F.struct("event_type", F.array(F.struct(F.col("props").alias("a/b"))).alias("parts")))
    table(spark, sf_dir, "events").select("event_id", nested.alias("js")).createOrReplaceTempView("maskwright_events")
    return spark.sql("SELECT event_id, w.pointer, w.value FROM maskwright_events, LATERAL json_walk(js) w")


# ---- review desk -------------------------------------------------------------------------------------------------


def _desk(spark, sf_dir) -> ReviewStore:
    docs = table(spark, sf_dir, "documents")
    rank = F.when(F.col("doc_id") % 7 == 0, (F.col("doc_id") / 7).cast("long"))
    cases = docs.select("doc_id", F.col("lang").alias("case_type"), "source", "text", rank.alias("sample_rank"), rank.isNotNull().alias("in_sample"))
    labels = table(spark, sf_dir, "labels")
    decision = F.when(F.col("toxic") == 1, "follow_up").when(F.col("quality") == 1, "pass").otherwise("fail")
    issues = F.array_compact(F.array(F.when(F.col("quality") == 0, "quality"), F.when(F.col("toxic") == 1, "toxic")))
    return ReviewStore(cases, labels.select("doc_id", decision.alias("decision"), issues.alias("issues")), "doc_id", ["source", "case_type"])


_DECISION_SQL = "CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN l.toxic = 1 THEN 'follow_up' WHEN l.quality = 1 THEN 'pass' ELSE 'fail' END"


@query(
    f"""SELECT d.doc_id, d.lang AS case_type, d.source, {_DECISION_SQL} AS decision FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE d.doc_id % 7 = 0 AND {_DECISION_SQL} = 'pending' AND d.lang = 'en' AND d.source ILIKE '%src%' ORDER BY d.doc_id // 7, d.doc_id LIMIT 40"""
)
def review_case_list(spark, sf_dir):
    return _desk(spark, sf_dir).cases("sample", "pending", "en", "SRC", 40).select("doc_id", "case_type", "source", "decision")


@query(
    f"""WITH x AS (SELECT {_DECISION_SQL} AS d FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE d = 'pending')::BIGINT AS pending, count(*) FILTER (WHERE d = 'pass')::BIGINT AS passed,
      count(*) FILTER (WHERE d = 'fail')::BIGINT AS failed, count(*) FILTER (WHERE d = 'follow_up')::BIGINT AS follow_up FROM x"""
)
def review_stats(spark, sf_dir):
    return _desk(spark, sf_dir).stats()


@query("SELECT lang AS case_type, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def review_facets(spark, sf_dir):
    return _desk(spark, sf_dir).facets()


@query(
    f"""SELECT d.doc_id, {_DECISION_SQL} AS decision,
      array_to_string(list_filter([CASE WHEN l.quality = 0 THEN 'quality' END, CASE WHEN l.toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL), '|') AS issues
    FROM documents d JOIN labels l USING (doc_id)"""
)
def review_export(spark, sf_dir):
    return _desk(spark, sf_dir).export().select("doc_id", "decision", "issues")


@query(f"SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id) WHERE {_DECISION_SQL} <> 'pass'")
def public_export(spark, sf_dir):
    return _desk(spark, sf_dir).public(["doc_id", "source"])


@query(
    """SELECT user_id, event_id, recency FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC)::INTEGER AS recency FROM events) WHERE recency <= 20"""
)
def review_history(spark, sf_dir):
    return history_latest(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id", "recency")


# ---- documents, patches, resumed work ----------------------------------------------------------------------------

@query()
def nfkc_normalize(spark, sf_dir):
    """Unicode compatibility folding, for which neither engine has a function."""
    @F.pandas_udf("string")
    def folded(text: pd.Series) -> pd.Series:
        from ..functions.legal_zh import fold

        return text.map(lambda t: None if t is None else fold(t))

    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(folded("text"), 256).alias("folded_sha256"))


@query("SELECT d.doc_id, b.item_id, b.text AS repaired FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 40")
def fuzzy_quote_repair(spark, sf_dir):
    """Quotes with one letter changed, put right from the document they are in (V2, V3)."""
    found = quote_containment(spark, sf_dir).join(table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote")), "item_id").where("length(quote) > 40")
    changed = F.concat(F.substring("quote", 1, 20), F.lit("#"), F.substring("quote", 22, 1_000_000))
    asked = found.withColumn("changed", changed).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")

    @F.pandas_udf("string")
    def repaired(snippets: pd.Series, texts: pd.Series) -> pd.Series:
        from ..operators.grounding import closest_quote

        return pd.Series([closest_quote(s, [t]) for s, t in zip(snippets, texts)])

    return rel.spread(asked.select("doc_id", "item_id", "changed", "text")).select("doc_id", "item_id", repaired("changed", "text").alias("repaired"))


@query("SELECT event_id, value * 2 AS result FROM events WHERE event_id % 3 <> 0")
def incremental_resume(spark, sf_dir):
    """Only what has no result yet is worked on."""
    from ..streaming.incremental import resume_batch

    events = table(spark, sf_dir, "events").select("event_id", "value")
    return resume_batch(events, events.where("event_id % 3 = 0"), "event_id", lambda df: df.select("event_id", (F.col("value") * 2).alias("result")))


@query(
    """SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type = 'error' OR event_id % 5 = 0 GROUP BY user_id
      HAVING user_id NOT IN (SELECT user_id FROM events WHERE NOT (event_type = 'error' OR event_id % 5 = 0) AND event_id % 40 = 1)"""
)
def dead_letters(spark, sf_dir):
    """Latest failure of each key without a success."""
    from ..streaming.incremental import dead_letters as latest

    events = table(spark, sf_dir, "events")
    failed = (F.col("event_type") == "error") | (F.col("event_id") % 5 == 0)
    tries = events.select("user_id", "event_id", F.when(failed, "failed").alias("error")).where("error is not null or event_id % 40 = 1")
    return latest(tries, "user_id", "event_id").select("user_id", "event_id")


@query("SELECT conv_id, count(*)::BIGINT AS n_turns, CASE WHEN bool_or(role = 'user') AND bool_or(role = 'assistant') THEN NULL WHEN bool_or(role = 'user') THEN 'assistant' ELSE 'user' END IS NULL AS complete FROM conversations GROUP BY 1")
def roles_complete(spark, sf_dir):
    """Whether each case has every role it needs."""
    need = F.array(F.lit("user"), F.lit("assistant"))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.collect_set("role").alias("have"))
    return grouped.select("conv_id", "n_turns", (F.size(F.array_except(need, "have")) == 0).alias("complete"))


# ---- files -------------------------------------------------------------------------------------------------------


def _shared(spark, label: str) -> str:
    """A fresh folder that all executors share: below the checkpoint folder, else, on one machine, a temporary one."""
    key = "spark.checkpoint.dir"
    root = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{key} must name a folder that all executors share")
    return f"{root or 'file://' + tempfile.mkdtemp(prefix='maskwright-')}/{label}-{uuid.uuid4().hex}"


@query("SELECT doc_id, lang, source, CASE WHEN text IS NULL THEN NULL ELSE md5(text) END AS digest FROM documents")
def jsonl_round_trip(spark, sf_dir):
    """Documents written as JSON Lines and read back, nulls and line ends inside texts included."""
    from ..sources.jsonl import read_jsonl, write_jsonl

    docs, place = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), _shared(spark, "jsonl")
    write_jsonl(docs, place)
    return read_jsonl(spark, place, docs.schema).select("doc_id", "lang", "source", F.md5("text").alias("digest"))


@query("SELECT count(*) FILTER (WHERE event_id % 10 <> 0)::BIGINT AS n_good, count(*) FILTER (WHERE event_id % 10 = 0)::BIGINT AS n_bad FROM events")
def jsonl_quarantine(spark, sf_dir):
    """Lines that are no object are set aside with their file (A3)."""
    from ..sources.jsonl import read_jsonl_quarantined

    place = _shared(spark, "lines")
    line = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit('["'), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct("event_id", "event_type")))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(place)
    good, bad = read_jsonl_quarantined(spark, place, "event_id long, event_type string")
    return good.agg(F.count("event_id").alias("n_good")).crossJoin(bad.agg(F.count("path").alias("n_bad")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0")
def snapshot_round_trip(spark, sf_dir):
    """A keyed snapshot of the rows an order lists."""
    from ..sources.jsonl import read_jsonl, write_snapshot

    orders, place = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _shared(spark, "snapshot")
    wanted = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.xxhash64("o_orderkey").alias("ord"))
    write_snapshot(orders, place, wanted, "o_orderkey")
    return read_jsonl(spark, place, orders.schema)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    """CSV with a header whose first name carries the byte order mark."""
    from ..sources.jsonl import write_csv

    place = _shared(spark, "csv")
    write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), place)
    return spark.read.csv(place, header=True, schema="c_custkey long, c_name string, c_mktsegment string", enforceSchema=True)


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def checkpoint_sync(spark, sf_dir):
    """A folder of JSON Lines that has grown between two syncs, as a table of the latest rows."""
    from ..sources.jsonl import write_jsonl
    from ..streaming.incremental import sync_checkpoint

    events, place = table(spark, sf_dir, "events").select("user_id", "event_id"), _shared(spark, "sync")
    for half in (0, 1):
        write_jsonl(events.where(F.col("event_id") % 2 == half), f"{place}/in", mode="append")
        found = sync_checkpoint(spark, f"{place}/in", events.schema, f"{place}/state", f"{place}/log", "user_id", "event_id")
    return found
