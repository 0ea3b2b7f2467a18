"""Secret scanning over an incremental ledger of content-addressed blobs; DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text.  The
ledger holds one row per blob and rule-pack version that was scanned, with
what was found; a run scans only pairs the ledger does not have, once each
however many paths share the blob, appends them, and joins findings back to
all paths.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import materialise, scratch_path

LEDGER = "blob string, rule_version string, findings array<struct<start:bigint,end:bigint,kind:string>>"
#: representatives are broadcast up to this many rows (16 bytes and overhead), else joined by shuffle
BROADCAST_BLOBS = 500_000


#: matches of one text whose spans are gathered at once
PORTION = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds; a match counts if ``group`` has ``least`` code points.  ``guard`` is a cheap necessary condition."""

    kind: str
    pattern: str
    guard: str
    group: int = 0
    least: int = 0
    guard_is_regex: bool = False


@dataclass(frozen=True)
class RulePack:
    version: str
    rules: tuple[Rule, ...]


# Fixed patterns.  Runs of one class are maximal, so a least length can stand in
# the pattern of access and hex; assign keeps its short matches, which take up
# text, and drops them afterwards.
BASE = RulePack(
    "base@1",
    (
        Rule(
            "assign",
            r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
            group=2,
            least=6,
            guard_is_regex=True,
        ),
        Rule("access", r"AKIA[A-Z0-9]{16,}", "AKIA"),
        Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", guard_is_regex=True),
    ),
)
EXTRA = RulePack(
    "extra@1",
    (
        Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", "eyJ"),
        Rule("forge", r"gh[pousr]_[A-Za-z0-9]{30,}", "gh"),
        Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    ),
)
PACKS = (BASE, EXTRA)


def _rule_spans(text: Column, rule: Rule) -> Column:
    """Code point spans of a rule's matches: what lies between matches gives their places."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.pattern, -1)
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    items = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(matches)), F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        F.transform(checked, F.length).alias("checked"),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")

    def one(acc: Column, x: Column) -> Column:
        start = (acc["at"] + x["gap"]).cast("long")
        end = (start + x["size"]).cast("long")
        span = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(x["checked"] >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def portion(acc: Column, some: Column) -> Column:
        # spans are gathered a portion at a time and portions joined at the end: appending all to one array is quadratic
        done = F.aggregate(some, F.struct(acc["at"].alias("at"), empty.alias("spans")), one)
        return F.struct(done["at"].alias("at"), F.concat(acc["portions"], F.array(done["spans"])).alias("portions"))

    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(items) - 1) / PORTION).cast("int")))
    portions = F.transform(starts, lambda i: F.slice(items, i * PORTION + 1, PORTION))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<struct<start:bigint,end:bigint,kind:string>>>").alias("portions"))
    guard = text.rlike(rule.guard) if rule.guard_is_regex else F.contains(text, F.lit(rule.guard))
    return F.when(guard, F.flatten(F.aggregate(portions, state, portion, lambda acc: acc["portions"]))).otherwise(empty)


def scan(text: Column, pack: RulePack) -> Column:
    """All spans a pack finds in a text."""
    return F.concat(*[_rule_spans(text, r) for r in pack.rules])


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings, at ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "blob-ledger")
        self._written = path is not None

    def read(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def _exists(self) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def update(self, versions: DataFrame, packs: tuple[RulePack, ...] = PACKS) -> DataFrame:
        """Scan what is new in ``versions`` (path, text) and return its (path, blob) table."""
        text = F.coalesce(F.col("text"), F.lit(""))
        source = versions.select("path", text.alias("text"))
        addressed = materialise(source.select("path", F.sha2("text", 256).alias("blob"), F.xxhash64("text").alias("h")), "versions")
        masks = F.array(*[F.struct(F.lit(p.version).alias("rule_version"), F.lit(1 << i).alias("bit")) for i, p in enumerate(packs)])
        wanted = addressed.groupBy("blob").agg(F.min(F.struct("path", "h")).alias("first")).select("blob", "first", F.explode(masks).alias("p"))
        wanted = wanted.select("blob", "first", "p.*")
        unseen = wanted.join(self.read().select("blob", "rule_version"), ["blob", "rule_version"], "left_anti")
        todo = unseen.groupBy("blob", "first").agg(F.sum("bit").alias("mask")).select(F.xxhash64("first.path").alias("p"), F.col("first.h").alias("q"), "mask")
        todo = materialise(todo, "unseen")
        todo = F.broadcast(todo) if todo.count() <= BROADCAST_BLOBS else todo
        fresh = source.join(todo, (F.xxhash64("path") == todo["p"]) & (F.xxhash64("text") == todo["q"])).select("text", "mask")
        found = [
            F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.struct(F.lit(p.version).alias("rule_version"), scan(F.col("text"), p).alias("findings")))
            for i, p in enumerate(packs)
        ]
        rows = fresh.select(F.sha2("text", 256).alias("blob"), F.explode(F.array_compact(F.array(*found))).alias("r")).select("blob", "r.*")
        rows.dropDuplicates(["blob", "rule_version"]).write.mode("append").parquet(self.path)
        return addressed.select("path", "blob")

    def findings(self, paths: DataFrame, packs: tuple[RulePack, ...] = PACKS) -> DataFrame:
        """``path, blob, findings`` for every row of ``paths``; findings sorted by start, then kind as listed."""
        kinds = [r.kind for p in packs for r in p.rules]
        order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
        hits = self.read().where(F.col("rule_version").isin([p.version for p in packs]) & (F.size("findings") > 0))
        hits = hits.dropDuplicates(["blob", "rule_version"])
        per_blob = hits.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("found"))
        ranked = F.array_sort(F.transform("found", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
        per_blob = per_blob.select("blob", ranked.alias("findings"))
        none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
        return paths.join(per_blob, "blob", "left").select("path", "blob", F.coalesce("findings", none).alias("findings"))


def _count(kind: str) -> Column:
    return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")


def _joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, ledger: BlobLedger | None = None, id_col: str = "doc_id", text_col: str = "text", steps: int = 2) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    The table is ingested in ``steps`` by a hash of the id; each scans only what
    the ledger does not have from the steps before and from earlier runs.
    Spans are ``kind:start:end`` in code points, end exclusive.  A null text is
    an empty one, a null id an id like any other; repeated rows share a blob and
    are scanned once; extra columns are ignored.  A ledger has one writer at a
    time: two at once may both scan a blob, which repeats its row in the ledger
    and, as rows are read once for each blob and version, no finding.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("path"), F.col(text_col).alias("text"))
    paths = [ledger.update(source.where(F.pmod(F.xxhash64("path"), F.lit(steps)) == step)) for step in range(steps)]
    found = ledger.findings(reduce(DataFrame.unionByName, paths))
    base = F.filter("findings", lambda x: x["kind"].isin([r.kind for r in BASE.rules]))
    counts = [_count(r.kind).alias(f"n_{r.kind}") for r in BASE.rules]
    return found.select(F.col("path").alias(id_col), *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"))


def _oracle_spans(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    keep = f"len(regexp_extract_all(t, '{pattern}', {rule.group})[i]) >= {rule.least}" if rule.group else "true"
    start = (
        f"coalesce(list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda x: len(x))), 0)"
        f" + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i - 1], lambda x: len(x))), 0)"
    )
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, ({start})::BIGINT AS s, len(regexp_extract_all(t, '{pattern}')[i]) AS n
  FROM (SELECT doc_id, t, unnest(range(1, len(regexp_extract_all(t, '{pattern}')) + 1)) AS i FROM texts) WHERE {keep}"""


#: DuckDB form of op7_secret_scan
ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({reduce(lambda a, b: a + " UNION ALL " + b, [_oracle_spans(r, i) for i, r in enumerate(BASE.rules + EXTRA.rules)])}),
named AS (SELECT *, kind || ':' || s || ':' || (s + n) AS span FROM spans),
lists AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE rank < {len(BASE.rules)}) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM named GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)
"""
