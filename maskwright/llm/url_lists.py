"""URL filtering against dated block lists: validity intervals and an as-of join.

List entries say that a host or domain was added or removed on a day.  The
latest entry at or before a capture decides whether the pattern was active
then.  Captures and entries of a key are sorted together by time and every
capture takes over the last entry before it, so a key with many entries costs
no more than their number; a key's captures
are dealt over as many salts as its share of all captures asks for, and its
entries repeated once per salt, so a host with a third of all captures is spread
over tasks and one with few stays in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise

#: parts of all captures that one salt of a key holds, for each partition of a shuffle
SHARE = 2
#: keys with more than one salt are broadcast up to this many, else joined by shuffle
BROADCAST_KEYS = 100_000
_IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, an IPv6 address in its brackets; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:]+)", 1))
    return F.when(host != "", host)


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains of two labels or more; an address has no parents."""
    labels = F.split(host, r"\.")
    last = F.when(host.startswith("[") | host.rlike(_IPV4), 1).otherwise(F.greatest(F.lit(1), F.size(labels) - 1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, valid_from, valid_to``: when entries were active, valid_to exclusive, null while open.

    ``entries``: pattern, category, action ('add' or 'remove'), day.  On one day
    a removal comes before an addition.  Repeated additions lengthen nothing.
    """
    w = Window.partitionBy("pattern").orderBy("day", F.when(F.col("action") == "remove", 0).otherwise(1), "category")
    dated = entries.withColumn("valid_to", F.lead("day").over(w))
    spans = dated.where((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("day"))))
    return spans.select("pattern", "category", F.col("day").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``id, host, fetched, blocked, pattern, category`` for every capture.

    The pattern is the longest active one among the host and its parents.
    Captures without a host or a time, and all captures of an empty list, are
    not blocked.  A null id is an id like any other.  An address is a host
    without parents.  Repeated rows are judged each; extra columns are ignored.
    """
    base = captures.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), F.col(time_col).alias("fetched"))
    keyed = base.where("host is not null and fetched is not null").distinct()
    looked = keyed.select("id", "host", F.col("fetched").alias("day"), F.explode(host_suffixes(F.col("host"))).alias("key"))
    spans = validity_intervals(entries)
    # an interval is two events: what holds from its start, and nothing from its end
    starts = spans.select(F.col("pattern").alias("key"), F.col("valid_from").alias("day"), F.lit(1).alias("turn"), "category")
    ends = spans.where("valid_to is not null").select(F.col("pattern").alias("key"), F.col("valid_to").alias("day"), F.lit(0).alias("turn"), F.lit(None).cast("string").alias("category"))
    hot = _salts(looked)
    events = starts.unionByName(ends).join(hot, "key", "left").select(
        "key", "day", "turn", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("host"), F.struct("category").alias("entry"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"),
    )
    asked = looked.join(hot, "key", "left").select(
        "key", "day", F.lit(2).alias("turn"), F.col("id").cast("long").alias("id"), "host", F.lit(None).cast("struct<category:string>").alias("entry"),
        F.pmod(F.xxhash64("id", "host", "day"), F.coalesce("salts", F.lit(1))).alias("salt"),
    )
    w = Window.partitionBy("key", "salt").orderBy("day", "turn").rowsBetween(Window.unboundedPreceding, 0)
    judged = events.unionByName(asked).withColumn("entry", F.last("entry", ignorenulls=True).over(w)).where("turn = 2 and entry.category is not null")
    hit = judged.groupBy("id", "host", "day").agg(F.max_by(F.struct("key", "entry.category"), F.length("key")).alias("hit"))
    hit = hit.select(F.col("id").alias("hit_id"), F.col("host").alias("hit_host"), F.col("day").alias("hit_day"), "hit")
    on = base["id"].eqNullSafe(hit["hit_id"]) & (base["host"] == hit["hit_host"]) & (base["fetched"] == hit["hit_day"])
    return base.join(hit, on, "left").select(
        F.col("id").alias(id_col), "host", F.col("fetched").alias(time_col), F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.key").alias("pattern"), F.col("hit.category").alias("category"),
    )


def _salts(looked: DataFrame) -> DataFrame:
    """key, salts: how many parts a key is dealt in, for keys with more than one; a written table of at most SHARE rows a partition."""
    spark = looked.sparkSession
    counts = materialise(looked.groupBy("key").agg(F.count("*").alias("n")), "captures")
    total = counts.agg(F.sum("n")).first()[0] or 0
    part = max(1, total // (SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = materialise(counts.where(F.col("n") > part).select("key", F.ceil(F.col("n") / part).alias("salts")), "salts")
    return F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot


def _hex(h: Column, at: int, n: int) -> Column:
    return F.conv(F.substring(h, at, n), 16, 10).cast("int")


def capture_days(pages: DataFrame) -> DataFrame:
    """The table has no fetch time; each page gets a day of a quarter by its id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(90)).cast("int")).alias("fetched"))


def demo_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and domains of the pages, from digits of their MD5."""
    hosts = pages.select(url_host(F.col("url")).alias("host")).where("host is not null").distinct()
    patterns = hosts.select(F.explode(F.array("host", F.substring_index("host", ".", -2))).alias("pattern")).distinct()
    h = F.md5(F.col("pattern"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(_hex(h, 2, 2), F.lit(60)))
    category = F.when(_hex(h, 4, 1) < 8, "ads").otherwise("malware")
    entry = lambda action, day: F.struct(F.lit(action).alias("action"), day.alias("day"))
    rows = F.array_compact(
        F.array(
            entry("add", start),
            F.when(_hex(h, 5, 1) < 8, entry("remove", F.date_add(start, 10))),
            F.when(_hex(h, 6, 1) < 4, entry("add", F.date_add(start, 25))),
        )
    )
    return patterns.where(_hex(h, 1, 1) < 6).select("pattern", category.alias("category"), F.explode(rows).alias("e")).select("pattern", "category", "e.*")


#: DuckDB form of op5_url_filter, by intervals and a range condition
ORACLE = r"""
WITH base AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
         (DATE '2024-01-01' + ((page_id * 7919) % 90)::INTEGER) AS fetched
  FROM pages
), hosts AS (SELECT DISTINCT host FROM base WHERE host IS NOT NULL
), patterns AS (
  SELECT host AS pattern FROM hosts UNION SELECT array_to_string(string_split(host, '.')[-2:], '.') FROM hosts
), hashed AS (SELECT pattern, md5(pattern) AS h FROM patterns
), picked AS (
  SELECT pattern, h, CASE WHEN ('0x' || h[4:4])::INTEGER < 8 THEN 'ads' ELSE 'malware' END AS category,
         DATE '2024-01-01' + (('0x' || h[2:3])::INTEGER % 60) AS start
  FROM hashed WHERE ('0x' || h[1:1])::INTEGER < 6
), entries AS (
  SELECT pattern, category, 'add' AS action, start AS day FROM picked
  UNION ALL SELECT pattern, category, 'remove', start + 10 FROM picked WHERE ('0x' || h[5:5])::INTEGER < 8
  UNION ALL SELECT pattern, category, 'add', start + 25 FROM picked WHERE ('0x' || h[6:6])::INTEGER < 4
), spans AS (
  SELECT *, lead(day) OVER (PARTITION BY pattern ORDER BY day, CASE WHEN action = 'remove' THEN 0 ELSE 1 END, category) AS until FROM entries
), hits AS (
  SELECT b.page_id, s.pattern, s.category, row_number() OVER (PARTITION BY b.page_id ORDER BY length(s.pattern) DESC) AS rn
  FROM base b JOIN spans s ON (b.host = s.pattern OR ends_with(b.host, '.' || s.pattern))
   AND s.action = 'add' AND b.fetched >= s.day AND (s.until IS NULL OR b.fetched < s.until)
)
SELECT b.page_id, b.host, b.fetched, h.pattern IS NOT NULL AS blocked, h.pattern, h.category
FROM base b LEFT JOIN hits h ON b.page_id = h.page_id AND h.rn = 1
"""
