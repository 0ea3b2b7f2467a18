"""Scopes, joins, upserts and unions over keyed tables.

Order is always an explicit column; nothing depends on partition order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: tasks a core for work that takes long for a row
TASKS_PER_CORE = 4


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to all cores, for steps whose cost is in the rows and not in the bytes.

    A scan makes its tasks by bytes and Parquet row groups: millions of short
    rows, or a file of one group, end up in a task or two.
    """
    return df.repartition(TASKS_PER_CORE * max(1, df.sparkSession.sparkContext.defaultParallelism))


def non_blank(column: Column | str) -> Column:
    """The trimmed value, null where nothing is left."""
    value = F.trim(F.col(column) if isinstance(column, str) else column)
    return F.when(value != "", value)


def first_present(*columns: Column | str, default: str | None = None) -> Column:
    """First non-blank value; blank strings count as missing."""
    found = [non_blank(c) for c in columns]
    return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)


def adapt_records(df: DataFrame, id_col: str, namespace: str, kind: Column, group: Column) -> DataFrame:
    """Source rows to flat records with a namespaced id and its SHA-256."""
    source_id = F.concat(F.lit(namespace + ":"), F.col(id_col).cast("string"))
    return df.select(
        F.sha2(source_id, 256).alias("internal_doc_id"),
        source_id.alias("source_id"),
        first_present(kind, default="unknown").alias("case_type"),
        first_present(group, default="unknown").alias("agency_group"),
        F.col("text").alias("raw_text"),
    )


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; a unique table gives none."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def select_scope(
    cases: DataFrame,
    key: str,
    scope: str,
    done: DataFrame,
    failed: DataFrame,
    order: Sequence[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Work that is pending, errored, rendered or all.

    Pending is neither done nor failed; errors failed and are not done since;
    rendered is done.  The limit counts after the filter.
    """
    done, failed = done.select(key).distinct(), failed.select(key).distinct()
    if scope == "pending":
        out = cases.join(done.unionByName(failed), key, "left_anti")
    elif scope == "errors":
        out = cases.join(failed, key, "left_semi").join(done, key, "left_anti")
    elif scope == "rendered":
        out = cases.join(done, key, "left_semi")
    elif scope == "all":
        out = cases
    else:
        raise ValueError(f"unknown scope {scope!r}")
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def ordered_lookup(df: DataFrame, key: str, wanted: Sequence, limit: int | None = None) -> DataFrame:
    """Rows of the wanted keys in the order asked for, repeats once."""
    spark = df.sparkSession
    places = {value: i for i, value in reversed(list(enumerate(wanted)))}
    kind = df.schema[key].dataType.simpleString()
    order = spark.createDataFrame([(v, i) for v, i in places.items()], f"{key} {kind}, asked_at int")
    out = df.join(F.broadcast(order), key).orderBy("asked_at").drop("asked_at")
    return out if limit is None else out.limit(limit)


def exactly_one_link(links: DataFrame, targets: DataFrame, source: str, target: str) -> DataFrame:
    """Sources with exactly one distinct link into ``targets``."""
    usable = links.select(source, target).distinct().join(targets.select(target).distinct(), target, "left_semi")
    return usable.groupBy(source).agg(F.min(target).alias(target), F.count("*").alias("n")).where("n = 1").drop("n")


def _ties(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have an order, which maps and variants have not."""
    return [c for c in columns if not re.search(r"\b(?:map<|variant)", df.schema[c].dataType.simpleString())]


def first_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The earliest row of each key; map-side combined like :func:`last_wins`."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(order), *_ties(df, rest))).alias("__row"))
    return picked.select(*keys, "__row.*")


def last_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The latest row of each key; map-side combined, so a hot key costs one row a task.

    Of rows equal in ``order`` the one with the greatest other values wins.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), *_ties(df, rest))).alias("__row"))
    return picked.select(*keys, "__row.*")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order: str, keep_first: Sequence[str] = ()) -> DataFrame:
    """Changes replace rows of equal key; ``keep_first`` columns stay from the oldest row."""
    both = current.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    rest = [c for c in current.columns if c not in keys]
    rank = F.struct("__new", order)
    picked = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), rank).alias("__row"),
        *[F.min_by(c, rank).alias(f"__first_{c}") for c in keep_first],
    )
    return picked.select(*keys, *[F.col(f"__first_{c}").alias(c) if c in keep_first else F.col(f"__row.{c}") for c in rest])


def failures_without_success(failures: DataFrame, successes: DataFrame, key: str) -> DataFrame:
    """A success takes its key out of the failures."""
    return failures.join(successes.select(key), key, "left_anti")


def audit_index(successes: DataFrame, failures: DataFrame, key: str) -> DataFrame:
    """Full refresh: successes, and failures that have none (U8)."""
    return successes.withColumn("status", F.lit("success")).unionByName(
        failures_without_success(failures, successes, key).withColumn("status", F.lit("failure")), allowMissingColumns=True
    )


def union_with_provenance(tables: dict[str, DataFrame], key: Column, keep: Sequence[str], id_format: str | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Rows of several sources merged by a content key, first occurrence first.

    Each table has an ``ord`` column; blank keys never merge.  ``provenance``
    lists the sources of a merged row.
    """
    tagged = None
    for place, (name, table) in enumerate(tables.items()):
        part = table.select(*scope, *keep, "ord").withColumns({"__source": F.lit(name), "__place": F.lit(place)})
        tagged = part if tagged is None else tagged.unionByName(part)
    tagged = tagged.withColumn("__key", key)
    own = F.concat_ws(":", F.lit("empty"), "__source", F.col("ord").cast("string"))
    tagged = tagged.withColumn("__key", F.when(F.coalesce("__key", F.lit("")) == "", own).otherwise(F.col("__key")))
    rank = F.struct("__place", "ord")
    merged = tagged.groupBy(*scope, "__key").agg(
        *[F.min_by(c, rank).alias(c) for c in keep],
        F.array_join(F.array_sort(F.collect_set("__source")), "|").alias("provenance"),
        F.count("*").alias("n_source_records"),
        F.min(rank).alias("__first"),
    )
    if id_format:
        # a few rows a scope; without a scope the ids would order the whole table in one task
        if not scope:
            raise ValueError("numbering needs a scope")
        w = Window.partitionBy(*scope).orderBy("__first")
        merged = merged.withColumn("evidence_id", F.format_string(id_format, F.row_number().over(w)))
    return merged.drop("__key", "__first")


def unique_and_ambiguous(mentions: DataFrame, mention: str, owner: str) -> DataFrame:
    """Per mention: its one owner, or none if several claim it."""
    found = mentions.groupBy(mention).agg(F.count_distinct(owner).alias("n_owners"), F.min(owner).alias("__one"))
    return found.select(mention, "n_owners", F.when(F.col("n_owners") == 1, F.col("__one")).alias(owner), (F.col("n_owners") > 1).alias("ambiguous"))


def contains_pairs(texts: DataFrame, quotes: DataFrame, text: str, quote: str, id_col: str | None = None, quote_id: str | None = None, longest: int = 3) -> DataFrame:
    """Every (text row, quote row) where the quote is in the text, without a nested loop.

    A quote's ends may be parts of words, so it is looked up by whole words
    inside it: the ``longest`` after its first, or the fewer it has.  Only (id,
    gram) leaves a text, for grams that some quote has; the pairs found are
    joined back to texts and quotes and searched.  A quote without a whole word
    inside is looked up by a piece of three characters in the same way, or of as
    many as it has; an empty or blank one is in every text and is not looked up:
    it has no pairs.  Ids - by default the first other column - must be distinct.
    """
    id_col = id_col or next(c for c in texts.columns if c != text)
    quote_id = quote_id or next(c for c in quotes.columns if c != quote)
    words = lambda c: F.filter(F.split(F.col(c), r"\s+"), lambda w: w != "")
    inner = F.greatest(F.lit(0), F.size("__w") - 2)
    size = F.when(inner > 0, F.least(inner, F.lit(longest))).otherwise(-F.least(F.length(F.trim(quote)), F.lit(3)))
    piece = F.substring(F.trim(quote), F.lit(1), -F.col("__n"))
    gram = F.when(F.col("__n") > 0, F.xxhash64(F.lit("w"), F.array_join(F.slice("__w", F.lit(2), F.col("__n")), " "))).otherwise(F.xxhash64(F.lit("c"), piece))
    asked = quotes.withColumn("__w", words(quote)).withColumn("__n", size).where("__n <> 0").select(F.col(quote_id), "__n", gram.alias("__gram"))
    sizes = sorted(r["__n"] for r in asked.select("__n").distinct().collect())  # six values at most
    if not sizes:
        return texts.join(quotes.limit(0), F.lit(True)).limit(0)

    def grams(n: int) -> Column:
        if n < 0:
            ends = F.greatest(F.lit(0), F.length(text) + n + 1)
            return F.transform(F.when(ends > 0, F.sequence(F.lit(1), ends)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(F.lit("c"), F.substring(F.col(text), i, F.lit(-n))))
        many = F.greatest(F.lit(0), F.size("__w") - n + 1)
        shifted = F.arrays_zip(*[F.slice("__w", F.lit(i + 1), many).alias(f"w{i}") for i in range(n)])
        return F.transform(shifted, lambda x: F.xxhash64(F.lit("w"), F.concat_ws(" ", *[x[f"w{i}"] for i in range(n)])))

    all_grams = F.array_distinct(F.concat(*[grams(n) for n in sizes]))
    dealt = texts.withColumn("__w", words(text)).select(F.col(id_col), F.explode(all_grams).alias("__gram"))
    met = dealt.join(asked.select("__gram", quote_id), "__gram").select(id_col, quote_id).distinct()
    return met.join(texts, id_col).join(quotes, quote_id).where(F.contains(F.col(text), F.col(quote)))


def map_merge(left: Column | str, right: Column | str) -> Column:
    """Shallow map union, entries of the right winning."""
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.map_concat(kept, right)


def provenance_filter(provenance: Column, mode: str) -> Column:
    """all, both, or one source only, of a ``|``-joined provenance."""
    parts = F.split(provenance, r"\|")
    return {"all": F.lit(True), "both": F.size(parts) > 1}.get(mode, F.array_contains(parts, mode))
