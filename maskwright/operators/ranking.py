"""Aggregations, rankings, sampling and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: case alias marks in their order; fixed values
ALIAS_MARKS = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥"


def alias_suffix(index: Column, legacy: bool = False) -> Column:
    """Mark of a zero-based index: past the marks its number, or - as the legacy way has it - the marks again."""
    marks = F.array(*[F.lit(c) for c in ALIAS_MARKS])
    n = len(ALIAS_MARKS)
    wrapped = F.element_at(marks, (index % n + 1).cast("int"))
    if legacy:
        return wrapped
    return F.when(index < n, wrapped).otherwise(F.lpad((index + 1).cast("string"), 2, "0"))


def running_index(df: DataFrame, scope: list[str], entity: str, order: str) -> DataFrame:
    """``scope, entity, idx``: entities numbered from 0 by first appearance."""
    first = df.groupBy(*scope, entity).agg(F.min(order).alias("first_at"))
    w = Window.partitionBy(*scope).orderBy("first_at", entity)
    return first.withColumn("idx", F.row_number().over(w) - 1)


def numbered(df: DataFrame, scope: list[str], order: list[str], pattern: str, name: str = "evidence_id") -> DataFrame:
    """Stable ids within a scope, like E001."""
    return df.withColumn(name, F.format_string(pattern, F.row_number().over(Window.partitionBy(*scope).orderBy(*order))))


def alias_collisions(df: DataFrame, scope: list[str], alias: str, owner: str, exempt: Column | None = None) -> DataFrame:
    """Aliases that stand for several owners."""
    source = df if exempt is None else df.where(~exempt)
    return source.groupBy(*scope, alias).agg(F.count_distinct(owner).alias("n_owners")).where("n_owners > 1")


def most_common(df: DataFrame, scope: list[str], value: str, order: str) -> DataFrame:
    """The commonest value, the first seen of equals."""
    counts = df.groupBy(*scope, value).agg(F.count("*").alias("n"), F.min(order).alias("first_at"))
    return counts.groupBy(*scope).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("first_at"))).alias("top")).select(*scope, "top.*")


def histogram(df: DataFrame, value: str, count: str = "n") -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias(count))


def explode_counts(df: DataFrame, counts: str, keys: list[str]) -> DataFrame:
    """Sum of count maps by kind.

    An outer explode, as for an inner one the optimiser filters by the map's
    size, and makes the maps twice for that.
    """
    return df.select(*keys, F.explode_outer(counts).alias("kind", "n")).where("kind is not null").groupBy(*keys, "kind").agg(F.sum("n").alias("n_masked"))


#: values a step of percentile_floor counts apart
BINS = 4096


def percentile_floor(df: DataFrame, value: str, share: float) -> int | None:
    """Nearest-rank percentile: the value at index floor(share * (n - 1)) of the sorted ones.

    Whole numbers.  Counted from a histogram of the values in bins, then in bins
    of the bin the value is in, so no task has to sort them all.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("long").alias("v")).agg(F.count("*").alias("n"))
    low, high, total = counts.agg(F.min("v"), F.max("v"), F.sum("n")).first()
    if not total:
        return None
    rank = int(share * (total - 1))
    while low < high:  # 4096 bins a step: one step for a range up to that, two up to 16 million
        width = -(-(high - low + 1) // BINS)
        bins = counts.where(F.col("v").between(low, high)).groupBy(F.floor((F.col("v") - low) / width).alias("b")).agg(F.sum("n").alias("n"))
        for b, n in sorted(map(tuple, bins.collect())):
            if rank < n:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            rank -= n
    return low


def risk_priority_sample(df: DataFrame, key: str, group: str, length: str, size: int, seed: str, rare: int = 2) -> DataFrame:
    """Review sample: rare groups, then long texts, then the rest, shuffled by a seeded hash."""
    p95 = percentile_floor(df, length, 0.95)
    sizes = df.groupBy(group).agg(F.count("*").alias("group_size"))
    rank = F.when(F.col("group_size") <= rare, 0).when(F.col(length) >= F.lit(p95), 1).otherwise(2)
    shuffled = F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), 256)
    picked = df.join(sizes, group).withColumns({"priority": rank, "__h": shuffled}).orderBy("priority", "__h", key).limit(size)
    w = Window.orderBy("priority", "__h", key)  # over at most ``size`` rows
    return picked.withColumn("sample_rank", F.row_number().over(w)).drop("__h")


def best_of_each(df: DataFrame, group: str, order: list[str], limit: int | None = None) -> DataFrame:
    """First row of each group, then the others, both in order."""
    lead = df.groupBy(group).agg(F.min(F.struct(*order)).alias("__lead"))
    marked = df.join(lead, group).withColumn("rest", (F.struct(*order) != F.col("__lead")).cast("int")).drop("__lead")
    out = marked.orderBy("rest", *order)
    return out if limit is None else out.limit(limit)


def quota_sample(df: DataFrame, group: str, kind: str, key: str, quota: int) -> DataFrame:
    """Up to ``quota`` rows a group, taken in turns from its kinds."""
    h = F.sha2(F.col(key).cast("string"), 256)
    turn = F.row_number().over(Window.partitionBy(group, kind).orderBy(h, key))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("turn", kind, h, key))
    return df.withColumn("turn", turn).withColumn("sample_rank", rank).where(F.col("sample_rank") <= quota)


def admit_within_budget(df: DataFrame, scope: list[str], order: str, cost: str, cap: int, latch: bool = True) -> DataFrame:
    """``admitted``: rows whose running cost stays within the cap; with ``latch`` the first refusal ends a scope."""
    w = Window.partitionBy(*scope).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    fits = df.withColumn("running_cost", F.sum(cost).over(w)).withColumn("admitted", F.col("running_cost") <= cap)
    return fits.withColumn("admitted", F.min("admitted").over(w)) if latch else fits


def rank_key(column: str, *first: str) -> Column:
    """Position of a value in a fixed order, all others after them (O1)."""
    rank = F.lit(len(first))
    for i in reversed(range(len(first))):
        rank = F.when(F.col(column) == first[i], i).otherwise(rank)
    return rank


def clamp(value, low: int, high: int, default: int) -> int:
    """A limit from outside: bad values give the default, others stay within bounds."""
    try:
        return max(low, min(high, int(value)))
    except (TypeError, ValueError):
        return default
