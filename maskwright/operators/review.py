"""Query surface of a review desk: filtered lists, counters, facets, history and exports (H1, H2, H4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import clamp

DECISIONS = ("pass", "fail", "follow_up")
SEVERITIES = ("none", "low", "medium", "high", "critical")


def like_any(columns: list[str], text: str) -> Column:
    """Case-insensitive substring search; % and _ of the text stay wildcards."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.col(c).ilike(f"%{text}%")
    return hit


class ReviewStore:
    """``cases`` (key, case_type, in_sample, sample_rank, ...) and ``reviews`` (key, decision, severity, ...)."""

    def __init__(self, cases: DataFrame, reviews: DataFrame, key: str, search: list[str]):
        self.all, self.reviews, self.key, self.search = cases, reviews, key, search

    def _scoped(self, scope: str) -> DataFrame:
        return self.all.where("in_sample") if scope == "sample" else self.all

    def joined(self, scope: str = "all") -> DataFrame:
        return self._scoped(scope).join(self.reviews, self.key, "left").withColumn("decision", F.coalesce("decision", F.lit("pending")))

    def cases(self, scope: str = "sample", status: str = "all", case_type: str | None = None, q: str | None = None, limit=200) -> DataFrame:
        """The work list, sampled cases first by rank."""
        found = self.joined(scope)
        if status != "all":
            found = found.where(F.col("decision") == status)
        if case_type:
            found = found.where(F.col("case_type") == case_type)
        if q:
            found = found.where(like_any(self.search, q))
        return found.orderBy(F.col("sample_rank").asc_nulls_last(), self.key).limit(clamp(limit, 1, 1000, 200))

    def stats(self, scope: str = "all") -> DataFrame:
        """One row of counters."""
        count = lambda d: F.count_if(F.col("decision") == d)
        return self.joined(scope).agg(
            F.count("*").alias("total"), count("pending").alias("pending"), count("pass").alias("passed"), count("fail").alias("failed"), count("follow_up").alias("follow_up")
        )

    def facets(self, column: str = "case_type") -> DataFrame:
        """Values by frequency."""
        return self.all.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)

    def case(self, value) -> DataFrame:
        return self.joined().where(F.col(self.key) == value)

    def export(self, scope: str = "all", issues: str = "issues") -> DataFrame:
        """Reviewed rows with issues joined by |."""
        return self.joined(scope).where("decision <> 'pending'").withColumn(issues, F.array_join(issues, "|"))

    def public(self, columns: list[str]) -> DataFrame:
        """What still needs eyes: rows whose review is not a pass."""
        return self.joined().where("decision <> 'pass'").select(*columns)


def review_errors(decision: Column, severity: Column, issues: Column, notes: Column, reviewer: Column, known_issues: list[str]) -> Column:
    """Error codes of a submitted review, empty if it may be saved."""
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(decision.isin(*DECISIONS), F.lit(False)), "invalid_decision"),
            F.when(~F.coalesce(severity.isin(*SEVERITIES), F.lit(True)), "invalid_severity"),
            F.when(F.exists(issues, lambda x: ~x.isin(*known_issues)), "unknown_issue"),
            F.when(F.length(notes) > 10_000, "notes_too_long"),
            F.when(F.length(reviewer) > 100, "reviewer_too_long"),
        )
    )


def history_latest(history: DataFrame, key: str, order: str, n: int = 20) -> DataFrame:
    """The newest entries of each key."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(F.desc(order))
    return history.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)


def append_history(history: DataFrame, saved: DataFrame, order: str, number: str = "id") -> DataFrame:
    """The history with what was saved since; entries are never changed, new ones numbered on in their order.

    Numbers follow each other, so one task numbers a batch of saved rows: those
    of people's reviews between two runs, not a table.
    """
    from pyspark.sql import Window

    last = history.agg(F.coalesce(F.max(number), F.lit(0)).alias("__last"))
    numbered = saved.crossJoin(F.broadcast(last)).withColumn(number, F.col("__last") + F.row_number().over(Window.orderBy(order)))
    return history.unionByName(numbered.select(history.columns))
