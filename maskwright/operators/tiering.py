"""Flags, outcome classes and quality tiers of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flags(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold (K5)."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))


def classify(text: Column, classes: dict[str, str]) -> Column:
    """The one class whose pattern is found; several give mixed, none unknown (K2)."""
    found = flags({name: text.rlike(pattern) for name, pattern in classes.items()})
    return F.when(F.size(found) == 0, "unknown").when(F.size(found) > 1, "mixed").otherwise(F.element_at(found, 1))


def with_tier(df: DataFrame, hard: str = "hard_flags", review: str = "review_flags") -> DataFrame:
    """rejected, needs_review or recommended, and what may be trained on (K8)."""
    status = F.when(F.size(hard) > 0, "rejected").when(F.size(review) > 0, "needs_review").otherwise("recommended")
    return df.withColumns({"status": status, "training_eligible": F.size(hard) == 0, "recommended_for_training": status == "recommended"})


def overbroad(cited: Column, n_catalog: Column, least: int, share: float) -> Column:
    """Whether a step cites too much of the catalogue (K6)."""
    n = F.size(F.array_distinct(cited))
    return (n >= least) & (n / F.greatest(F.lit(1), n_catalog) >= share)
