"""Ratios, rounding, thresholds and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(rate: Column) -> Column:
    return rate * F.lit(100.0)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def f_score(precision: Column, recall: Column) -> Column:
    """Harmonic mean; null when undefined."""
    return F.try_divide(F.lit(2.0) * precision * recall, precision + recall)


def round_half_up(col: Column, digits: int = 4) -> Column:
    return F.round(col, digits)


def round_half_even(col: Column, digits: int = 3) -> Column:
    return F.bround(col, digits)


def above_threshold(score: Column, threshold: Column | float = 0.5) -> Column:
    """1 where the score reaches the threshold, else 0."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def score_bucket(score: Column, steps: int = 200) -> Column:
    """Lower edge of the score's bucket; a score of 1 is a bucket of its own."""
    return F.floor(score * F.lit(steps)).cast("double") / F.lit(float(steps))


def squared_error(score: Column, label: Column) -> Column:
    gap = score - label.cast("double")
    return gap * gap


def log_count(count: Column) -> Column:
    return F.log1p(count)
