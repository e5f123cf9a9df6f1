"""Comparing models from their metric tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import COMPARED_METRICS, CONFUSION_CELLS, SUMMARY_COLUMNS
from outcomelens.functions.numeric import ratio, round_half_even
from outcomelens.operators.columns import keep_present, quoted


def tall_metrics(
    df: DataFrame, key: str = "Model", metrics: Sequence[str] = COMPARED_METRICS
) -> DataFrame:
    """One row per model and metric."""
    wide = df.select(quoted(key), *[quoted(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([quoted(key)], [quoted(m) for m in metrics], "metric", "value")


def confusion_shares(df: DataFrame, key: str = "Model") -> DataFrame:
    """Each confusion cell as a share of the row; null for an empty row."""
    cells = [quoted(c) for c in CONFUSION_CELLS]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cells])
    return df.select(quoted(key), *[ratio(c, total).alias(n) for c, n in zip(cells, CONFUSION_CELLS)])


def present_auc(df: DataFrame, key: str = "Model", auc: str = "ROC-AUC") -> DataFrame:
    """Models that report an area; no rows when the column is absent."""
    if auc not in df.columns:
        return df.select(quoted(key), F.lit(None).cast("double").alias(auc)).filter(F.lit(False))
    return df.select(quoted(key), quoted(auc)).na.drop(subset=[key, auc])


def model_summary(df: DataFrame, digits: int = 3) -> DataFrame:
    """Present summary columns, fractions rounded half to even."""
    kept = keep_present(df, SUMMARY_COLUMNS)
    out = [
        round_half_even(quoted(c), digits).alias(c) if t in ("double", "float") else quoted(c)
        for c, t in kept.dtypes
    ]
    return kept.select(*out)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def metric_range(
    df: DataFrame,
    metric: str,
    support: str | None = "n_obs",
    min_support: int = 200,
    groups: Sequence[str] = (),
) -> DataFrame:
    """``vmin`` and ``vmax`` of a metric over supported rows.

    Widened by 1e-9 on both sides when (nearly) equal; 0 and 1 when no row counts.
    """
    value = quoted(metric).try_cast("double")
    if support and support in df.columns:
        counted = F.coalesce(quoted(support).try_cast("double"), F.lit(0.0)) >= F.lit(min_support)
        value = F.when(counted, value)
    found = df.groupBy(*[quoted(g) for g in groups]).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return found.select(*[quoted(g) for g in groups], *widened(F.col("lo"), F.col("hi")))


def widened(low: Column, high: Column) -> tuple[Column, Column]:
    equal = F.abs(high - low) <= F.lit(1e-9) * F.greatest(F.abs(high), F.abs(low))
    pad = F.when(equal, F.lit(1e-9)).otherwise(F.lit(0.0))
    return (
        F.coalesce(low - pad, F.lit(0.0)).alias("vmin"),
        F.coalesce(high + pad, F.lit(1.0)).alias("vmax"),
    )


def axis_floor(df: DataFrame, columns: Sequence[str], gap: float, least: float) -> DataFrame:
    """Lowest value of the columns less ``gap``, but at least ``least``."""
    lows = [F.min(quoted(c)) for c in columns]
    lowest = F.least(*lows) if len(lows) > 1 else lows[0]
    return df.agg(F.greatest(F.lit(float(least)), lowest - F.lit(gap)).alias("axis_floor"))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct().orderBy(quoted(column))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order.

    A minimum over the whole row, so each task hands on one row per key and a hot
    key is not sorted in one place.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    row = F.struct(*[quoted(c) for c in [*order, *rest]])
    best = df.groupBy(quoted(key)).agg(F.min(row).alias("__first"))
    return best.select(*[quoted(c) if c == key else F.col("__first")[c].alias(c) for c in df.columns])
