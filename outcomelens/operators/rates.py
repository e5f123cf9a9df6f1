"""Outcome rates by key, pivot and bin.

Every report is one grouped aggregation with map-side combine. Rows whose key is
null are left out unless ``null_keys='keep'``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import BUSY_MIN_COUNT, BUSY_TOP_N, SEASON_ORDER
from outcomelens.functions.numeric import log_count, percent, ratio
from outcomelens.functions.parsing import numeric_then_text
from outcomelens.operators.columns import quoted
from outcomelens.operators.quantiles import add_bins, quantile_edges
from outcomelens.session import materialise


def _with_keys(df: DataFrame, keys: Sequence[str], null_keys: str) -> DataFrame:
    if null_keys == "keep":
        return df
    if null_keys == "drop":
        return df.na.drop(subset=list(keys))
    raise ValueError(f"unknown null_keys: {null_keys}")


def outcome_rate(
    df: DataFrame, keys: Sequence[str], label: str, null_keys: str = "drop", out: str = "rate_pct"
) -> DataFrame:
    """Percent of rows with the outcome, per key combination."""
    return (
        _with_keys(df, keys, null_keys)
        .groupBy(*[quoted(k) for k in keys])
        .agg(percent(F.avg(quoted(label))).alias(out))
    )


def rate_order(keys: Sequence[str], rate: str = "rate_pct") -> list[Column]:
    """Highest rate first, ties by key."""
    return [quoted(rate).desc(), *[quoted(k).asc() for k in keys]]


def by_rate(report: DataFrame, keys: Sequence[str], rate: str = "rate_pct") -> DataFrame:
    return report.orderBy(*rate_order(keys, rate))


def by_key(report: DataFrame, key: str) -> DataFrame:
    """Keys in numeric order where they are numbers, else in text order."""
    return report.orderBy(*numeric_then_text(quoted(key)))


def outcome_pivot(
    df: DataFrame, row: str, column: str, values: Sequence[object], label: str, prefix: str = ""
) -> DataFrame:
    """Mean outcome, one row per ``row`` value and one column per listed ``column`` value."""
    table = (
        _with_keys(df, [row, column], "drop")
        .groupBy(quoted(row))
        .pivot(column, list(values))
        .agg(F.avg(quoted(label)))
    )
    return table.toDF(row, *[f"{prefix}{v}" for v in values])


def busiest_groups(
    df: DataFrame, key: str, label: str, min_count: int = BUSY_MIN_COUNT, top: int = BUSY_TOP_N
) -> DataFrame:
    """The ``top`` largest groups above ``min_count`` rows, with their rate."""
    return (
        _with_keys(df, [key], "drop")
        .groupBy(quoted(key))
        .agg(
            percent(F.avg(quoted(label))).alias("rate_pct"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("n") > min_count)
        .orderBy(F.col("n").desc(), quoted(key).asc())
        .limit(top)
    )


def intensity(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, outcomes and rate per key, beside the overall rate of all rows.

    Both come from the per-key totals, which are written once: one scan.
    """
    per_key = df.groupBy(quoted(key)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(quoted(label)).alias("labelled"),
        F.sum(quoted(label)).cast("long").alias("outcomes"),
    )
    per_key = materialise(per_key, "intensity")
    overall = per_key.agg(percent(ratio(F.sum("outcomes"), F.sum("labelled")))).scalar()
    keyed = per_key.filter(quoted(key).isNotNull()).drop("labelled")
    return keyed.withColumns(
        {"rate_pct": percent(ratio(F.col("outcomes"), F.col("n"))), "overall_pct": overall}
    )


def rate_by_season(df: DataFrame, key: str, label: str) -> DataFrame:
    """Seasons that occur, in calendar order."""
    order = F.array(*[F.lit(s) for s in SEASON_ORDER])
    return outcome_rate(df, [key], label).orderBy(F.array_position(order, quoted(key)))


def rate_by_frequency_bin(df: DataFrame, key: str, label: str, q: int = 20) -> DataFrame:
    """Outcome rate by equal-mass bin of log(1 + rows sharing the key).

    A key's rows all have the same frequency, so per-key totals carry everything:
    no frequency is joined back to the rows.
    """
    per_key = (
        _with_keys(df, [key], "drop")
        .groupBy(quoted(key))
        .agg(F.count(F.lit(1)).alias("freq"), F.sum(quoted(label)).cast("long").alias("hits"))
    )
    merged = (
        per_key.groupBy("freq")
        .agg(F.sum("freq").alias("n"), F.sum("hits").alias("hits"))
        .withColumn("log_freq", log_count(F.col("freq")))
    )
    merged = materialise(merged, "frequencies")
    binned = add_bins(merged, "log_freq", quantile_edges(merged, "log_freq", q), q)
    return (
        binned.filter(F.col("bin").isNotNull())
        .groupBy("bin", "bin_low", "bin_high")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
        .select("bin", "bin_low", "bin_high", "n", percent(ratio(F.col("hits"), F.col("n"))).alias("rate_pct"))
    )


def rate_by_bin(df: DataFrame, value: str, label: str, q: int) -> DataFrame:
    """Outcome rate by equal-mass bin of a numeric column, from its distinct values."""
    merged = (
        _with_keys(df, [value], "drop")
        .groupBy(quoted(value))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(quoted(label)).cast("long").alias("hits"))
    )
    merged = materialise(merged, "values")
    binned = add_bins(merged, value, quantile_edges(merged, value, q), q)
    return (
        binned.filter(F.col("bin").isNotNull())
        .groupBy("bin", "bin_low", "bin_high")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
        .select("bin", "bin_low", "bin_high", "n", percent(ratio(F.col("hits"), F.col("n"))).alias("rate_pct"))
    )
