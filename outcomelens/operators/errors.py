"""Where a model errs: error sets and error shares by category and bin.

Here FP_rate and FN_rate are shares of *all* rows of the group, not of a class as
in :mod:`metrics`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.functions.numeric import ratio
from outcomelens.operators.columns import quoted
from outcomelens.operators.quantiles import add_bins, quantile_edges
from outcomelens.session import materialise

LABEL, PREDICTION = "label", "prediction"


def add_outcome(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION, out: str = "outcome"
) -> DataFrame:
    """TP, FP, FN or TN per row."""
    actual, said = quoted(label), quoted(prediction)
    cell = (
        F.when((said == 1) & (actual == 0), "FP")
        .when((said == 0) & (actual == 1), "FN")
        .when((said == 1) & (actual == 1), "TP")
        .when((said == 0) & (actual == 0), "TN")
    )
    return df.withColumn(out, cell)


def error_set(df: DataFrame, cell: str, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """The rows of one confusion cell with all their columns."""
    said, actual = {"FP": (1, 0), "FN": (0, 1), "TP": (1, 1), "TN": (0, 0)}[cell]
    return df.filter((quoted(prediction) == said) & (quoted(label) == actual))


def error_set_sizes(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    tagged = add_outcome(df, label, prediction)
    return tagged.filter(F.col("outcome").isNotNull()).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n")
    )


def _shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "FP_rate": ratio(F.col("FP"), F.col("total")),
            "FN_rate": ratio(F.col("FN"), F.col("total")),
        }
    )


def _error_counts(label: str, prediction: str) -> list[Column]:
    actual, said = quoted(label), quoted(prediction)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if((said == 1) & (actual == 0)).alias("FP"),
        F.count_if((said == 0) & (actual == 1)).alias("FN"),
    ]


def error_rates_by(
    df: DataFrame, keys: Sequence[str], label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Total, FP, FN and their shares per non-null key, in one aggregation."""
    return _shares(
        df.na.drop(subset=list(keys))
        .groupBy(*[quoted(k) for k in keys])
        .agg(*_error_counts(label, prediction))
    )


def top_errors(rates: DataFrame, by: str, key: str, n: int = 15) -> DataFrame:
    """The ``n`` categories with the highest share, ties by key."""
    return rates.orderBy(quoted(by).desc(), quoted(key).asc()).limit(n)


def error_rates_by_bin(
    df: DataFrame, column: str, bins: int = 10, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Error shares per equal-mass bin, binned from the distinct values."""
    merged = (
        df.na.drop(subset=[column])
        .groupBy(quoted(column))
        .agg(*_error_counts(label, prediction))
    )
    merged = materialise(merged, "errors")
    binned = add_bins(merged, column, quantile_edges(merged, column, bins, count="total"), bins)
    return _shares(
        binned.filter(F.col("bin").isNotNull())
        .groupBy("bin", "bin_low", "bin_high")
        .agg(*[F.sum(c).alias(c) for c in ("total", "FP", "FN")])
    )
