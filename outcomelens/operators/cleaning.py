"""Row filters, null handling and completeness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import MISSING_LEVEL
from outcomelens.functions.parsing import parse_flag, parse_timestamp
from outcomelens.operators.columns import quoted


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a value in each required column; reaches the scan as IsNotNull."""
    return df.na.drop(subset=list(required))


def keep_parsed(df: DataFrame, **parsed: Column) -> DataFrame:
    """Add parsed columns and keep the rows where all of them could be read."""
    return df.withColumns(parsed).na.drop(subset=list(parsed))


def keep_labelled(df: DataFrame, flag: str, label: str = "label") -> DataFrame:
    return keep_parsed(df, **{label: parse_flag(quoted(flag))})


def keep_dated(df: DataFrame, date: str, ts: str = "ts") -> DataFrame:
    return keep_parsed(df, **{ts: parse_timestamp(quoted(date))})


def fill_missing_levels(df: DataFrame, columns: Sequence[str], level: str = MISSING_LEVEL) -> DataFrame:
    """Categorical columns as text, with nulls as a level of their own."""
    filled = {
        c: F.coalesce(quoted(c).cast("string"), F.lit(level)) for c in columns if c in df.columns
    }
    return df.withColumns(filled)


def completeness(df: DataFrame, column: str) -> DataFrame:
    """Non-null and total row counts in one pass."""
    return df.agg(
        F.count(quoted(column)).alias("non_null"), F.count(F.lit(1)).alias("total")
    )


def has_key(df: DataFrame, column: str) -> bool:
    """Whether any row carries the key; stops at the first one found."""
    return not df.filter(quoted(column).isNotNull()).select(quoted(column)).limit(1).isEmpty()


def keep_in_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows whose values lie within all bounds; null counts as outside."""
    out = df
    for column, (low, high) in bounds.items():
        out = out.filter(quoted(column).between(low, high))
    return out


def keep_members(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(quoted(column).isin(*values))


def keep_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(quoted(column) == F.lit(value))


def keep_at_least(df: DataFrame, column: str, floor: float) -> DataFrame:
    return df.filter(quoted(column) >= F.lit(floor))


def table_profile(df: DataFrame, label: str) -> DataFrame:
    """Row count, column count and mean outcome in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.avg(quoted(label)).alias("outcome_mean"),
    )
