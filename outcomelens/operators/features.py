"""Calendar, cyclical and frequency features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.functions.calendar import MONDAY0, cyclical, day_of_week, is_weekend, season
from outcomelens.operators.columns import quoted
from outcomelens.operators.joins import BROADCAST_ROWS, attach_counts


def add_calendar(df: DataFrame, ts: str, base: str = MONDAY0) -> DataFrame:
    """Year, Month, DayOfWeek, Hour, IsWeekend and Season of a timestamp."""
    at = quoted(ts)
    return df.withColumns(
        {
            "Year": F.year(at),
            "Month": F.month(at),
            "DayOfWeek": day_of_week(at, base),
            "Hour": F.hour(at),
            "IsWeekend": is_weekend(at),
            "Season": season(F.month(at)),
        }
    )


def add_cyclical(df: DataFrame, periods: dict[str, int]) -> DataFrame:
    """``<column>_sin`` and ``<column>_cos`` for each column and cycle length."""
    out = {}
    for name, period in periods.items():
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclical(quoted(name), period)
    return df.withColumns(out)


def key_counts(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per non-null key."""
    return df.filter(quoted(key).isNotNull()).groupBy(quoted(key)).agg(F.count(F.lit(1)).alias(out))


def add_frequency(
    df: DataFrame,
    key: str,
    out: str,
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """How often each row's key occurs; null for a null key."""
    return attach_counts(df, key_counts(df, key, out), key, out, spread_by, broadcast_rows)
