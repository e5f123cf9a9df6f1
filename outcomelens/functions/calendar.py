"""Calendar parts of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY0 = "monday0"
SUNDAY1 = "sunday1"


def day_of_week(ts: Column, base: str = MONDAY0) -> Column:
    """``monday0``: Monday is 0. ``sunday1``: Sunday is 1."""
    if base == MONDAY0:
        return F.weekday(ts)
    if base == SUNDAY1:
        return F.dayofweek(ts)
    raise ValueError(f"unknown day-of-week base: {base}")


def is_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday, else 0 (null for a null timestamp)."""
    return F.weekday(ts).isin(5, 6).cast("int")


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Fall")
    )


def cyclical(col: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle of ``period`` steps."""
    angle = col.cast("double") * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)
