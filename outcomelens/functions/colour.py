"""Fill colours for region layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from outcomelens.constants import ACCURACY_COLOURS, ACCURACY_RANGE, NO_DATA_COLOUR

Rgb = tuple[int, int, int]


def two_colour_fill(
    value: Column,
    value_range: tuple[float, float] = ACCURACY_RANGE,
    colours: tuple[Rgb, Rgb] = ACCURACY_COLOURS,
) -> Column:
    """``#rrggbb`` on a clamped straight line between two colours; grey for null."""
    low, high = value_range
    clamped = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
    t = (clamped - F.lit(float(low))) / F.lit(high - low + 1e-9)
    start, end = colours
    channels = [
        (F.lit(float(a)) + t * F.lit(float(b - a))).cast("int") for a, b in zip(start, end)
    ]
    usable = value.isNotNull() & ~F.isnan(value)
    return F.when(usable, F.format_string("#%02x%02x%02x", *channels)).otherwise(NO_DATA_COLOUR)


def ramp_fill(value: Column, low: Column, high: Column, stops: Sequence[Rgb]) -> Column:
    """``#rrggbbaa`` on a ramp of evenly spaced stops between ``low`` and ``high``.

    Values outside the range take the end colours; null stays null.
    """
    last = len(stops) - 1
    edges = [low + (high - low) * F.lit(i / last) for i in range(last + 1)]

    def colour(parts: Sequence[Column]) -> Column:
        # 255.9999 spreads 0..1 over the 256 channel values.
        channels = [(p * F.lit(255.9999)).cast("int") for p in parts]
        return F.format_string("#%02x%02x%02xff", *channels)

    def fixed(stop: Rgb) -> Column:
        return colour([F.lit(c / 255.0) for c in stop])

    out = F.when(value <= edges[0], fixed(stops[0])).when(value >= edges[last], fixed(stops[last]))
    for i in range(1, last + 1):
        p = F.try_divide(value - edges[i - 1], edges[i] - edges[i - 1])
        mixed = [
            (F.lit(1.0) - p) * F.lit(a / 255.0) + p * F.lit(b / 255.0)
            for a, b in zip(stops[i - 1], stops[i])
        ]
        out = out.when(value <= edges[i], colour(mixed))
    return out


def ramp_fill_from(value: Column, low: Column, high: Column, stops: Column) -> Column:
    """:func:`ramp_fill` with the ramp in a column: an array of ``[r, g, b]`` from 0 to 1, two stops at least.

    One expression whatever the number of ramps and stops, so that many ramps stay small; the ramp, the place on it
    and the mixed colour are each computed once a row. Where ``low`` equals ``high`` the first stop is taken.
    """
    fill = _bound(stops, lambda ramp: _mixed_on(ramp, value, low, high))
    return F.when(value.isNotNull(), fill)


def _bound(part: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a part that is computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(part), body), 0)


def _mixed_on(ramp: Column, value: Column, low: Column, high: Column) -> Column:
    last = F.size(ramp) - 1

    def edge(k: Column) -> Column:
        return low + (high - low) * (k / last)

    def part(i: Column) -> Column:
        p = F.coalesce(F.try_divide(value - edge(i), edge(i + 1) - edge(i)), F.lit(0.0))
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))

    def mixed(i: Column, p: Column) -> Column:
        return F.zip_with(
            F.get(ramp, i), F.get(ramp, i + 1), lambda a, b: ((F.lit(1.0) - p) * a + p * b) * F.lit(255.9999)
        )

    def text(rgb: Column) -> Column:
        return F.format_string("#%02x%02x%02xff", *[F.get(rgb, c).cast("int") for c in range(3)])

    inner = F.filter(
        F.transform(ramp, lambda _, k: k), lambda k: (k > 0) & (k < last) & (value > edge(k))
    )
    return _bound(F.size(inner), lambda i: _bound(part(i), lambda p: _bound(mixed(i, p), text)))


def ramp_column(stops: Sequence[Rgb]) -> Column:
    return F.array(*[F.array(*[F.lit(c / 255.0) for c in stop]) for stop in stops])
