"""Exact quantiles and equal-mass bins, without holding all values in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.operators.columns import quoted
from outcomelens.operators.prefix import merge_equal, prefix_sums


def quantile_edges(merged: DataFrame, value: str, q: int, count: str = "n") -> DataFrame:
    """One row ``edges``: the distinct i/q quantiles, i = 0..q, in ascending order.

    ``merged`` is a stored table with one row per value and its ``count``. Between two ranks the edge
    is interpolated linearly from the nearer end.
    """
    if q < 1:
        raise ValueError("q must be at least 1")
    ranked = prefix_sums(merged, value, [count])
    below, n, total = F.col(f"{count}_below"), F.col(count), F.col(f"{count}_total")

    def holds(position: Column) -> Column:
        return (position >= below) & (position < below + n)

    # Ranks as whole numbers: floor of i*(n-1)/q from integer remainders.
    def low_rank(i: Column) -> Column:
        spot = i * (total - F.lit(1))
        return ((spot - F.pmod(spot, F.lit(q))) / F.lit(q)).cast("long")

    def high_rank(i: Column) -> Column:
        return F.least(low_rank(i) + F.lit(1), total - F.lit(1))

    # Most rows hold no wanted rank. Rank i is i*(n-1)/q, so a row can only hold one if
    # a whole number lies between its own ends on that scale; the margin covers rounding.
    scale = F.lit(float(q)) / F.greatest(total - F.lit(1), F.lit(1))
    first = F.ceil((below - F.lit(1)) * scale - F.lit(1e-6))
    last = F.floor((below + n) * scale + F.lit(1e-6))
    ranked = ranked.filter(first <= last)

    places = F.sequence(F.lit(0).cast("long"), F.lit(q).cast("long"))
    hits = F.filter(places, lambda i: holds(low_rank(i)) | holds(high_rank(i)))
    found = ranked.select(
        F.explode(hits).alias("i"), quoted(value).cast("double").alias("v"), below, n, total
    )
    i = F.col("i")
    ends = found.groupBy("i").agg(
        F.max(F.when(holds(low_rank(i)), F.col("v"))).alias("lo"),
        F.max(F.when(holds(high_rank(i)), F.col("v"))).alias("hi"),
        F.max(F.pmod(i * (total - F.lit(1)), F.lit(q))).alias("rest"),
    )
    part = F.col("rest") / F.lit(float(q))
    gap = F.col("hi") - F.col("lo")
    edge = (
        F.when(F.col("rest") == 0, F.col("lo"))
        .when(part < 0.5, F.col("lo") + gap * part)
        .otherwise(F.col("hi") - gap * (F.lit(1.0) - part))
    )
    # q + 1 rows
    return ends.agg(F.array_sort(F.array_distinct(F.collect_list(edge))).alias("edges"))


def bin_of(value: Column, edges: Column, q: int) -> Column:
    """1-based right-closed bin among at most ``q + 1`` edges; the lowest edge belongs to bin 1.

    Null for a null value, outside values, and edges that form no bin.
    """
    lower = [F.coalesce((F.get(edges, F.lit(i)) < value).cast("int"), F.lit(0)) for i in range(q + 1)]
    number = F.greatest(reduce(add, lower), F.lit(1))
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    return F.when(inside & (F.size(edges) > 1), number)


def add_bins(df: DataFrame, value: str, edges: DataFrame, q: int, out: str = "bin") -> DataFrame:
    """Add ``bin``, ``bin_low`` and ``bin_high`` from a one-row ``edges`` table."""
    name = "__edges"
    return (
        df.withColumn(name, edges.scalar())
        .withColumn(out, bin_of(quoted(value).cast("double"), F.col(name), q))
        .withColumn(f"{out}_low", F.when(quoted(out).isNotNull(), F.get(F.col(name), quoted(out) - 1)))
        .withColumn(f"{out}_high", F.when(quoted(out).isNotNull(), F.get(F.col(name), quoted(out))))
        .drop(name)
    )


def quantile_bins(df: DataFrame, value: str, q: int, out: str = "bin") -> DataFrame:
    """Rows with their equal-mass bin; duplicate edges are dropped."""
    merged = merge_equal(df, value, {"n": F.lit(1)})
    return add_bins(df, value, quantile_edges(merged, value, q), q, out)


def lower_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its median: the observed value at rank ceil(n/2)."""
    long = df.select(*[quoted(c).cast("double").alias(c) for c in columns]).unpivot(
        [], [quoted(c) for c in columns], "name", "value"
    )
    merged = merge_equal(long, "value", {"n": F.lit(1)}, ["name"])
    ranked = prefix_sums(merged, "value", ["n"], ["name"])
    target = F.floor((F.col("n_total") + F.lit(1)) / F.lit(2)).cast("long")
    return ranked.filter(
        (F.col("n_below") < target) & (F.col("n_below") + F.col("n") >= target)
    ).select("name", F.col("value").alias("median"))


def impute_median(df: DataFrame, columns: Sequence[str], suffix: str = "_imp") -> DataFrame:
    """Add ``<column>_imp``: the value, or the column's exact median where null."""
    medians = (
        lower_medians(df, columns)
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "median"))))  # one entry per column
        .scalar()
    )
    filled = df.withColumn("__medians", medians)
    for c in columns:
        filled = filled.withColumn(
            f"{c}{suffix}",
            F.coalesce(quoted(c).cast("double"), F.element_at(F.col("__medians"), F.lit(c))),
        )
    return filled.drop("__medians")
