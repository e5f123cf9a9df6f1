"""Prefix sums over the distinct values of an ordered column.

The building block of ROC and PR areas, thresholds and exact quantiles. Equal
values are first merged into one row (with map-side combine), which leaves no hot
key: every (group, value) is one row. The merged table is written once to the
shared folder, because the steps below read it several times with different
columns, and the source should be scanned once only.

Its row count is then known. A table of at most ``SMALL_ROWS`` rows takes one
window per group, and so do the groups of at most that many rows in a larger table. Larger
groups are cut into :func:`bucket_count` value ranges of about equal
size, whatever the distribution, from approximate percentiles of the merged rows.
A prefix sum is the total of the lower ranges plus the running sum inside the
row's own range, so no task sorts a whole group. The cut points only place the
cuts: any choice of them gives the same exact result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelens.operators.columns import quoted
from outcomelens.session import materialise

BUCKETS = 1_024  # powers of two, for the binary search below
MOST_BUCKETS = 65_536
ROWS_PER_BUCKET = 1_000_000
SMALL_ROWS = 100_000


def bucket_count(rows: int) -> int:
    """Ranges for a table of so many rows: about a million rows each, within bounds."""
    wanted = max(1, -(-rows // ROWS_PER_BUCKET))
    return min(MOST_BUCKETS, max(BUCKETS, 1 << (wanted - 1).bit_length()))


def merge_equal(
    df: DataFrame, value: str, measures: Mapping[str, Column], groups: Sequence[str] = ()
) -> DataFrame:
    """One stored row per group and distinct value (not null, not NaN), with the summed measures."""
    known = quoted(value).isNotNull()
    if dict(df.dtypes).get(value) in ("float", "double"):
        known &= ~F.isnan(quoted(value))  # NaN would rank above every number
    merged = (
        df.filter(known)
        .groupBy(*[quoted(c) for c in [*groups, value]])
        .agg(*[F.sum(c).alias(name) for name, c in measures.items()])
    )
    return materialise(merged, "merged")


def _with_range(df: DataFrame, bounds: Column, value: str, buckets: int) -> DataFrame:
    """Add ``__range``: how many of the sorted bounds are <= the value.

    A binary search, one projection per halving, so that it stays in generated code.
    """
    out = df.withColumn("__bounds", bounds).withColumn("__range", F.lit(0))
    for i in range(1, buckets.bit_length()):
        step = buckets >> i
        middle = F.get("__bounds", F.col("__range") + F.lit(step - 1))
        out = out.withColumn(
            "__range",
            F.when(middle <= quoted(value), F.col("__range") + F.lit(step)).otherwise(F.col("__range")),
        )
    return out.drop("__bounds")


def prefix_sums(
    merged: DataFrame,
    value: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Add ``<m>_below`` (sum over strictly lower values) and ``<m>_total`` per group.

    ``merged`` has one row per group and value and is cheap to read again, as
    :func:`merge_equal` returns it.
    """
    rows = merged.count()
    if rows <= small_rows:
        return _whole_groups(merged, value, measures, groups)
    if not groups:
        return _ranged_groups(merged, value, measures, groups, bucket_count(rows))
    sizes = merged.groupBy(*[quoted(c) for c in groups]).agg(F.count(F.lit(1)).alias("__rows"))
    found = sizes.agg(
        F.min("__rows").alias("least"),
        F.max("__rows").alias("most"),
        F.sum(F.when(F.col("__rows") > small_rows, F.col("__rows"))).alias("large"),
    ).first()
    if found.most <= small_rows:
        return _whole_groups(merged, value, measures, groups)
    if found.least > small_rows:
        return _ranged_groups(merged, value, measures, groups, bucket_count(rows))
    # Every large group has more than ``small_rows`` rows, so they are few.
    large = sizes.filter(F.col("__rows") > small_rows).select(
        *[quoted(c).alias(f"__key{i}") for i, c in enumerate(groups)]
    )
    large = F.broadcast(materialise(large, "large_groups"))
    same = reduce(and_, [quoted(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(groups)])
    ranged = merged.join(large, same, "left_semi")
    small = merged.join(large, same, "left_anti")
    return _ranged_groups(ranged, value, measures, groups, bucket_count(found.large)).unionByName(
        _whole_groups(small, value, measures, groups)
    )


def _whole_groups(
    merged: DataFrame, value: str, measures: Sequence[str], groups: Sequence[str]
) -> DataFrame:
    group = W.partitionBy(*[quoted(c) for c in groups])
    before = group.orderBy(quoted(value)).rowsBetween(W.unboundedPreceding, -1)
    below = {f"{m}_below": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures}
    total = {f"{m}_total": F.sum(m).over(group) for m in measures}
    return merged.withColumns(below | total)


def _ranged_groups(
    merged: DataFrame, value: str, measures: Sequence[str], groups: Sequence[str], buckets: int
) -> DataFrame:
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = merged.agg(F.percentile_approx(quoted(value), cuts, F.lit(4 * buckets))).scalar()
    keys = [quoted(c) for c in groups]
    rows = _with_range(merged, bounds, value, buckets)

    # At most ``buckets`` rows per group in the two windows over cells.
    cells = rows.groupBy(*keys, "__range").agg(*[F.sum(m).alias(f"__{m}_cell") for m in measures])
    lower = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    heads = cells.select(
        *keys,
        "__range",
        F.lit(0).alias("__row"),
        *[F.coalesce(F.sum(f"__{m}_cell").over(lower), F.lit(0)).alias(m) for m in measures],
        *[F.sum(f"__{m}_cell").over(whole).alias(f"{m}_total") for m in measures],
    )

    # Each cell's lower sum heads its own rows, so the running sum starts from it and no
    # join is needed.
    headed = rows.withColumn("__row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    before = (
        W.partitionBy(*keys, "__range")
        .orderBy("__row", quoted(value))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    below = {f"{m}_below": F.sum(m).over(before) for m in measures}
    total = {f"{m}_total": F.first(f"{m}_total").over(before) for m in measures}
    return (
        headed.withColumns(below | total)
        .filter(F.col("__row") == 1)
        .select(
            *[quoted(c) for c in merged.columns],
            *[f"{m}_below" for m in measures],
            *[f"{m}_total" for m in measures],
        )
    )
