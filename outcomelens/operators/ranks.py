"""Row numbers in a global order over any sortable keys, without one task that holds all rows.

Prefix sums need a number to cut into ranges; an order by text, by several columns or by their mixture does not give
one. Here Spark samples the keys and deals the rows into ranges; every range is sorted in its own task and
stored with the place of each row in it. The number of a row is its place plus the rows of the ranges
before, which are one number per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.session import materialise

#: Rows that one range should hold about.
RANGE_ROWS = 1_000_000
_ROW_BITS = 33  # of a generated id: partition above, row in the partition below


def range_count(df: DataFrame, rows: int) -> int:
    """Ranges for so many rows: the session's shuffle partitions, or more where a million rows each need more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))


def in_ranges(df: DataFrame, order: Sequence[Column], rows: int | None = None) -> DataFrame:
    """Rows dealt into ascending ranges of ``order`` and sorted inside them."""
    ranges = range_count(df, df.count() if rows is None else rows)
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def number_rows(df: DataFrame, order: Sequence[Column], out: str = "place", stored: bool = False) -> DataFrame:
    """Add ``out``: 1, 2, 3... in ``order``. Rows equal in all of ``order`` are numbered in any order.

    ``stored`` says that ``df`` is cheap to read again; otherwise it is written once, since it is
    counted, sampled and dealt.
    """
    source = df if stored else materialise(df, "unnumbered")
    placed = in_ranges(source, order).select(
        "*",
        F.spark_partition_id().alias("__range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__place"),
    )
    placed = materialise(placed, "numbered")
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per range
    before, heads = 0, []
    for row in sorted(sizes, key=lambda r: r["__range"]):
        heads += [F.lit(row["__range"]), F.lit(before).cast("long")]
        before += row.n
    head = F.element_at(F.create_map(*heads), F.col("__range")) if heads else F.lit(0)
    return placed.withColumn(out, head + F.col("__place") + 1).drop("__range", "__place")
