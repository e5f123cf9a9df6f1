"""Connected components of stored links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.session import materialise

MOST_ROUNDS = 60


def _smallest(pairs: DataFrame) -> DataFrame:
    """Stored smallest neighbour of every first end; equal ends are summed before the shuffle."""
    return materialise(pairs.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node"), "smallest")


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every linked node that is not the smallest of its component.

    ``links`` has the columns a, b (longs, either order, repeats allowed). A large star ties every larger
    neighbour of a node to the smallest one, a small star every smaller one; in a few rounds each
    component is a star around its smallest node. Every step is stored in the shared folder; only two
    numbers per round reach the driver. The minima are stored before they are joined, so that
    a hub's rows can be split.
    """
    stars = materialise(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = _mark(stars)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        both = stars.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*")
        large = (
            both.join(_smallest(both), F.col("a") == F.col("node"))
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        large = materialise(large, "large_star")
        small = large.join(_smallest(large), F.col("a") == F.col("node")).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p")
        )
        stars = materialise(small.select("p.*").filter(F.col("a") != F.col("b")).distinct(), "small_star")
        before, mark = mark, _mark(stars)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
