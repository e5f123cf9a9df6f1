"""Reproducible sampling, splitting and class weights.

Rows are chosen by a hash of a stable id, so the choice does not depend on
partitioning and a recomputed task chooses the same rows. The id columns must tell
rows apart. Exact sizes and weights need totals of the table; they are found first
(two numbers) and enter the plan as literals, so a trainer that passes over the
rows many times does not find them anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelens.functions.hashing import hash_below, stable_hash
from outcomelens.operators.columns import quoted
from outcomelens.session import materialise

# One salt per purpose, so that a split does not depend on an earlier sample.
THIN, SAMPLE, SPLIT = "thin", "sample", "split"


def _hash(ids: Sequence[str], salt: str) -> Column:
    return stable_hash(*[quoted(c) for c in ids], salt=salt)


def thin_negatives(df: DataFrame, label: str, ids: Sequence[str], fraction: float) -> DataFrame:
    """All positives and a fraction of the negatives."""
    return df.filter(
        (quoted(label) == 1) | ((quoted(label) == 0) & hash_below(_hash(ids, THIN), fraction))
    )


def sample_by_hash(df: DataFrame, ids: Sequence[str], fraction: float) -> DataFrame:
    """The same fraction of every stratum, in expectation."""
    return df.filter(hash_below(_hash(ids, SAMPLE), fraction))


def split_by_hash(
    df: DataFrame, ids: Sequence[str], test_fraction: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; disjoint and together the whole table."""
    in_test = hash_below(_hash(ids, SPLIT), test_fraction)
    return df.filter(~in_test), df.filter(in_test)


def _cut_hashes(
    df: DataFrame, label: str, ids: Sequence[str], salt: str, takes: Column
) -> dict[int, int]:
    """Per class, the largest hash among its first ``takes`` rows in hash order.

    ``takes`` reads the columns ``own`` (rows of the class), ``other`` (rows of the
    other class) and ``cls``. Hashes are uniform, so a histogram over their leading
    bits leaves one range in 65,536 to rank by row.
    """
    hashed = df.filter(quoted(label).isin(0, 1)).select(
        quoted(label).cast("int").alias("cls"), _hash(ids, salt).alias("h")
    )
    hashed = materialise(hashed, "hashes")  # the input is read once for both passes
    leading = F.shiftright(F.col("h"), 44)  # 16 of 60 bits
    hist = hashed.groupBy("cls", leading.alias("r")).agg(F.count(F.lit(1)).alias("c"))
    # at most 2 * 65,536 rows
    upto = W.partitionBy("cls").orderBy("r")
    hist = hist.select(
        "cls",
        "r",
        "c",
        F.sum("c").over(upto).alias("upto"),
        F.sum("c").over(W.partitionBy("cls")).alias("own"),
        F.sum("c").over(W.partitionBy()).alias("both"),
    ).withColumn("other", F.col("both") - F.col("own"))
    cut = (
        hist.withColumn("take", takes)
        .filter((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("c") < F.col("take")))
        .select("cls", "r", (F.col("take") - (F.col("upto") - F.col("c"))).alias("left"))
        .collect()  # at most one row per class
    )
    if not cut:
        return {}
    inside = reduce(or_, [(F.col("cls") == c.cls) & (leading == c.r) for c in cut])
    wanted = reduce(or_, [(F.col("cls") == c.cls) & (F.col("rank") == c.left) for c in cut])
    ranked = hashed.filter(inside).withColumn(
        "rank", F.row_number().over(W.partitionBy("cls").orderBy("h"))
    )
    return {row.cls: row.h for row in ranked.filter(wanted).collect()}


def _up_to_cut(
    df: DataFrame, label: str, ids: Sequence[str], salt: str, takes: Column
) -> Column:
    cuts = _cut_hashes(df, label, ids, salt, takes)
    tests = [(quoted(label) == cls) & (_hash(ids, salt) <= F.lit(h)) for cls, h in sorted(cuts.items())]
    return reduce(or_, tests, F.lit(False))


def stratified_sample(
    df: DataFrame, label: str, ids: Sequence[str], fraction: float
) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows of each class of a 0/1 label."""
    takes = F.bround(F.col("own") * F.lit(float(fraction)), 0).cast("long")
    return df.filter(_up_to_cut(df, label, ids, SAMPLE, takes))


def stratified_sample_size(df: DataFrame, label: str, ids: Sequence[str], size: int) -> DataFrame:
    """About ``size`` rows at one fraction for both classes; the whole table if it is smaller."""
    share = F.lit(float(size)) / (F.col("own") + F.col("other"))
    takes = F.when(share >= 1.0, F.col("own")).otherwise(
        F.bround(F.col("own") * share, 0).cast("long")
    )
    return df.filter(_up_to_cut(df, label, ids, SAMPLE, takes))


def training_rows(test_fraction: float) -> Column:
    """Rows of class ``cls`` in the training set, from ``own`` and ``other`` (rows of the classes).

    Products of two row counts pass the range of a long above a few billion rows, so they are decimals.
    """
    own, other = (F.col(c).cast("decimal(19,0)") for c in ("own", "other"))
    n = F.col("own") + F.col("other")
    n_train = (n - F.ceil(n * F.lit(float(test_fraction)))).cast("decimal(19,0)")
    whole = n.cast("decimal(19,0)")
    spot, other_spot = own * n_train, other * n_train
    rest, other_rest = F.pmod(spot, whole), F.pmod(other_spot, whole)
    base = ((spot - rest) / whole).cast("long")
    wins = (rest > other_rest) | ((rest == other_rest) & (rest > 0) & (F.col("cls") == 1))
    return base + wins.cast("long")


def stratified_split(
    df: DataFrame, label: str, ids: Sequence[str], test_fraction: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Train and test with exact sizes: the test set has ``ceil(test_fraction * n)`` rows.

    Each class gives its whole share to the training set; the last row goes to the
    class with the larger remainder.
    """
    in_train = _up_to_cut(df, label, ids, SPLIT, training_rows(test_fraction))
    labelled = df.filter(quoted(label).isin(0, 1))
    return labelled.filter(in_train), labelled.filter(~in_train)


def add_class_weights(
    df: DataFrame, label: str, scheme: str = "balanced", out: str = "weight"
) -> DataFrame:
    """``balanced``: n / (2 * n_class). ``positive``: negatives / positives on positives, else 1."""
    is_pos = quoted(label) == 1
    totals = df.agg(F.count_if(is_pos).alias("p"), F.count_if(quoted(label) == 0).alias("n")).first()
    p, n = totals.p, totals.n
    if scheme == "balanced":
        on_pos, on_neg = (p + n) / (2.0 * p) if p else None, (p + n) / (2.0 * n) if n else None
    elif scheme == "positive":
        on_pos, on_neg = n / p if p else None, 1.0
    else:
        raise ValueError(f"unknown weight scheme: {scheme}")
    return df.withColumn(out, F.when(is_pos, F.lit(on_pos)).otherwise(F.lit(on_neg)).cast("double"))
