from __future__ import annotations

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from outcomelens.operators import prefix as PX
from outcomelens.operators import quantiles as Q
from outcomelens.operators.joins import attach_counts


def skewed_rows(n: int, seed: int) -> pd.DataFrame:
    """Half the rows in one group, most scores in a sliver, many ties."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        if rng.random() < 0.6:
            score = 0.001 + rng.random() * 1e-9
        else:
            score = rng.randint(0, 40) / 40
        rows.append((group, score, int(rng.random() < 0.3)))
    return pd.DataFrame(rows, columns=["g", "score", "label"])


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("small_rows", [0, 10**9])
def test_prefix_sums_by_brute_force(spark, groups, small_rows):
    pdf = skewed_rows(4_000, 1)
    df = spark.createDataFrame(pdf, "g string, score double, label int")
    merged = PX.merge_equal(df, "score", {"pos": F.col("label"), "n": F.lit(1)}, groups)
    out = PX.prefix_sums(merged, "score", ["pos", "n"], groups, small_rows).toPandas()

    pdf["g"] = pdf["g"].fillna("-")
    keys = groups or [lambda _: 0]
    expected = {}
    for key, part in pdf.groupby(keys[0]):
        per = part.groupby("score").agg(pos=("label", "sum"), n=("label", "size")).sort_index()
        below = per.cumsum() - per
        for score in per.index:
            expected[(key if groups else 0, score)] = (
                *below.loc[score], *per.sum(), *per.loc[score],
            )
    found = {
        ((r.g or "-") if groups else 0, r.score): (r.pos_below, r.n_below, r.pos_total, r.n_total, r.pos, r.n)
        for r in out.itertuples()
    }
    assert found == expected


def test_ranges_are_of_similar_size_under_skew(spark):
    """The value ranges follow the data: a sliver holding most scores is cut finely."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 9, F.lit(0.5) + F.col("id") * 1e-12).otherwise(F.col("id") / 40_000).alias("v")
    )
    merged = PX.merge_equal(df, "v", {"n": F.lit(1)})
    cuts = [i / PX.BUCKETS for i in range(1, PX.BUCKETS)]
    bounds = merged.agg(F.percentile_approx("v", cuts, F.lit(4 * PX.BUCKETS)).alias("b")).first().b
    spread = PX._with_range(merged, F.array(*map(F.lit, bounds)), "v", PX.BUCKETS)
    sizes = [r["count"] for r in spread.groupBy("__range").count().collect()]
    assert len(sizes) > 0.9 * PX.BUCKETS
    assert max(sizes) < 6 * 40_000 / PX.BUCKETS


def test_prefix_sums_of_nothing(spark):
    df = spark.createDataFrame([], "score double")
    for small in (0, 10):
        merged = PX.merge_equal(df, "score", {"n": F.lit(1)})
        assert PX.prefix_sums(merged, "score", ["n"], (), small).count() == 0


@pytest.mark.parametrize("q", [1, 4, 10, 20])
@pytest.mark.parametrize("kind", ["uniform", "ties", "heavy"])
def test_bins_equal_qcut(spark, q, kind):
    rng = random.Random(q)
    if kind == "uniform":
        data = [rng.random() for _ in range(997)]
    elif kind == "ties":
        data = [float(rng.randint(0, 9)) for _ in range(500)]
    else:
        data = [1.0] * 400 + [float(i) for i in range(150)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)] + [(-1, None)], "i int, v double")
    out = {r.i: r.bin for r in Q.quantile_bins(df, "v", q).collect()}
    assert out.pop(-1) is None
    codes = pd.qcut(pd.Series(data), q, labels=False, duplicates="drop")
    assert [out[i] for i in range(len(data))] == [int(c) + 1 for c in codes]


def test_no_bin_without_spread(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert {r.bin for r in Q.quantile_bins(df, "v", 4).collect()} == {None}


def test_medians(spark):
    rows = [(1.0, 5.0), (2.0, None), (3.0, 7.0), (4.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert {r.name: r.median for r in Q.lower_medians(df, ["a", "b"]).collect()} == {"a": 2.0, "b": 5.0}
    out = Q.impute_median(df, ["a", "b"]).orderBy("a").collect()
    assert [r.b_imp for r in out] == [5.0, 5.0, 7.0, 5.0]


def test_counts_join_both_ways(spark):
    """Hot, rare and null keys get the same counts with and without the broadcast."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string"))
    df = spark.range(6_000).select("id", key.alias("k"))
    counts = df.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    wide = attach_counts(df, counts, "k", "n", ["id"], broadcast_rows=10**6)
    split = attach_counts(df, counts, "k", "n", ["id"], broadcast_rows=0)
    assert sorted(map(tuple, wide.select("id", "n").collect())) == sorted(map(tuple, split.select("id", "n").collect()))
    assert split.filter("k = 'hot'").select("n").distinct().collect() == [(2_000,)]
    assert split.filter("k is null and n is not null").isEmpty()


def test_ranges_follow_the_row_count():
    from outcomelens.operators.prefix import BUCKETS, MOST_BUCKETS, bucket_count

    assert bucket_count(0) == bucket_count(10**6) == BUCKETS
    assert bucket_count(2 * 10**9) == 2_048 and bucket_count(10**10) == 16_384
    assert bucket_count(10**12) == MOST_BUCKETS
    assert all(bucket_count(n).bit_count() == 1 for n in (1, 10**7, 3 * 10**9))


def test_nan_has_no_rank(spark):
    from pyspark.sql import functions as F

    from outcomelens.operators.prefix import merge_equal

    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (1.0,)], "v double")
    assert [tuple(r) for r in merge_equal(df, "v", {"n": F.lit(1)}).collect()] == [(1.0, 2)]


def _by_group(rows):
    """Sums strictly below and in all, by group and value."""
    out = {}
    for key in {k for k, _, _ in rows}:
        below, total = 0, sum(n for k, _, n in rows if k == key)
        for _, value, n in sorted(r for r in rows if r[0] == key):
            out[key, value] = (below, total)
            below += n
    return out


@pytest.mark.parametrize("large", [[], [("x", None)], [("x", None), (None, 5), ("y", 7)]])
def test_small_groups_of_a_large_table_are_not_cut(spark, large):
    """Only groups of more than ``small_rows`` rows go through ranges; null keys are groups as well."""
    rng = random.Random(len(large))
    small = [(a, b) for a in ("x", "y", None) for b in (None, *range(40)) if (a, b) not in large]
    rows = [(k, float(v), rng.randint(0, 5)) for k in small for v in rng.sample(range(100), 9)]
    rows += [(k, v / 300, rng.randint(0, 5)) for k in large for v in range(300)]
    df = spark.createDataFrame([(*k, v, n) for k, v, n in rows], "a string, b int, v double, n long")
    merged = PX.merge_equal(df, "v", {"n": F.col("n")}, ["a", "b"])
    out = PX.prefix_sums(merged, "v", ["n"], ["a", "b"], small_rows=50)
    assert out.columns == ["a", "b", "v", "n", "n_below", "n_total"]
    found = [(((r.a, r.b), r.v), (r.n_below, r.n_total)) for r in out.collect()]
    assert len(found) == len(rows) and dict(found) == _by_group(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(a#\d+, b#\d+, ([a-z_]+)#\d+", plan)
    assert "v" in specs and ("__range" in specs) == bool(large)
