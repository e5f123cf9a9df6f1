from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from outcomelens.operators import sampling as S


@pytest.fixture(scope="module")
def df(spark):
    return spark.range(10_007).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))


def ids(frame):
    return {r.id for r in frame.select("id").collect()}


def test_split_is_a_partition_whatever_the_layout(spark, df):
    train, test = S.split_by_hash(df, ["id"], 0.2)
    assert ids(train) | ids(test) == ids(df) and not ids(train) & ids(test)
    again = S.split_by_hash(df.repartition(13, F.rand(3)), ["id"], 0.2)[1]
    assert ids(again) == ids(test)
    assert 0.18 < len(ids(test)) / 10_007 < 0.22


def test_stratified_split_has_exact_sizes(df):
    train, test = S.stratified_split(df, "label", ["id"], 0.2)
    n, pos = 10_007, df.filter("label = 1").count()
    n_test = math.ceil(0.2 * n)
    assert test.count() == n_test and train.count() == n - n_test
    share = test.filter("label = 1").count()
    assert abs(share - pos * n_test / n) < 1
    assert not ids(train) & ids(test)


def test_stratified_split_of_doubles(spark, df):
    as_double = df.withColumn("label", F.col("label").cast("double"))
    assert ids(S.stratified_split(as_double, "label", ["id"])[1]) == ids(S.stratified_split(df, "label", ["id"])[1])


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 1.0])
def test_stratified_sample_takes_the_rounded_share(df, fraction):
    out = S.stratified_sample(df, "label", ["id"], fraction)
    for label in (0, 1):
        n = df.filter(F.col("label") == label).count()
        assert out.filter(F.col("label") == label).count() == round(fraction * n)


def test_sample_larger_than_the_table_is_the_table(df):
    assert S.stratified_sample_size(df, "label", ["id"], 85_000_000).count() == 10_007
    some = S.stratified_sample_size(df, "label", ["id"], 1_000)
    assert abs(some.count() - 1_000) <= 1


def test_thinning_keeps_every_positive(df):
    out = S.thin_negatives(df, "label", ["id"], 0.2)
    assert ids(out.filter("label = 1")) == ids(df.filter("label = 1"))
    kept = out.filter("label = 0").count() / df.filter("label = 0").count()
    assert 0.17 < kept < 0.23


def test_weights(df):
    balanced = S.add_class_weights(df, "label", "balanced").groupBy("label").agg(F.sum("weight").alias("w"))
    assert {r.label: round(r.w, 6) for r in balanced.collect()} == {0: 5003.5, 1: 5003.5}
    positive = S.add_class_weights(df, "label", "positive").filter("label = 1").first().weight
    assert positive == pytest.approx(df.filter("label = 0").count() / df.filter("label = 1").count())
    one_class = S.add_class_weights(df.filter("label = 0"), "label", "positive")
    assert one_class.select("weight").distinct().collect() == [(1.0,)]
    with pytest.raises(ValueError):
        S.add_class_weights(df, "label", "other")


def test_split_is_independent_of_an_earlier_sample(df):
    for kept in (S.thin_negatives(df, "label", ["id"], 0.2), S.sample_by_hash(df, ["id"], 0.2)):
        train, test = S.split_by_hash(kept, ["id"], 0.2)
        negatives = kept.filter("label = 0").count()
        assert 0.75 < train.filter("label = 0").count() / negatives < 0.85
    kept = S.stratified_sample(df, "label", ["id"], 0.3)
    train, test = S.stratified_split(kept, "label", ["id"], 0.2)
    assert test.count() == math.ceil(0.2 * kept.count())
    overlap = ids(test) & ids(S.sample_by_hash(df, ["id"], 0.06))
    assert len(overlap) < 0.5 * test.count()


def test_training_rows_hold_beyond_the_range_of_longs(spark):
    from outcomelens.operators.sampling import training_rows

    df = spark.createDataFrame([(0, 3 * 10**12, 7 * 10**12), (1, 7 * 10**12, 3 * 10**12)], "cls int, own long, other long")
    got = {r.cls: r.n for r in df.select("cls", training_rows(0.2).alias("n")).collect()}
    assert got == {0: 24 * 10**11, 1: 56 * 10**11}
    assert sum(r.n for r in spark.createDataFrame([(0, 3, 4), (1, 4, 3)], "cls int, own long, other long").select(training_rows(0.2).alias("n")).collect()) == 5
