from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcomelens.operators import metrics as M
from outcomelens.operators import models as L
from outcomelens.operators.sampling import add_class_weights, split_by_hash

CAT, NUM = ["kind", "area"], ["hour", "size"]


@pytest.fixture(scope="module")
def tables(spark):
    """Label follows from kind and size, with noise from the id."""
    df = spark.range(3_000).select(
        "id",
        F.concat(F.lit("k"), F.col("id") % 5).alias("kind"),
        (F.col("id") % 13).cast("int").alias("area"),
        (F.col("id") % 24).cast("double").alias("hour"),
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 1000) / 1000.0).alias("size"),
    )
    signal = (F.col("size") > 0.6) | ((F.col("kind") == "k3") & (F.col("hour") > 8))
    df = df.withColumn(
        "label", F.when(F.col("id") % 17 == 0, 1 - signal.cast("double")).otherwise(signal.cast("double"))
    ).withColumn("area", F.col("area").cast("string")).na.fill(0.5, ["size"]).na.fill(0.0, ["label"])
    return split_by_hash(df, ["id"])


def quality(model, test):
    return M.roc_auc(L.score_table(model, test)).first().auc


def test_logistic_learns_repeats_and_names_its_numbers(spark, tables):
    train, test = tables
    pipeline = L.logistic_pipeline(CAT, NUM, num_features=1 << 10, max_iter=15, reg_param=0.01)
    model = L.fit(pipeline, train)
    assert quality(model, test) > 0.8
    first = L.score_table(model, test, ["id"]).orderBy("id").collect()
    second = L.score_table(L.fit(pipeline, train), test, ["id"]).orderBy("id").collect()
    assert [r.score for r in first] == pytest.approx([r.score for r in second])
    assert len(first) == test.count()
    weights = {r.feature: r.coef for r in L.numeric_coefficients(spark, model, NUM).collect()}
    assert set(weights) == {"hour_imp", "size_imp"}
    assert weights["size_imp"] > 0
    top = L.strongest(L.numeric_coefficients(spark, model, NUM), 1).first()
    assert top.feature == "size_imp"


def test_trees_learn(spark, tables):
    train, test = tables
    stages = L.one_hot_stages(CAT, NUM)
    forest = L.fit(L.forest_pipeline(stages, num_trees=10, max_depth=6), add_class_weights(train, "label"))
    assert quality(forest, test) > 0.8
    assert L.feature_count(forest) == 5 + 13 + 2
    used = {r.feature: r.importance for r in L.feature_importance(spark, forest).collect()}
    assert sum(used.values()) == pytest.approx(1.0)
    assert max(used, key=used.get) == "size"
    boosted = L.fit(
        L.boosted_pipeline(stages, rounds=5, max_depth=4, step=0.3), add_class_weights(train, "label", "positive")
    )
    assert quality(boosted, test) > 0.8


def test_unseen_levels_are_all_zero(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("a",), ("b",), ("a",)], "kind string")
    model = Pipeline(stages=L.one_hot_stages(["kind"], [])).fit(train)
    test = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "kind string")
    rows = model.transform(test).select("kind", vector_to_array("features").alias("v")).collect()
    assert {r.kind: list(r.v) for r in rows} == {"a": [1, 0], "b": [0, 1], "new": [0, 0], None: [0, 0]}


def test_integer_keys_are_hashed_as_levels(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([(1, 5), (2, 7)], "id int, area int")
    stages = L.hashing_stages(["area"], [], 1 << 10)
    out = Pipeline(stages=stages).fit(df).transform(df).select("features").collect()
    assert [list(r.features.values) for r in out] == [[1.0], [1.0]]
    assert out[0].features.indices[0] != out[1].features.indices[0]


def test_named_columns_are_hashed_not_indexed(spark, tables):
    train, _ = tables
    wide = train.withColumn("block", F.col("id").cast("string"))
    stages = L.mixed_stages(["kind", "area"], ["block"], NUM, 1 << 8)
    model = L.fit(L.forest_pipeline(stages, num_trees=3, max_depth=3, weight=None), wide)
    assert L.feature_count(model) == 5 + 13 + 2 + (1 << 8)
