"""Levels, medians, models as tables, and trees grown round by round or in batches."""

from __future__ import annotations

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from outcomelens.operators import boosting as B
from outcomelens.operators import encoders as E
from outcomelens.operators import levels as LV
from outcomelens.operators import metrics as M
from outcomelens.operators import model_tables as MT
from outcomelens.operators import models as L


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """A third of the rows hold one level; ids decide the label through a rule."""
    df = spark.range(1_500).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("kind"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 24).cast("double")).alias("hour"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 31 % 100).cast("double")).alias("size"),
    )
    label = (F.coalesce("size", F.lit(0.0)) > 50) | (F.col("kind") == "c7")
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    df.withColumn("label", label.cast("double")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("broadcast_rows", [0, 1_000])
def test_levels_and_unseen_ones(spark, rows, broadcast_rows):
    table = LV.level_table(rows, ["kind"])
    counts = sorted(rows.groupBy("kind").count().collect(), key=lambda r: (-r["count"], r.kind))
    assert [(r.level, r.n, r.slot) for r in table.orderBy("slot").collect()] == [(r.kind, r["count"], i) for i, r in enumerate(counts)]
    new = rows.select("id", F.when(F.col("id") == 5, "unseen").when(F.col("id") == 6, None).otherwise(F.col("kind")).alias("kind"))
    got = {r.id: r["__slot_0"] for r in LV.attach_slots(new, table, ["kind"], ["id"], broadcast_rows).collect()}
    slot = {r.kind: i for i, r in enumerate(counts)}
    assert len(got) == 1_500 and got[5] is None and got[6] is None
    assert all(got[r.id] == slot[r.kind] for r in rows.collect() if r.id not in (5, 6))


def test_vectors_are_made_and_read_back(spark):
    df = spark.createDataFrame([([0, 3], [1.0, 2.5]), ([], [])], "i array<int>, v array<double>")
    made = df.select(LV.sparse_vector(F.lit(4), F.col("i"), F.col("v")).alias("x"))
    assert [r.x for r in made.collect()] == [Vectors.sparse(4, [0, 3], [1.0, 2.5]), Vectors.sparse(4, [], [])]
    dense = spark.createDataFrame([(Vectors.dense([0.5, 0.0]),), (Vectors.sparse(3, [2], [1.0]),)], ["x"])
    got = [[tuple(e) for e in r.e] for r in dense.select(LV.vector_entries(F.col("x")).alias("e")).collect()]
    assert got == [[(0, 0.5), (1, 0.0)], [(2, 1.0)]]


def test_a_saved_pipeline_keeps_medians_and_levels(spark, rows, tmp_path):
    stages = L.one_hot_stages(["kind"], ["hour", "size"], impute=True)
    model = Pipeline(stages=stages).fit(rows)
    known = sorted(r["hour"] for r in rows.collect() if r["hour"] is not None)
    assert model.stages[0].getOrDefault(model.stages[0].medians)[0] == known[(len(known) + 1) // 2 - 1]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(rows).select("id", vector_to_array("features").alias("v")).orderBy("id").collect() for m in (model, again))
    assert a == b and len(a) == 1_500 and len(a[0].v) == 41 + 2
    names = {r.feature: r.name for r in again.stages[1].feature_names().collect()}
    assert names[0] == "kind=hot" and names[42] == "size_imp" and len(names) == 43


def test_an_empty_column_has_no_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, None)], "a double, b double")
    model = E.MedianImputer(inputCols=["a", "b"], outputCols=["x", "y"]).fit(df)
    assert [(r.x, r.y) for r in model.transform(df).collect()] == [(None, 1.0)] * 3


def test_batches_make_one_forest(spark, rows):
    encoded = Pipeline(stages=L.one_hot_stages(["kind"], ["hour", "size"], impute=True)).fit(rows).transform(rows)
    forest = B.fit_forest(encoded, num_trees=5, max_depth=4, weight=None, batch_trees=2)
    assert forest.getNumTrees == 5 and len(forest.trees) == 5
    assert M.roc_auc(L.score_table(forest, encoded, ["label"])).first().auc > 0.9
    nodes = MT.tree_nodes(spark, MT.saved(forest))
    assert {r.tree: r.n for r in nodes.groupBy("tree").agg(F.count("*").alias("n")).collect()} == {
        i: t.numNodes for i, t in enumerate(forest.trees)
    }
    own = {r.feature: r.importance for r in MT.importances(nodes).collect()}
    assert [own.get(i, 0.0) for i in range(43)] == pytest.approx(list(forest.featureImportances.toArray()))


def test_boosting_by_hand(spark):
    """Two rounds over four cells, against the sums they stand for."""
    cells = {(0.0, 0.0): (40, 4), (0.0, 1.0): (30, 15), (1.0, 0.0): (20, 16), (1.0, 1.0): (50, 20)}
    made = [(a, b, float(i < p)) for (a, b), (n, p) in cells.items() for i in range(n)]
    df = spark.createDataFrame([(Vectors.dense([a, b]), a, b, y) for a, b, y in made], ["features", "a", "b", "label"])
    model = B.fit_boosted(df, rounds=2, max_depth=2, step=0.5, subsample=1.0, column_share=1.0, ridge=2.0, weight=None)
    for r in L.score_table(model, df, ["a", "b", "label"]).dropDuplicates(["a", "b"]).collect():
        (n, p), margin = cells[r.a, r.b], 0.0
        for _ in range(2):
            q = 1 / (1 + math.exp(-margin))
            margin += 0.5 * (p - n * q) / (n * q * (1 - q) + 2.0)
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)))


def test_drawn_columns_go_back_to_their_places(spark, rows):
    encoded = Pipeline(stages=L.one_hot_stages(["kind"], ["hour", "size"], impute=True)).fit(rows).transform(rows)
    settings = {"rounds": 7, "max_depth": 3, "step": 0.5, "column_share": 0.5, "weight": None, "store_every": 3}
    model = B.fit_boosted(encoded, ["id"], **settings)
    assert model.numFeatures == 43 and model.getNumTrees == 7
    assert M.roc_auc(L.score_table(model, encoded, ["label"])).first().auc > 0.9
    own = {r.feature: r.importance for r in MT.importances(MT.tree_nodes(spark, MT.saved(model)), per_tree=False).collect()}
    assert [own.get(i, 0.0) for i in range(43)] == pytest.approx(list(model.featureImportances.toArray()))
    again = B.fit_boosted(encoded, ["id"], **settings)
    first, second = (L.score_table(m, encoded, ["id", "label"]).orderBy("id").collect() for m in (model, again))
    assert [r.score for r in first] == pytest.approx([r.score for r in second])


def test_a_written_model_scores_as_written(spark):
    model = MT.linear_model(spark, [0.5, -1.0], 0.25)
    df = spark.createDataFrame([(Vectors.dense([2.0, 1.0]), 1.0)], ["features", "label"])
    assert L.score_table(model, df, []).first().score == pytest.approx(1 / (1 + math.exp(-0.25)))
