"""Boosted trees with Newton leaf values, and forests grown in batches.

Spark's own boosting draws columns per node and takes the mean of a leaf's residuals. Here every round
draws its columns and rows once, fits one Spark regression tree to the Newton step ``-g / h`` with weight ``h`` (whose
variance gain is the usual gain in ``G**2 / H``), and sets each leaf to ``-G / (H + ridge)``: the tree's mean
is ``-G / H`` and its table of nodes holds ``H``. Margins travel with the rows and are stored every few rounds, so a plan holds a few trees only and a lost
executor costs a re-read.

A forest of many deep trees is grown a batch at a time: a row carries the sampling counts of one batch only.
Both end as an ordinary Spark model, put together from the tables of their trees.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelens.functions.hashing import hash_below, stable_hash
from outcomelens.operators.columns import quoted
from outcomelens.operators.model_tables import join_boosted, join_forests, saved
from outcomelens.session import ensure_checkpoint_dir, materialise, scratch_path, spread_rows

STORE_EVERY = 5
BATCH_TREES = 20


def gradient(margin: Column, label: Column, weight: Column) -> tuple[Column, Column]:
    """First and second derivative of the weighted logistic loss by the margin."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return weight * (p - label), weight * F.greatest(p * (F.lit(1.0) - p), F.lit(1e-16))


def fit_boosted(
    train: DataFrame,
    ids: Sequence[str] = (),
    rounds: int = 400,
    max_depth: int = 9,
    step: float = 0.03,
    subsample: float = 0.8,
    column_share: float = 0.8,
    ridge: float = 1.0,
    seed: int = 42,
    weight: str | None = "weight",
    store_every: int = STORE_EVERY,
) -> GBTClassificationModel:
    """Boost from ``features``, ``label`` and ``weight``.

    ``ids`` decide which rows a round draws; without them it is the row's place in the stored input.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    given = quoted(weight).cast("double") if weight else F.lit(1.0)
    state = train.select(
        (stable_hash(*[quoted(c) for c in ids]) if ids else F.monotonically_increasing_id()).alias("row"),
        "features",
        F.col("label").cast("double").alias("label"),
        given.alias("weight"),
        F.lit(0.0).alias("margin"),
    )
    state = materialise(spread_rows(state), "boost0")
    first = state.select("features").first()
    if first is None:
        raise ValueError("no rows to learn from")
    width = first.features.size
    folder = scratch_path(spark, "trees")
    values, places = [], []
    for i in range(rounds):
        tree, drawn = _grow(state, i, width, max_depth, subsample, column_share, seed)
        leaves = leaf_values(spark, saved(tree, f"{folder}/{i}"), ridge)
        values.append(leaves)
        places.append(drawn)
        if i + 1 < rounds:
            leaf = F.get(F.array(*[F.lit(v) for v in leaves]), F.col("leaf").cast("int"))
            moved = tree.transform(_sliced(state, drawn)).withColumn("margin", F.col("margin") + F.lit(step) * leaf)
            state = moved.select("row", "features", "label", "weight", "margin")
            if (i + 1) % store_every == 0:
                state = materialise(state, f"boost{i + 1}")
    # Spark's boosted classifier doubles the margin before its logistic curve.
    params = {"maxDepth": max_depth, "maxIter": rounds, "stepSize": step, "subsamplingRate": subsample, "seed": seed}
    return join_boosted(spark, folder, values, places, step / 2, width, params)


def _sliced(df: DataFrame, places: list[int] | None) -> DataFrame:
    if places is None:
        return df.withColumn("drawn", F.col("features"))
    return VectorSlicer(inputCol="features", outputCol="drawn", indices=places).transform(df)


def _grow(state, i, width, max_depth, subsample, column_share, seed):
    """The tree of one round and the columns it saw."""
    places = None
    if column_share < 1.0:
        wanted = max(1, round(width * column_share))
        places = sorted(random.Random(f"{seed}:{i}").sample(range(width), wanted))
    rows = state
    if subsample < 1.0:
        again = stable_hash(F.col("row"), salt=f"boost{seed}:{i}")
        rows = rows.filter(hash_below(again, subsample))
    g, h = gradient(F.col("margin"), F.col("label"), F.col("weight"))
    rows = _sliced(rows.withColumns({"g": g, "h": h}).withColumn("step", -F.col("g") / F.col("h")), places)
    learner = DecisionTreeRegressor(
        featuresCol="drawn",
        labelCol="step",
        weightCol="h",
        predictionCol="mean_step",
        leafCol="leaf",
        maxDepth=max_depth,
        minInstancesPerNode=1,
        seed=seed + i,
    )
    return learner.fit(rows.select("drawn", "step", "h")), places


def leaf_values(spark: SparkSession, path: str, ridge: float) -> list[float]:
    """Newton values of a saved tree's leaves, in the order in which the tree numbers them.

    Leaves are numbered depth first, as nodes are. There are at most ``2 ** max_depth``.
    """
    h = F.col("impurityStats")[0]  # summed weights, which are the curvatures
    leaves = spark.read.parquet(f"{path}/data").filter("leftChild < 0")
    return [r.value for r in leaves.select("id", (F.col("prediction") * h / (h + F.lit(ridge))).alias("value")).orderBy("id").collect()]


def fit_forest(
    train: DataFrame,
    num_trees: int = 400,
    max_depth: int = 20,
    min_leaf: int = 2,
    seed: int = 42,
    weight: str | None = "weight",
    bootstrap: bool = True,
    batch_trees: int = BATCH_TREES,
) -> RandomForestClassificationModel:
    """A forest from ``features``, ``label`` and ``weight``, ``batch_trees`` trees at a time."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    train = train.select("features", "label", *([weight] if weight else []))
    train = materialise(spread_rows(train), "forest")
    paths = []
    for at in range(0, num_trees, batch_trees):
        learner = RandomForestClassifier(
            numTrees=min(batch_trees, num_trees - at),
            maxDepth=max_depth,
            minInstancesPerNode=min_leaf,
            featureSubsetStrategy="sqrt",
            checkpointInterval=10,
            bootstrap=bootstrap,
            seed=seed + at,
        )
        model = (learner.setWeightCol(weight) if weight else learner).fit(train)
        if num_trees <= batch_trees:
            return model
        paths.append(saved(model))
    return join_forests(spark, paths, {"seed": seed})


class NewtonBoosting(Estimator):
    """:func:`fit_boosted` as the last stage of a pipeline."""

    def __init__(self, **settings: object) -> None:
        super().__init__()
        self.settings = settings

    def _fit(self, df: DataFrame) -> GBTClassificationModel:
        return fit_boosted(df, **self.settings)


class BatchedForest(Estimator):
    """:func:`fit_forest` as the last stage of a pipeline."""

    def __init__(self, **settings: object) -> None:
        super().__init__()
        self.settings = settings

    def _fit(self, df: DataFrame) -> RandomForestClassificationModel:
        return fit_forest(df, **self.settings)
