"""Models as tables, and tables as models.

Spark keeps a saved model as Parquet: one row of coefficients, or one row per node of a tree.
Read as a table such a model can be queried; and tables of nodes from many fits can be put together to one model that
Spark loads, scores and saves again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.linalg import DenseMatrix, DenseVector, MatrixUDT, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.session import scratch_path



def _write_metadata(spark: SparkSession, path: str, kind: str, estimator, params: dict, extra: dict) -> None:
    """What Spark writes beside every model: its class and its parameters."""
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    text = {
        "class": f"org.apache.spark.ml.classification.{kind}",
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "uid": f"{type(estimator).__name__}_{uuid.uuid4().hex[:12]}",
        "paramMap": params,
        "defaultParamMap": defaults,
        **extra,
    }
    spark.createDataFrame([(json.dumps(text),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def _metadata(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path}/metadata").first().value


# Linear models -------------------------------------------------------------------


def linear_model(spark: SparkSession, coefficients: Sequence[float], intercept: float) -> LogisticRegressionModel:
    """A fitted logistic model from its numbers."""
    path = scratch_path(spark, "linear")
    _write_metadata(spark, path, "LogisticRegressionModel", LogisticRegression(), {}, {})
    n = len(coefficients)
    row = (2, n, DenseVector([intercept]), DenseMatrix(1, n, list(coefficients), True), False)
    schema = T.StructType(
        [
            T.StructField("numClasses", T.IntegerType()),
            T.StructField("numFeatures", T.IntegerType()),
            T.StructField("interceptVector", VectorUDT()),
            T.StructField("coefficientMatrix", MatrixUDT()),
            T.StructField("isMultinomial", T.BooleanType()),
        ]
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return LogisticRegressionModel.load(path)


# Trees ---------------------------------------------------------------------------


def saved(model: Model, path: str | None = None) -> str:
    """Path of the model, written in the shared folder."""
    path = path or scratch_path(SparkSession.active(), "model")
    model.write().overwrite().save(path)
    return path


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row per node of a saved ensemble: tree, node, depth-first children, split, value, gain, weight.

    ``weight`` is the summed weight of the training rows that reached the node; ``feature`` and ``threshold``
    are null in leaves.
    """
    stats = F.col("nodeData.impurityStats")
    per_class = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    is_class = F.lit('"impurity":"variance"' not in _metadata(spark, path).replace(" ", ""))
    inner = F.col("nodeData.leftChild") >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner, F.col("nodeData.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("nodeData.prediction").alias("value"),
        F.when(inner, F.col("nodeData.gain")).alias("gain"),
        F.when(is_class, per_class).otherwise(stats[0]).alias("weight"),
    )


def importances(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """Rows (feature, importance) of the features that split: shares of gain times weight.

    ``per_tree`` gives every tree of a forest the same say; boosted trees count by what they gain.
    """
    by = ["tree"] if per_tree else []
    gained = nodes.filter(F.col("feature").isNotNull()).groupBy(*by, "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("own")
    )
    if not per_tree:
        return gained.select("feature", (F.col("own") / gained.agg(F.sum("own")).scalar()).alias("importance"))
    whole = gained.groupBy("tree").agg(F.sum("own").alias("of_tree"))
    shares = gained.join(whole, "tree").filter(F.col("of_tree") > 0)
    summed = shares.groupBy("feature").agg(F.sum(F.col("own") / F.col("of_tree")).alias("part"))
    total = summed.agg(F.sum("part")).scalar()
    return summed.select("feature", (F.col("part") / total).alias("importance"))


def join_forests(spark: SparkSession, paths: Sequence[str], params: dict) -> RandomForestClassificationModel:
    """One forest of all trees of the saved forests, in order."""
    first = json.loads(_metadata(spark, paths[0]))
    nodes, heads, at = [], [], 0
    for path in paths:
        shift = F.lit(at)
        nodes.append(spark.read.parquet(f"{path}/data").withColumn("treeID", F.col("treeID") + shift))
        heads.append(spark.read.parquet(f"{path}/treesMetadata").withColumn("_1", F.col("_1") + shift))
        at += json.loads(_metadata(spark, path))["numTrees"]
    out = scratch_path(spark, "forest")
    extra = {"numFeatures": first["numFeatures"], "numClasses": first["numClasses"], "numTrees": at}
    _write_metadata(
        spark, out, "RandomForestClassificationModel", RandomForestClassifier(), {**first["paramMap"], **params, "numTrees": at}, extra
    )
    _union(nodes).write.mode("overwrite").parquet(f"{out}/data")
    _union(heads).write.mode("overwrite").parquet(f"{out}/treesMetadata")
    return RandomForestClassificationModel.load(out)


def join_boosted(
    spark: SparkSession,
    folder: str,
    values: Sequence[Sequence[float]],
    places: Sequence[Sequence[int] | None],
    weight: float,
    n_features: int,
    params: dict,
) -> GBTClassificationModel:
    """One boosted model of the regression trees saved as ``folder/0``, ``folder/1``...

    A tree comes with the values of its leaves, in the order in which the tree numbers them, and
    the places its features have in the whole vector (None: the same). Every tree has the same ``weight``.
    """
    n = len(values)
    number = F.regexp_extract("_metadata.file_path", r"/(\d+)/(?:data|metadata)/[^/]*$", 1).cast("int")
    nodes = spark.read.parquet(*[f"{folder}/{i}/data" for i in range(n)]).select("*", number.alias("treeID"))
    # A model lives on the driver, and so do its nodes here. The k-th leaf by node id has value k.
    schema = T.StructType([T.StructField("treeID", T.IntegerType()), T.StructField("nodeData", nodes.drop("treeID").schema)])
    rows, seen = [], [0] * n
    for row in sorted(nodes.collect(), key=lambda r: (r.treeID, r.id)):
        node = row.asDict(recursive=True)
        i = node.pop("treeID")
        if node["leftChild"] < 0:
            node["prediction"] = float(values[i][seen[i]])
            seen[i] += 1
        elif places[i] is not None:
            node["split"]["featureIndex"] = int(places[i][node["split"]["featureIndex"]])
        rows.append((i, node))
    out = scratch_path(spark, "boosted")
    _write_metadata(spark, out, "GBTClassificationModel", GBTClassifier(), params, {"numFeatures": n_features, "numTrees": n})
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{out}/data")
    heads = spark.read.text([f"{folder}/{i}/metadata" for i in range(n)])
    heads.select(number.alias("_1"), F.col("value").alias("_2"), F.lit(float(weight)).alias("_3")).write.mode(
        "overwrite"
    ).parquet(f"{out}/treesMetadata")
    return GBTClassificationModel.load(out)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Pairwise, so that the plan of many parts is no chain."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    return parts[0]
