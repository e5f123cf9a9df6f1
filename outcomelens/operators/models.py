"""Classifiers on Spark ML.

Defaults are the reference settings for full runs; tests and small tables pass
smaller ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelens.functions.numeric import above_threshold
from outcomelens.operators.boosting import BatchedForest, NewtonBoosting
from outcomelens.operators.columns import quoted
from outcomelens.operators.encoders import LevelEncoder, LevelEncoderModel, MedianImputer
from outcomelens.operators.levels import vector_entries
from outcomelens.operators.model_tables import importances, saved, tree_nodes
from outcomelens.session import ensure_checkpoint_dir

IMPUTED = "_imp"


def hashing_stages(
    categorical: Sequence[str], numeric: Sequence[str], num_features: int = 1 << 18
) -> list:
    """Median imputation, feature hashing and assembly.

    Every categorical column is hashed as text, integer keys included.
    """
    stages, inputs = [], []
    if numeric:
        imputed = [c + IMPUTED for c in numeric]
        stages.append(MedianImputer(inputCols=list(numeric), outputCols=imputed))
        stages.append(VectorAssembler(inputCols=imputed, outputCol="num_vec", handleInvalid="skip"))
    if categorical:
        stages.append(
            FeatureHasher(
                inputCols=list(categorical),
                categoricalCols=list(categorical),
                outputCol="cat_hashed",
                numFeatures=num_features,
            )
        )
        inputs.append("cat_hashed")
    if numeric:
        inputs.append("num_vec")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip"))
    return stages


def logistic_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    num_features: int = 1 << 18,
    max_iter: int = 50,
    reg_param: float = 0.1,
    elastic_net: float = 0.0,
    aggregation_depth: int = 2,
    tol: float = 1e-6,
) -> Pipeline:
    model = LogisticRegression(
        labelCol="label",
        featuresCol="features",
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=elastic_net,
        standardization=True,
        aggregationDepth=aggregation_depth,
        tol=tol,
    )
    return Pipeline(stages=[*hashing_stages(categorical, numeric, num_features), model])


def one_hot_stages(
    categorical: Sequence[str], numeric: Sequence[str], impute: bool = False, out: str = "features"
) -> list:
    """One 0/1 slot per level seen in training, then the numeric columns as they are.

    An unseen level has no slot: its row is all zeros for that column. A row with a
    missing number is left out, unless ``impute`` gives it the column's median.
    """
    stages, numbers = [], list(numeric)
    if numeric and impute:
        numbers = [c + IMPUTED for c in numeric]
        stages.append(MedianImputer(inputCols=list(numeric), outputCols=numbers))
    if categorical:
        stages.append(LevelEncoder(inputCols=list(categorical), numericCols=numbers, outputCol=out))
    else:
        stages.append(VectorAssembler(inputCols=numbers, outputCol=out, handleInvalid="skip"))
    return stages


def mixed_stages(
    one_hot: Sequence[str],
    hashed: Sequence[str],
    numeric: Sequence[str],
    num_features: int,
    impute: bool = False,
) -> list:
    """One-hot for the columns named first, hashing for those named second."""
    if not hashed:
        return one_hot_stages(one_hot, numeric, impute)
    stages = one_hot_stages(one_hot, numeric, impute, "one_hot")
    stages.append(
        FeatureHasher(
            inputCols=list(hashed),
            categoricalCols=list(hashed),
            outputCol="cat_hashed",
            numFeatures=num_features,
        )
    )
    stages.append(VectorAssembler(inputCols=["one_hot", "cat_hashed"], outputCol="features", handleInvalid="skip"))
    return stages


def filled_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that hold any value; the others have no median to impute."""
    if not columns:
        return []
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if counts[f"c{i}"]]


def forest_pipeline(
    features: list,
    num_trees: int = 400,
    max_depth: int = 20,
    min_leaf: int = 2,
    seed: int = 42,
    weight: str | None = "weight",
    **settings: object,
) -> Pipeline:
    """Trees grown in batches; see :mod:`outcomelens.operators.boosting`."""
    grown = BatchedForest(
        num_trees=num_trees, max_depth=max_depth, min_leaf=min_leaf, seed=seed, weight=weight, **settings
    )
    return Pipeline(stages=[*features, grown])


def boosted_pipeline(
    features: list,
    rounds: int = 400,
    max_depth: int = 9,
    step: float = 0.03,
    subsample: float = 0.8,
    column_share: float = 0.8,
    seed: int = 42,
    weight: str | None = "weight",
    **settings: object,
) -> Pipeline:
    """Gradient-boosted trees with Newton leaf values; columns and rows are drawn per tree."""
    boosted = NewtonBoosting(
        rounds=rounds,
        max_depth=max_depth,
        step=step,
        subsample=subsample,
        column_share=column_share,
        seed=seed,
        weight=weight,
        **settings,
    )
    return Pipeline(stages=[*features, boosted])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    ensure_checkpoint_dir(train.sparkSession)
    return pipeline.fit(train)


def positive_score(probability: str = "probability"):
    """Probability of class 1."""
    return vector_to_array(quoted(probability))[1]


def score_table(
    model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None, threshold: float = 0.5
) -> DataFrame:
    """Label, thresholded prediction and score beside the kept columns.

    The features travel with their row, so no positions are matched afterwards.
    """
    kept = list(keep if keep is not None else df.columns)
    scored = model.transform(df).withColumn("score", positive_score())
    return scored.select(
        *[quoted(c) for c in kept],
        *([] if "label" in kept else ["label"]),
        above_threshold(F.col("score"), threshold).alias("prediction"),
        "score",
    )


def feature_names(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Rows (feature, name) of the places that have a name; hashed slots have none."""
    for stage in model.stages:
        if isinstance(stage, LevelEncoderModel):
            return stage.feature_names()
    assembled = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return spark.createDataFrame(list(enumerate(assembled.getInputCols())), "feature int, name string")


def feature_count(model: PipelineModel) -> int:
    """Number of features the classifier was trained on."""
    return int(model.stages[-1].numFeatures)


def numeric_coefficients(
    spark: SparkSession, model: PipelineModel, numeric: Sequence[str]
) -> DataFrame:
    """Coefficients of the imputed numeric features, which follow the hashed block."""
    linear = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    start = linear.numFeatures - len(numeric)
    weights = linear.coefficients.toArray()[start:]
    rows = [(c + IMPUTED, float(w)) for c, w in zip(numeric, weights)]
    return spark.createDataFrame(rows, "feature string, coef double")


def coefficient_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Rows (slot, coef) of the coefficients other than zero."""
    linear = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    weights = linear.coefficients.toArray()
    used = weights.nonzero()[0]
    return spark.createDataFrame([(int(i), float(weights[i])) for i in used], "slot int, coef double")


def penalised_gradient(
    spark: SparkSession, model: PipelineModel, scored: DataFrame, reg_param: float
) -> DataFrame:
    """Rows (slot, gradient) of the ridge-penalised mean loss, by coefficients of unit-variance features.

    ``scored`` has ``features``, ``label`` and ``score``. At the optimum every entry is zero. One pass sums over
    the entries of the sparse vectors; slot -1 is the intercept.
    """
    rows = scored.count()
    off = F.col("score") - F.col("label")
    entries = scored.select(off.alias("off"), F.explode(vector_entries(F.col("features"))).alias("e"))
    sums = entries.groupBy(F.col("e.slot").alias("slot")).agg(
        F.sum(F.col("off") * F.col("e.value")).alias("slope"),
        F.sum("e.value").alias("total"),
        F.sum(F.col("e.value") * F.col("e.value")).alias("squares"),
    )
    n = F.lit(float(rows))
    deviation = F.sqrt((F.col("squares") - F.col("total") * F.col("total") / n) / (n - 1))
    coef = F.coalesce("coef", F.lit(0.0))
    slots = (
        sums.join(coefficient_table(spark, model), "slot", "left")
        .withColumn("deviation", deviation)
        .filter(F.col("deviation") > 0)
        .select("slot", (F.col("slope") / n / F.col("deviation") + F.lit(reg_param) * coef * F.col("deviation")).alias("gradient"))
    )
    return slots.unionByName(scored.agg(F.avg(off).alias("gradient")).select(F.lit(-1).alias("slot"), "gradient"))


def strongest(coefficients: DataFrame, n: int = 10, positive: bool = True) -> DataFrame:
    """Top (or bottom) coefficients, ties by name."""
    order = F.desc("coef") if positive else F.asc("coef")
    return coefficients.orderBy(order, "feature").limit(n)


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance per feature of a tree ensemble, from its table of nodes; only features that were used."""
    trees = model.stages[-1]
    weights = importances(tree_nodes(spark, saved(trees)), not isinstance(trees, GBTClassificationModel))
    named = weights.join(feature_names(spark, model), "feature", "left")
    return named.select(F.coalesce("name", F.concat(F.lit("f"), F.col("feature"))).alias("feature"), "importance")
