"""Train, score and report the logistic model."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.constants import LINEAR_CATEGORICAL, LINEAR_NUMERIC, MISSING_LEVEL
from outcomelens.functions.parsing import to_whole
from outcomelens.operators import metrics as M
from outcomelens.operators.cleaning import has_key
from outcomelens.operators.models import (
    filled_columns,
    fit,
    logistic_pipeline,
    numeric_coefficients,
    score_table,
    strongest,
)
from outcomelens.operators.sampling import split_by_hash, thin_negatives
from outcomelens.plans.prepare import prepare_linear
from outcomelens.session import materialise
from outcomelens.sources.writers import save_model, write_csv, write_json_row, write_ordered_csv

AREA = "community_area"

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("pr_auc", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("tp", T.LongType()),
        T.StructField("tn", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("fn", T.LongType()),
        T.StructField("input_path", T.StringType()),
        T.StructField("output_dir", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("runtime_min", T.DoubleType()),
    ]
)


@dataclass
class LinearRun:
    model: PipelineModel
    scored: DataFrame
    coefficients: DataFrame
    summary: dict[str, object]


def area_key(scored: DataFrame) -> DataFrame:
    """Scored rows with the area as a number again; the missing level becomes null."""
    area = to_whole(F.when(F.col(AREA) != MISSING_LEVEL, F.col(AREA)))
    return scored.withColumn(AREA, area)


def run_linear(
    spark: SparkSession,
    in_path: str,
    out_dir: str,
    ids: Sequence[str] = ("id",),
    num_features: int = 1 << 18,
    neg_downsample: float = 1.0,
    max_iter: int = 50,
    reg_param: float = 0.1,
    elastic_net: float = 0.0,
    test_fraction: float = 0.2,
) -> LinearRun:
    """The whole job: read, prepare, split, fit, score, report, save.

    The prepared table is written once, since imputation, training and scoring each
    pass over it; the scored table is written below ``out_dir`` and every report
    reads it from there with only its own columns.
    """
    started = time.time()
    base = out_dir.rstrip("/")
    table = prepare_linear(spark.read.parquet(in_path), ids)
    if neg_downsample < 1.0:
        table = thin_negatives(table, "label", ids, neg_downsample)
    table = materialise(table, "prepared")
    train, test = split_by_hash(table, ids, test_fraction)

    categorical = [c for c in LINEAR_CATEGORICAL if c in table.columns]
    numeric = filled_columns(train, LINEAR_NUMERIC)
    pipeline = logistic_pipeline(
        categorical, numeric, num_features, max_iter, reg_param, elastic_net
    )
    model = fit(pipeline, train)

    kept = [c for c in ("primary_type", "fbi_code", "iucr", "block", AREA) if c in table.columns]
    scored = score_table(model, test, ["label", *kept])
    if AREA in kept:
        scored = area_key(scored)
    scored = materialise(scored, "scored", f"{base}/scored")

    if AREA in kept and has_key(scored, AREA):
        reports = f"{base}/by_community"
        write_ordered_csv(M.group_metrics(scored, [AREA]), f"{reports}/metrics_csv", [F.asc(AREA)])
        write_ordered_csv(M.accuracy_by_group(scored, [AREA]), f"{reports}/accuracy_csv", [F.asc(AREA)])
    points = M.curve_points(scored)
    write_csv(M.roc_curve(points), f"{base}/curves/roc", True, ["fpr", "tpr"])
    write_csv(M.pr_curve(points), f"{base}/curves/pr", True, ["recall", F.desc("precision")])
    coefficients = numeric_coefficients(spark, model, numeric)
    for side, positive in (("top_positive", True), ("top_negative", False)):
        best = strongest(coefficients, 10, positive)
        write_csv(best, f"{base}/coefficients/{side}", True, [F.desc("coef") if positive else F.asc("coef"), "feature"])
    save_model(model, f"{base}/model_fast")

    summary = {
        **M.run_metrics(scored).first().asDict(),
        "input_path": in_path,
        "output_dir": out_dir,
        "timestamp": time.strftime("%Y-%m-%d %H:%M:%S"),
        "runtime_min": (time.time() - started) / 60.0,
    }
    write_json_row(spark, summary, SUMMARY_SCHEMA, f"{base}/metrics")
    return LinearRun(model, scored, coefficients, summary)
