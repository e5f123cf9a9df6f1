"""Train, score and analyse a tree model."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from outcomelens.constants import TREE_CATEGORICAL, TREE_NUMERIC
from outcomelens.operators import errors as E
from outcomelens.operators import metrics as M
from outcomelens.operators.cleaning import fill_missing_levels
from outcomelens.operators.columns import quoted
from outcomelens.operators.models import (
    boosted_pipeline,
    feature_count,
    filled_columns,
    fit,
    forest_pipeline,
    mixed_stages,
    score_table,
)
from outcomelens.operators.sampling import add_class_weights, stratified_split
from outcomelens.session import materialise
from outcomelens.sources.writers import write_csv, write_ordered_csv

# Error reports per category with their length, and per number with bins.
CATEGORY_REPORTS = (("Primary Type", 15), ("Beat", 20), ("Season", 10), ("Domestic", 5))
BIN_REPORTS = (("Year", 10),)
RAW_BIN_REPORTS = ("Hour",)
MODEL_NAMES = {"forest": "RandomForest", "boosted": "GradientBoostedTrees"}


@dataclass
class TreeRun:
    model: PipelineModel
    scored: DataFrame
    reports: dict[str, DataFrame]
    benchmark: DataFrame


def tree_table(prepared: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Prepared rows with label and clean features; the present feature columns."""
    categorical = [c for c in TREE_CATEGORICAL if c in prepared.columns]
    numeric = [c for c in TREE_NUMERIC if c in prepared.columns]
    df = prepared.select(
        *[quoted(c) for c in ids],
        quoted("Arrest").cast("double").alias("label"),
        *[quoted(c) for c in categorical],
        *[quoted(c).cast("double").alias(c) for c in numeric],
    )
    return fill_missing_levels(df, categorical), categorical, numeric


def error_reports(scored: DataFrame) -> dict[str, DataFrame]:
    """Error sizes, and error shares per category and bin where the column exists."""
    reports = {
        "classification": M.classification_report(scored),
        "confusion": M.confusion_counts(scored),
        "error_sizes": E.error_set_sizes(scored),
    }
    for column, top in CATEGORY_REPORTS:
        if column in scored.columns:
            rates = E.error_rates_by(scored, [column])
            reports[f"top_fn_by_{column}"] = E.top_errors(rates, "FN_rate", column, top)
            reports[f"top_fp_by_{column}"] = E.top_errors(rates, "FP_rate", column, top)
    for column in RAW_BIN_REPORTS:
        if column in scored.columns:
            reports[f"errors_by_{column}"] = E.error_rates_by(scored, [column]).orderBy(column)
    for column, bins in BIN_REPORTS:
        if column in scored.columns:
            reports[f"errors_by_{column}"] = E.error_rates_by_bin(scored, column, bins).orderBy("bin")
    return reports


def run_trees(
    spark: SparkSession,
    prepared: DataFrame,
    out_dir: str,
    kind: str = "forest",
    ids: Sequence[str] = ("id",),
    test_fraction: float = 0.2,
    hashed: Sequence[str] = (),
    num_features: int = 1 << 12,
    metric_keys: Sequence[str] = ("Community Area", "District"),
    **params: object,
) -> TreeRun:
    """Split, weigh, fit, score, analyse and save.

    Every category is one-hot encoded but those named in ``hashed``, which share ``num_features``
    hashed slots. The choice is the caller's and does not depend on the data: one-hot levels are held
    on the driver and a tree learner holds statistics for every slot, so columns of unbounded levels
    belong in ``hashed``. Error details stay in many files; only report tables are single.
    """
    if kind not in MODEL_NAMES:
        raise ValueError(f"unknown model kind: {kind}")
    base = out_dir.rstrip("/")
    started = time.perf_counter()
    table, categorical, numeric = tree_table(prepared, ids)
    table = materialise(table, "features")
    train, test = stratified_split(table, "label", ids, test_fraction)
    many = [c for c in categorical if c in hashed]
    few = [c for c in categorical if c not in hashed]
    numeric = filled_columns(train, numeric)
    stages = mixed_stages(few, many, numeric, num_features, impute=True)
    if kind == "forest":
        pipeline = forest_pipeline(stages, **params)
        weighed = add_class_weights(train, "label", "balanced")
    else:
        pipeline = boosted_pipeline(stages, ids=[c for c in ids if c in train.columns], **params)
        weighed = add_class_weights(train, "label", "positive")
    prepared_in = time.perf_counter() - started
    model = fit(pipeline, weighed)

    started = time.perf_counter()
    scored = materialise(score_table(model, test), "scored", f"{base}/scored")
    scored_in = time.perf_counter() - started

    reports = error_reports(scored)
    for cell, name in (("FP", "false_positives"), ("FN", "false_negatives")):
        write_csv(E.error_set(scored, cell), f"{base}/{name}_details")
    for key in metric_keys:
        if key in scored.columns:
            name = f"metrics_by_{key.lower().replace(' ', '_')}"
            reports[name] = M.group_metrics(scored, [key])
            write_ordered_csv(reports[name], f"{base}/{name}", [quoted(key).asc()])
    note = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
    bench = M.benchmark_row(
        scored,
        MODEL_NAMES[kind],
        n_features=feature_count(model),
        note=note,
        t_pre=prepared_in,
        t_pred=scored_in,
    )
    write_csv(bench, f"{base}/benchmark_summary", True)
    return TreeRun(model, scored, reports, bench)
