"""Compare models from a table with one row per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import COMPARED_METRICS
from outcomelens.operators.compare import axis_floor, confusion_shares, model_summary, present_auc, tall_metrics
from outcomelens.session import materialise
from outcomelens.sources.writers import write_csv

# How far below the lowest value an axis starts, and its least start.
METRIC_AXIS = (0.03, 0.55)
AUC_AXIS = (0.08, 0.70)


def compare_models(df: DataFrame, out_dir: str | None = None, key: str = "Model") -> dict[str, DataFrame]:
    """Metrics in long form, confusion shares, areas, the rounded summary and the axis starts.

    ``df`` may be the end of a long plan: it is stored once and every table reads the stored rows. With
    ``out_dir`` each table is also written there as a CSV report, in order of the model. A table without
    an area column has no row in ``areas`` and no axis for it.
    """
    df = materialise(df, "models")
    areas = present_auc(df, key)
    starts = [axis_floor(df, COMPARED_METRICS, *METRIC_AXIS).select(F.lit("metrics").alias("axis"), "axis_floor")]
    if "ROC-AUC" in df.columns:
        lowest = axis_floor(areas, ["ROC-AUC"], *AUC_AXIS).select(F.lit("areas").alias("axis"), "axis_floor")
        starts.append(lowest.filter(F.lit(not areas.isEmpty())))
    axes = starts[0] if len(starts) == 1 else starts[0].unionByName(starts[1])
    reports = {
        "metrics": tall_metrics(df, key),
        "shares": confusion_shares(df, key),
        "areas": areas,
        "summary": model_summary(df),
        "axes": axes,
    }
    if out_dir:
        for name, report in reports.items():
            order = [c for c in (key, "metric", "axis") if c in report.columns]
            write_csv(report, f"{out_dir.rstrip('/')}/{name}", True, order)
    return reports
