"""Comparison, combined metrics and group layers as jobs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from outcomelens.constants import LAYER_RAMPS, RATE_RAMP
from outcomelens.functions.colour import ramp_column, ramp_fill, ramp_fill_from
from outcomelens.operators.regions import grouped_layers
from outcomelens.plans.compare import compare_models
from outcomelens.plans.maps import combine_models, group_maps

_MODELS = "Model string, Accuracy double, Precision double, Recall double, `F1-Score` double, TN long, FP long, FN long, TP long"


def models(spark, *rows):
    return spark.createDataFrame(list(rows), _MODELS)


def test_comparison_without_areas(spark, tmp_path):
    df = models(spark, ("a", 0.9, 0.8, 0.7, 0.75, 5, 1, 1, 3), ("b", 0.6, None, 0.58, 0.59, 0, 0, 0, 0))
    reports = compare_models(df, str(tmp_path))
    assert reports["areas"].count() == 0
    assert [tuple(r) for r in reports["axes"].collect()] == [("metrics", 0.55)]
    assert reports["summary"].columns == ["Model", "Accuracy", "Precision", "Recall", "F1-Score", "TN", "FP", "FN", "TP"]
    shares = {r.Model: (r.TN, r.TP) for r in reports["shares"].collect()}
    assert shares == {"a": (0.5, 0.3), "b": (None, None)}
    written = spark.read.option("header", True).csv(f"{tmp_path}/metrics")
    assert [r.Model for r in written.collect()] == ["a"] * 4 + ["b"] * 4


def test_comparison_axes(spark):
    high = models(spark, ("a", 0.9, 0.8, 0.85, 0.82, 5, 1, 1, 3)).withColumn("ROC-AUC", F.lit(0.9))
    axes = {r.axis: r.axis_floor for r in compare_models(high)["axes"].collect()}
    assert axes == {"metrics": pytest.approx(0.77), "areas": pytest.approx(0.82)}
    none = high.withColumn("ROC-AUC", F.lit(None).cast("double"))
    reports = compare_models(none)
    assert [r.axis for r in reports["axes"].collect()] == ["metrics"] and reports["areas"].isEmpty()
    empty = compare_models(models(spark).withColumn("ROC-AUC", F.lit(None).cast("double")))
    assert empty["metrics"].count() == 0 and empty["summary"].count() == 0


@pytest.mark.parametrize("stops", [RATE_RAMP, LAYER_RAMPS["FP_rate"], ((0, 0, 255), (255, 0, 0))])
def test_ramp_from_a_column_is_the_ramp(spark, stops):
    low, high = F.lit(0.13), F.lit(0.871)
    value = F.col("id") / F.lit(499.0)
    df = spark.range(500).select(
        value.alias("v"), ramp_fill(value, low, high, stops).alias("a"),
        ramp_fill_from(value, low, high, ramp_column(stops)).alias("b"),
    )
    assert df.filter("a <> b or a is null or b is null").count() == 0
    same = spark.range(1).select(ramp_fill_from(F.lit(0.5), F.lit(0.5), F.lit(0.5), ramp_column(stops)).alias("a"))
    assert same.first().a == "#%02x%02x%02xff" % stops[0]
    missing = spark.range(1).select(ramp_fill_from(F.lit(None).cast("double"), low, high, ramp_column(stops)).alias("a"))
    assert missing.first().a is None


def shapes(spark, *keys, name="DIST_NUM"):
    rows = [({name: k, "label": f"s{i}"},) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "properties map<string,string>")


def test_layers_of_odd_keys_and_values(spark):
    features = spark.createDataFrame(
        [("1",), (" 2 ",), ("3.0",), ("x",), ("",), (None,), ("9",), ("1",)], "region string"
    )
    a = spark.createDataFrame(
        [(1, 0.1, 0.5), (2, 0.4, None), (3, 0.2, 0.5), (None, 9.0, 9.0), (7, 9.0, 9.0)], "k int, FP_rate double, AUC double"
    )
    b = spark.createDataFrame([("1", 0.3)], "k string, FP_rate double")
    got = grouped_layers(features, {"a": a, "b": b}, "region", "k", ["FP_rate", "AUC"])
    rows = {(r.ModelType, r.metric, r.region.strip()): r for r in got.collect()}
    assert got.count() == 4 + 3 + 2  # the repeated shape is in each of its layers
    assert set(rows) == {
        ("a", "FP_rate", "1"), ("a", "FP_rate", "2"), ("a", "FP_rate", "3.0"),
        ("a", "AUC", "1"), ("a", "AUC", "3.0"), ("b", "FP_rate", "1"),
    }
    # Groups without a shape do not stretch the scale.
    assert (rows["a", "FP_rate", "1"].vmin, rows["a", "FP_rate", "1"].vmax) == (0.1, 0.4)
    assert rows["a", "FP_rate", "1"].fill == "#fcfbfdff" and rows["a", "FP_rate", "2"].fill == "#3f007dff"
    assert rows["a", "AUC", "1"].fill == "#440154ff" == rows["a", "AUC", "3.0"].fill
    with pytest.raises(ValueError):
        grouped_layers(features, {"b": b}, "region", "k", ["AUC"])
    assert grouped_layers(features.limit(0), {"a": a}, "region", "k", ["AUC"]).count() == 0


def test_group_maps_take_the_keys_there_are(spark, tmp_path):
    district = spark.createDataFrame([(1, 0.1, 0.5), (2, 0.4, 0.7)], "District int, FN_rate double, AUC double")
    area = district.withColumnRenamed("District", "Community Area")
    given = {"District": shapes(spark, "1", "2", "3"), "Community Area": shapes(spark, "2", name="area_numbe")}
    layers = group_maps(given, {"District": {"rf": district}, "Community Area": {"rf": area, "xgb": area}}, str(tmp_path))
    assert set(layers) == {"District", "Community Area"}
    assert {(r.metric, r.region) for r in layers["District"].collect()} == {
        ("FN_rate", "1"), ("FN_rate", "2"), ("AUC", "1"), ("AUC", "2"),
    }
    # The area layers show no AUC.
    assert {(r.ModelType, r.metric) for r in layers["Community Area"].collect()} == {("rf", "FN_rate"), ("xgb", "FN_rate")}
    assert spark.read.parquet(f"{tmp_path}/layers_by_community_area").count() == 2
    assert set(group_maps({"District": given["District"]}, {"District": {"rf": district}})) == {"District"}
    assert group_maps({}, {"District": {"rf": district}}) == {}


def test_combined_file_is_in_order(spark, tmp_path):
    a = spark.createDataFrame([(2, 0.1), (1, 0.5), (None, 0.2)], "area int, fpr double")
    combine_models({"b": a, "a": a}, str(tmp_path))
    rows = spark.read.option("header", True).csv(f"{tmp_path}/combined_by_community_metrics").collect()
    assert [(r.ModelType, r.community_area) for r in rows] == [
        ("a", None), ("a", "1"), ("a", "2"), ("b", None), ("b", "1"), ("b", "2"),
    ]


def test_a_ramp_from_a_column_is_computed_once_a_row(spark):
    """The parts of the colour are named many times in its formula; each repetition would be worked out anew."""
    df = spark.createDataFrame([(0.3, [[0.0, 0.0, 1.0], [1.0, 0.0, 0.0]])], "v double, ramp array<array<double>>")
    out = df.select(ramp_fill_from(F.col("v"), F.lit(0.0), F.lit(1.0), F.col("ramp")).alias("fill"))
    text = out._jdf.queryExecution().analyzed().toString().splitlines()[0]
    assert text.startswith("Project") and text.count("ramp#") == 1
    assert out.first().fill == "#4c00b3ff"


def test_layers_of_many_shapes_are_spread_over_tasks(spark):
    """The scales are a row per layer: if these rows are streamed, one task makes all rows of the layers."""
    features = spark.range(4_000).select(F.col("id").cast("string").alias("region")).repartition(8)
    table = spark.range(0, 4_000, 1, 8).select(
        F.col("id").alias("k"), (F.col("id") / 4_000).alias("FP_rate"), (F.col("id") % 7 / 7).alias("FN_rate")
    )
    got = grouped_layers(features, {"a": table, "b": table}, "region", "k", ["FP_rate", "FN_rate"])
    counts = got.groupBy(F.spark_partition_id()).agg(F.count("region").alias("n"), F.max("fill"), F.max("value"))
    per_task = [r.n for r in counts.collect()]
    assert sum(per_task) == 16_000 and max(per_task) < 8_000
    ends = got.filter("metric = 'FP_rate' AND region IN ('0', '3999')").select("region", "vmin", "vmax", "fill").distinct()
    assert {tuple(r) for r in ends.collect()} == {
        ("0", 0.0, 3_999 / 4_000, "#fcfbfdff"), ("3999", 0.0, 3_999 / 4_000, "#3f007dff"),
    }
