from __future__ import annotations

import pytest

from outcomelens.operators import compare as CP
from outcomelens.operators import regions as G


def test_metric_range(spark):
    schema = "m double, n_obs double"
    plain = spark.createDataFrame([(0.2, 300.0), (0.9, 100.0), (0.4, 200.0), (0.7, None)], schema)
    assert tuple(CP.metric_range(plain, "m").first()) == (0.2, 0.4)
    assert tuple(CP.metric_range(plain, "m", None).first()) == (0.2, 0.9)
    equal = spark.createDataFrame([(0.3, 300.0), (0.3, 400.0)], schema)
    low, high = CP.metric_range(equal, "m").first()
    assert low == pytest.approx(0.3 - 1e-9, abs=1e-15) and high == pytest.approx(0.3 + 1e-9, abs=1e-15)
    none = spark.createDataFrame([(0.3, 1.0)], schema)
    assert tuple(CP.metric_range(none, "m").first()) == (0.0, 1.0)
    assert tuple(CP.metric_range(none.limit(0), "m").first()) == (0.0, 1.0)


def test_stacked_tables_fill_missing_columns(spark):
    a = spark.createDataFrame([(1, 0.5)], "area int, fpr double")
    b = spark.createDataFrame([("2", 0.1)], "`Area Number` string, FNR double")
    out = CP.stack_tables([G.harmonise_metrics(a, "A"), G.harmonise_metrics(b, "B")])
    assert {tuple(r) for r in out.select("community_area", "FP_rate", "FN_rate", "ModelType").collect()} == {
        (1, 0.5, None, "A"), (2, None, 0.1, "B"),
    }


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "B", 5), (1, "A", 9), (2, "C", 1), (1, "A", 7)], "k int, m string, v int")
    out = CP.first_per_key(df, "k", ["m"])
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} == {(1, "A", 7), (2, "C", 1)}


def test_summary_rounds_half_to_even_and_keeps_present_columns(spark):
    df = spark.createDataFrame([("M", 0.0625, 3)], "Model string, Accuracy double, TN long")
    assert CP.model_summary(df).first().asDict() == {"Model": "M", "Accuracy": 0.062, "TN": 3}


def test_support_mask_null_policies(spark):
    df = spark.createDataFrame([(0.5, None), (0.5, 100), (0.5, 200)], "v double, n int")
    hide = [r[0] for r in df.select(G.supported_value(df.v, df.n)).collect()]
    show = [r[0] for r in df.select(G.supported_value(df.v, df.n, null_n="show")).collect()]
    assert hide == [None, None, 0.5] and show == [0.5, None, 0.5]


def test_layers_of_models_and_metrics(spark):
    features = spark.createDataFrame([("1",), ("2",), ("x",)], "area string")
    combined = spark.createDataFrame(
        [(1, 0.1, 0.6, 300.0, "A"), (2, 0.3, 0.2, 300.0, "A"), (1, 0.2, 0.5, 10.0, "B")],
        "community_area int, FP_rate double, FN_rate double, n_obs double, ModelType string",
    )
    out = G.metric_layers(features, combined, "area")
    assert out.count() == 3 * 4
    got = {(r.ModelType, r.metric, r.area): (r.fill, r.opacity) for r in out.collect()}
    assert got["A", "FP_rate", "1"] == ("#0000ffff", 0.8)
    assert got["A", "FP_rate", "2"] == ("#ff0000ff", 0.8)
    assert got["A", "FN_rate", "1"] == ("#ff0000ff", 0.8)
    assert got["A", "FP_rate", "x"] == ("#dddddd", 0.3)
    assert got["B", "FP_rate", "1"] == ("#dddddd", 0.3)
    with pytest.raises(ValueError):
        G.metric_layers(features, combined.drop("FP_rate", "FN_rate"), "area")


def test_axis_floor(spark):
    df = spark.createDataFrame([(0.9, 0.7), (0.8, 0.95)], "a double, b double")
    assert CP.axis_floor(df, ["a", "b"], 0.03, 0.55).first()[0] == pytest.approx(0.67)
    assert CP.axis_floor(df, ["a"], 0.5, 0.55).first()[0] == 0.55
