from __future__ import annotations

import pytest

from outcomelens.constants import METRIC_ALIASES, RAW_COLUMNS
from outcomelens.operators import cleaning as K
from outcomelens.operators import columns as O
from outcomelens.operators import regions as G


def test_normalize_name():
    names = ["Primary Type", " COMMUNITY AREA ", "FP-rate", "﻿Model", "__a--b__", "F1-Score"]
    assert [O.normalize_name(n) for n in names] == [
        "primary_type", "community_area", "fp_rate", "model", "a_b", "f1_score",
    ]


def test_normalize_names_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    with pytest.raises(ValueError, match="a_b"):
        O.normalize_names(df)


def test_select_wanted(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" ID", "Primary Type", "other"])
    assert O.select_wanted(df, RAW_COLUMNS).columns == [" ID", "Primary Type"]
    assert O.select_wanted(df, ["x"]).columns == df.columns
    assert O.select_wanted(df, ["primary_type"], rename=True, normalize=True).columns == ["primary_type"]
    with pytest.raises(ValueError, match="expected"):
        O.select_wanted(df, ["x"], on_none="error")


def test_aliases(spark):
    df = spark.createDataFrame([("7", "0.5", "bad")], ["area_num", "fpr", "n"])
    kinds = dict.fromkeys(METRIC_ALIASES, "double") | {"community_area": "int"}
    kept = O.select_aliased(df, METRIC_ALIASES, kinds, ["community_area"], absent="drop")
    assert kept.columns == ["community_area", "fp_rate", "n_obs"]
    assert kept.first() == (7, 0.5, None)
    filled = O.select_aliased(df, METRIC_ALIASES, kinds, ["community_area"])
    assert filled.columns == list(METRIC_ALIASES)
    assert filled.first().fn_rate is None
    with pytest.raises(ValueError):
        O.select_aliased(df.drop("area_num"), METRIC_ALIASES, kinds, ["community_area"])


def test_missing_level_on_numbers(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "k int, s string")
    assert {tuple(r) for r in K.fill_missing_levels(df, ["k", "s"]).collect()} == {
        ("1", "a"), ("__NA__", "__NA__"),
    }


def test_has_key(spark):
    df = spark.createDataFrame([(None, 1), (None, None)], "a int, b int")
    assert K.has_key(df, "b") and not K.has_key(df, "a")
    assert not K.has_key(df.filter("b > 5"), "b")


def test_range_filter_drops_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,)], "x double")
    assert [r.x for r in K.keep_in_range(df, {"x": (0, 5)}).collect()] == [1.0]


def test_region_key_by_name_then_by_range(spark):
    named = spark.createDataFrame([(1, 2)], ["area_num", "area_numbe"])
    assert G.discover_column_key(named) == "area_numbe"
    ranged = spark.createDataFrame([("x", 99, 5), ("y", 3, 77), ("z", 4, None)], "area_t string, area_a int, area_b int")
    assert G.discover_column_key(ranged) == "area_b"
    with pytest.raises(ValueError):
        G.discover_column_key(ranged.drop("area_b"))


def test_property_key_may_start_in_a_later_feature(spark):
    df = spark.createDataFrame([({"x": "1"},), ({"area_num": "3"},)], "properties map<string,string>")
    assert G.discover_property_key(df) == "area_num"
    with pytest.raises(ValueError):
        G.discover_property_key(df.limit(1))


def test_row_operators_accept_streams(spark, tmp_path):
    """Cleaning and calendar steps are stateless, so a stream of files takes them too."""
    from outcomelens.operators.features import add_calendar

    spark.createDataFrame([("1", "yes", "2024-01-06 05:00:00")], "id string, arrest string, date string").write.json(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("id string, arrest string, date string").json(str(tmp_path / "in"))
    df = add_calendar(K.keep_dated(K.keep_labelled(stream, "arrest"), "date"), "ts")
    assert df.isStreaming
    run = df.writeStream.format("memory").queryName("rows").option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.sql("select label, Hour, IsWeekend from rows").first() == (1, 5, 1)
