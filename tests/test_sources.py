from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import types as T

from outcomelens.operators import compare as CP
from outcomelens.operators import regions as G
from outcomelens.operators.columns import normalize_names
from outcomelens.plans.convert import convert_csv
from outcomelens.sources import readers as RD
from outcomelens.sources import writers as WR

OUTPUTS = "﻿Model,Accuracy,TN,FP,FN,TP,Runtime,ROC-AUC\r\r\nP,0.8,5,1,2,2,,0.9\r\r\nQ,0.6,0,0,0,0,,"
OUTPUT_SCHEMA = (
    "Model string, Accuracy double, TN long, FP long, FN long, TP long, Runtime string, `ROC-AUC` double"
)


def test_model_outputs_file_with_mark_and_odd_line_ends(spark, tmp_path):
    (tmp_path / "o.csv").write_text(OUTPUTS, encoding="utf-8", newline="")
    df = RD.read_csv_typed(spark, str(tmp_path / "o.csv"), OUTPUT_SCHEMA).filter("Model is not null")
    rows = {r.Model: r for r in df.collect()}
    assert set(rows) == {"P", "Q"}
    assert rows["P"]["ROC-AUC"] == 0.9 and rows["Q"]["ROC-AUC"] is None
    assert rows["P"].Runtime is None
    shares = {r.Model: r for r in CP.confusion_shares(df).collect()}
    assert shares["P"].TN == 0.5 and shares["Q"].TN is None
    assert [r.Model for r in CP.present_auc(df).collect()] == ["P"]
    assert CP.present_auc(df.drop("ROC-AUC")).isEmpty()


def test_conversion_keeps_wanted_columns_and_counts(spark, tmp_path):
    text = 'ID,Primary Type,Extra\n1,"A, B",x\n2,,y\n3,C,z\n'
    (tmp_path / "raw.csv").write_text(text)
    n = convert_csv(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"))
    assert n == 3
    df = spark.read.parquet(str(tmp_path / "out"))
    assert df.columns == ["ID", "Primary Type"]
    assert set(df.dtypes) == {("ID", "string"), ("Primary Type", "string")}
    assert {tuple(r) for r in df.collect()} == {("1", "A, B"), ("2", None), ("3", "C")}


def test_csv_round_trip_keeps_outer_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" t ", 1), (None, 2)], "s string, n int")
    WR.write_csv(df, str(tmp_path / "c"))
    back = RD.read_raw_csv(spark, str(tmp_path / "c"))
    assert {tuple(r) for r in back.collect()} == {(" t ", "1"), (None, "2")}


def test_report_is_one_sorted_file(spark, tmp_path):
    df = spark.range(50).repartition(7).selectExpr("id", "id * 2 as v")
    WR.write_csv(df, str(tmp_path / "r"), single_file=True, order_by=["id"])
    files = list(Path(tmp_path / "r").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["id,v"] + [f"{i},{2 * i}" for i in range(50)]


DOCUMENT = {
    "type": "FeatureCollection",
    "features": [
        {"properties": {"area_numbe": "1", "community": "One"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"properties": {"area_numbe": "x", "community": "Two"}, "geometry": None},
        {"properties": {"area_numbe": " ", "community": "Three"}, "geometry": None},
        {"properties": {"area_numbe": "9", "community": "Four"}, "geometry": None},
    ],
}


def test_geojson_document_enriched_and_written_as_lines(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps(DOCUMENT, indent=1))
    raw = RD.read_geojson(spark, str(tmp_path / "g.json"))
    assert raw.count() == 4
    key = G.discover_property_key(raw)
    named = G.feature_columns(raw, {"area": key, "community": "community"})
    metrics = spark.createDataFrame([(1, 0.75, 500), (2, 0.5, 10)], "region int, accuracy double, n long")
    out = {r.community: r for r in G.enrich_features(named, metrics, "area", "region").collect()}
    assert out["One"].acc_plot == 0.75 and out["One"].n == 500 and out["One"].opacity == 0.75
    for name in ("Two", "Three", "Four"):
        assert (out[name].accuracy, out[name].n, out[name].fill, out[name].opacity) == (None, 0, "#dddddd", 0.3)

    enriched = G.enrich_features(named, metrics, "area", "region", min_support=501)
    WR.write_feature_lines(enriched, str(tmp_path / "lines"), ["area", "community", "accuracy", "acc_plot"])
    lines = [json.loads(x) for p in Path(tmp_path / "lines").glob("*.txt") for x in p.read_text().splitlines()]
    first = next(x for x in lines if x["properties"]["community"] == "One")
    assert first["geometry"] == {"type": "Point", "coordinates": [1, 2]}
    assert first["properties"]["accuracy"] == 0.75 and first["properties"]["acc_plot"] is None
    assert RD.read_geojson(spark, str(tmp_path / "lines"), "lines").count() == 4
    with pytest.raises(ValueError):
        RD.read_geojson(spark, str(tmp_path / "g.json"), "other")


def test_summary_row_has_its_schema(spark, tmp_path):
    schema = T.StructType([T.StructField("tp", T.LongType()), T.StructField("note", T.StringType())])
    WR.write_json_row(spark, {"tp": 3, "ignored": 1}, schema, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).collect() == [(3,)]


def test_partitioned_layers(spark, tmp_path):
    df = spark.createDataFrame([("A", "FP_rate", 1), ("B", "FN_rate", 2)], "ModelType string, metric string, v int")
    assert WR.write_parquet(df, str(tmp_path / "p"), ["ModelType", "metric"]) == 2
    assert (tmp_path / "p" / "ModelType=A" / "metric=FP_rate").is_dir()


def test_normalised_names_of_marked_header(spark, tmp_path):
    (tmp_path / "o.csv").write_text("﻿Model,FP-rate\r\nP,1\r\n", encoding="utf-8", newline="")
    df = normalize_names(RD.read_raw_csv(spark, str(tmp_path / "o.csv")))
    assert df.columns == ["model", "fp_rate"]


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿Model,TP,"TN"\r\nA,1,9\r\n"b ""c"", d",2,\r\n')
    got = RD.read_csv_typed(spark, str(tmp_path / "r.csv"), "TN int, Model string")
    assert [tuple(r) for r in got.collect()] == [(9, "A"), (None, 'b "c", d')]
    raw = T.StructType([T.StructField(c, T.StringType()) for c in ("TP", "Model")])
    assert RD.read_raw_csv(spark, str(tmp_path / "r.csv"), raw).columns == ["TP", "Model"]
    with pytest.raises(ValueError, match="absent"):
        RD.read_csv_typed(spark, str(tmp_path / "r.csv"), "Model string, FP int")
