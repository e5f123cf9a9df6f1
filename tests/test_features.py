"""Feature collections cut at every possible place, ordered files, and row numbers over any key."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from outcomelens.operators import ranks
from outcomelens.sources import features, readers, writers

TRICKY = 'quotes " and \\ backslash } { ] [ "features":[ {"x":1} é日本 \n \\" end\\'


def collection(n: int) -> dict:
    found = []
    for i in range(n):
        inner = {"area_numbe": str(i), "note": TRICKY * (i % 3), "features": json.dumps([{"a": i}])}
        found.append({"type": "Feature", "properties": inner, "geometry": {"type": "P", "coordinates": [[i, [0, 1]], []]}})
    return {
        "crs": {"properties": {"name": "x"}},
        "other": [{"type": "Feature", "properties": {"area_numbe": "no"}}],
        "type": "FeatureCollection",
        "features": found,
        "after": [{"properties": {"area_numbe": "no"}}],
    }


@pytest.mark.parametrize("range_bytes", [7, 64, 1_000, 1 << 27])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_cut_anywhere_give_all_features(spark, tmp_path, range_bytes, indent):
    for k, n in enumerate((5, 1, 0)):
        (tmp_path / f"{k}.json").write_text(json.dumps(collection(n), indent=indent, ensure_ascii=k == 0), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    # At seven bytes a range holds a single value; larger ones hold several features.
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(range_bytes, 64)) if indent is None else str(range_bytes * 8))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sorted(json.dumps(json.loads(r.text), sort_keys=True) for r in features.feature_texts(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    wanted = sorted(json.dumps(f, sort_keys=True) for n in (5, 1, 0) for f in collection(n)["features"])
    assert got == wanted


def test_walker_agrees_wherever_it_begins():
    """Notes of the two beginnings, put together, lead to the state of one walk over the whole."""
    segments = json.dumps(collection(6)).split("}")[:-1]
    for size in (1, 2, 5, len(segments)):
        notes = []
        for at in range(0, len(segments), size):
            walkers = features.Walker(False), features.Walker(True)
            for walker in walkers:
                for s in segments[at : at + size]:
                    list(walker.steps(s))
            outside, inside = map(features._note, walkers)
            notes.append(type("Note", (), {"file": "f", "start": at, "outside": outside, "inside": inside}))
        random.Random(1).shuffle(notes)
        begin, whole = features.beginnings(notes), features.Walker(False)
        for at, s in enumerate(segments):
            if at % size == 0:
                in_string, depth, listed, _ = begin["f", at]
                assert (in_string, depth, listed) == (whole.in_string, whole.depth, whole.lists.get(1, False))
            list(whole.steps(s))


def test_large_collection_is_read_by_several_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("key"), F.lit('{"type":"Point","coordinates":[1,2]}').alias("geometry"))
    writers.write_feature_collections(rows, str(tmp_path / "c"), ["key"], per_file=15_000)
    found = sorted(Path(tmp_path / "c").glob("*/*.txt"))
    assert [len(json.loads(f.read_text())["features"]) for f in found] == [15_000, 5_000]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        read = readers.read_geojson(spark, str(tmp_path / "c"))
        assert read.rdd.getNumPartitions() > 8
        assert read.select(F.sum(F.col("properties")["key"].cast("long")), F.count("*")).first() == (20_000 * 19_999 // 2, 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ordered_files_follow_one_another(spark, tmp_path):
    rows = [(f"k{i * 7919 % 1000:04d}", 'a "b", c ' + str(i)) for i in range(1000)] + [(None, None)]
    df = spark.createDataFrame(rows, "key string, text string")
    for header in ("each", "first"):
        path = tmp_path / header
        writers.write_ordered_csv(df, str(path), [F.asc_nulls_last("key")], header, rows_per_file=100)
        files = sorted(path.glob("part-*"))
        assert len(files) > 2
        lines = [line for f in files for line in f.read_text().splitlines()]
        assert sum(line == "key,text" for line in lines) == (1 if header == "first" else len(files))
        assert lines[0] == "key,text"
        keys = [line.split(",")[0].strip('"') for line in lines if line != "key,text"]
        assert keys[:1000] == sorted(k for k, _ in rows[:1000]) and len(keys) == 1001
    with pytest.raises(ValueError):
        writers.write_ordered_csv(df, str(tmp_path / "x"), [F.asc("key")], "none")


def test_rows_are_numbered_over_mixed_keys(spark):
    rows = [(i % 7 if i % 5 else None, f"t{i * 31 % 97}", i) for i in range(2_000)] + [(1, "same", 0)] * 50
    df = spark.createDataFrame(rows, "a int, b string, c long")
    got = ranks.number_rows(df, [F.desc_nulls_last("a"), F.asc("b"), F.asc("c")]).collect()
    wanted = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == wanted
    assert sorted(r.place for r in got) == list(range(1, len(rows) + 1))
    assert ranks.number_rows(df.limit(0), [F.asc("a")]).count() == 0
