from __future__ import annotations

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from outcomelens.catalog.tables import raw_text, regions
from outcomelens.constants import GROUP_METRIC_COLUMNS, PREPARED_COLUMNS
from outcomelens.operators.columns import normalize_names
from outcomelens.plans.explore import exploratory_reports
from outcomelens.plans.linear import SUMMARY_SCHEMA, run_linear
from outcomelens.plans.maps import map_layers
from outcomelens.plans.prepare import prepare_linear, prepare_table
from outcomelens.plans.trees import run_trees


@pytest.fixture(scope="module")
def raw(spark, sf):
    return raw_text(spark, sf)


@pytest.fixture(scope="module")
def prepared(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("prepared") / "p")
    prepare_table(raw).write.parquet(path)
    return spark.read.parquet(path)


def csv(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def test_prepared_table(raw, prepared):
    assert prepared.columns == [*PREPARED_COLUMNS, "id"]
    assert prepared.filter("Arrest is null or Year is null").isEmpty()
    assert prepared.filter("Block is null and BlockFreq is not null").isEmpty()
    total = prepared.filter("Block is not null").count()
    per_block = prepared.filter("Block is not null").groupBy("Block").agg(F.max("BlockFreq").alias("n"))
    assert per_block.agg(F.sum("n")).first()[0] == total
    n = prepared.count()
    assert abs(prepare_table(raw, sample_size=n // 3).count() - n // 3) <= 1
    sampled = prepare_table(raw, sample_size=n // 3).groupBy("Block").agg(F.max("BlockFreq").alias("f"))
    full = {r.Block: r.n for r in per_block.collect()}
    assert all(full[r.Block] == r.f for r in sampled.collect() if r.Block)


def test_linear_table_without_optional_columns(raw):
    df = prepare_linear(raw.select("Date", "Arrest", "ID"), ids=["id"])
    assert df.columns == ["id", "label", "DomesticNum", "Year", "Month", "DayOfWeek", "Hour", "IsWeekend"]
    assert df.filter("DomesticNum is not null").isEmpty()
    with pytest.raises(ValueError):
        prepare_linear(raw.select("Extra"))


def test_linear_run(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    normalize_names(raw).write.parquet(source)
    run = run_linear(spark, source, out, num_features=1 << 10, max_iter=5)
    metrics = csv(spark, f"{out}/by_community/metrics_csv")
    assert metrics.columns == ["community_area", *GROUP_METRIC_COLUMNS]
    n = run.scored.count()
    assert metrics.agg(F.sum("n_obs")).first()[0] == n
    accuracy = csv(spark, f"{out}/by_community/accuracy_csv")
    assert accuracy.agg(F.sum("n")).first()[0] == n
    roc = [tuple(r) for r in csv(spark, f"{out}/curves/roc").collect()]
    assert roc == sorted(roc) and roc[-1] == (1.0, 1.0)
    pr = csv(spark, f"{out}/curves/pr")
    assert pr.columns == ["recall", "precision"]
    summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{out}/metrics").first()
    assert summary.tp + summary.tn + summary.fp + summary.fn == n
    assert summary.roc_auc == run.summary["roc_auc"] and summary.input_path == source
    assert run.coefficients.count() == 6
    assert Path(f"{out}/model_fast").is_dir()
    thinned = run_linear(spark, source, f"{out}2", num_features=1 << 8, max_iter=2, neg_downsample=0.2)
    assert thinned.scored.filter("label = 1").count() == run.scored.filter("label = 1").count()
    # Thinning and splitting choose independently: the test set is thinned too.
    assert thinned.scored.filter("label = 0").count() < 0.5 * run.scored.filter("label = 0").count()


def test_linear_run_without_areas_or_flags(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw.select("ID", "Date", "Arrest", "Primary Type").write.parquet(source)
    run = run_linear(spark, source, out, num_features=1 << 8, max_iter=2)
    assert not Path(f"{out}/by_community").exists()
    assert "DomesticNum_imp" not in {r.feature for r in run.coefficients.collect()}
    assert run.summary["tp"] + run.summary["tn"] + run.summary["fp"] + run.summary["fn"] == run.scored.count()


@pytest.mark.parametrize(
    "kind,params", [("forest", {"num_trees": 5, "max_depth": 4}), ("boosted", {"rounds": 3, "max_depth": 3})]
)
def test_tree_run(spark, prepared, tmp_path, kind, params):
    out = str(tmp_path / "out")
    run = run_trees(spark, prepared, out, kind, hashed=["Block"], num_features=1 << 8, **params)
    n = run.scored.count()
    assert n == math.ceil(0.2 * prepared.count())  # rows with missing numbers are kept
    sizes = {r.outcome: r.n for r in run.reports["error_sizes"].collect()}
    assert sum(sizes.values()) == n
    assert csv(spark, f"{out}/false_positives_details").count() == sizes.get("FP", 0)
    assert csv(spark, f"{out}/false_negatives_details").count() == sizes.get("FN", 0)
    assert run.reports["top_fn_by_Beat"].count() <= 20
    assert run.reports["errors_by_Hour"].agg(F.sum("total")).first()[0] == n
    by_district = csv(spark, f"{out}/metrics_by_district")
    assert by_district.columns == ["District", *GROUP_METRIC_COLUMNS]
    assert by_district.agg(F.sum("n_obs")).first()[0] == n
    bench = csv(spark, f"{out}/benchmark_summary").first()
    assert bench.n_features > 0 and bench.t_pred > 0 and bench.note
    with pytest.raises(ValueError):
        run_trees(spark, prepared, out, "other")


def test_exploratory_reports(prepared):
    reports = exploratory_reports(prepared)
    assert len(reports) == 13
    for name, report in reports.items():
        assert report.count() > 0 or name == "busiest_blocks", name
    hours = reports["rate_by_hour"].collect()
    assert [r.Hour for r in hours] == sorted(r.Hour for r in hours)
    rates = [r.rate_pct for r in reports["rate_by_beat"].collect()]
    assert rates == sorted(rates, reverse=True)
    few = exploratory_reports(prepared.select("Arrest", "Season", "BlockFreq"))
    assert set(few) == {"rate_by_season", "rate_by_block_frequency"}
    # From the stored frequency or from the blocks: the same bins.
    blocks = reports["rate_by_block_frequency"].select("bin", "n").collect()
    assert few["rate_by_block_frequency"].select("bin", "n").collect() == blocks


def test_map_layers(spark, sf):
    features = regions(spark, sf)
    a = spark.createDataFrame(
        [(i, 0.1 * i, 0.5, 300, 0.2 + i / 100) for i in range(6)],
        "area int, fpr double, fnr double, n int, arrest_rate double",
    )
    b = a.select(F.col("area").alias("Community Area"), "fpr", F.col("n").alias("n_obs"))
    layers = map_layers(features, {"A": a, "B": b})
    assert layers["errors"].count() == 4 * features.count()
    assert layers["observed"].count() == features.count()
    assert "observed" not in map_layers(features, {"B": b})
