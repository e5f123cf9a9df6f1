"""Whole jobs: each runs with its files written, and its result is read back from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.compare_queries import _K, _O, combined_tables, model_outputs
from outcomelens.catalog.row_queries import ramp_sql
from outcomelens.catalog.sample_queries import hash_sql
from outcomelens.catalog.tables import (
    RAW,
    REGIONS,
    THREE,
    raw_text,
    regions,
    rounded,
    table,
    three_scores,
    with_views,
    yearly,
)
from outcomelens.constants import COMPARED_METRICS, CONFUSION_CELLS, GROUP_LAYERS, LAYER_RAMPS, SUMMARY_COLUMNS
from outcomelens.functions.hashing import HASH_SIZE
from outcomelens.operators import metrics as M
from outcomelens.operators.columns import normalize_names, quoted
from outcomelens.operators.errors import error_rates_by
from outcomelens.plans.compare import AUC_AXIS, METRIC_AXIS, compare_models
from outcomelens.plans.explore import exploratory_reports
from outcomelens.plans.linear import run_linear
from outcomelens.plans.maps import combine_models, group_maps
from outcomelens.plans.prepare import prepare_table
from outcomelens.plans.trees import run_trees
from outcomelens.session import materialise, scratch_path
from outcomelens.sources.readers import read_csv_typed

# Comparison ---------------------------------------------------------------------

_CELLS = SUMMARY_COLUMNS[1:]


def _tall_sql(report: str, columns, value: str, where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS report, "Model", '{c}' AS name, {value.format(c=f'"{c}"')} AS value FROM o{where}"""
        for c in columns
    )


@query(
    "ev13_comparison_job",
    _O
    + " UNION ALL ".join(
        [
            _tall_sql("metrics", COMPARED_METRICS, "round({c}, 6)::double"),
            _tall_sql("shares", CONFUSION_CELLS, 'round({c} / ("TN" + "FP" + "FN" + "TP"), 6)::double'),
            _tall_sql("areas", ["ROC-AUC"], "round({c}, 6)::double", ' WHERE "ROC-AUC" IS NOT NULL'),
            _tall_sql("summary", _CELLS[:5], "round_even(round({c}, 9), 3)::double"),
            _tall_sql("summary", _CELLS[5:], "{c}::double"),
            f"""SELECT 'axes', NULL, 'metrics', round(greatest({METRIC_AXIS[1]}, least(min("Accuracy"), min("Precision"),
            min("Recall"), min("F1-Score")) - {METRIC_AXIS[0]}), 6)::double FROM o""",
            f"""SELECT 'axes', NULL, 'areas', round(greatest({AUC_AXIS[1]}, min("ROC-AUC") - {AUC_AXIS[0]}), 6)::double
            FROM o""",
        ]
    ),
)
def ev13_job(spark, sf):
    """Every report of the comparison in long form, from the files of the job."""
    out = scratch_path(spark, "comparison")
    compare_models(rounded(model_outputs(spark, sf), 9), out)

    def read(report, columns):
        kinds = ", ".join(f"`{c}` {'string' if c in ('Model', 'metric', 'axis') else 'double'}" for c in columns)
        return read_csv_typed(spark, f"{out}/{report}", kinds)

    def unpivoted(report, columns):
        return read(report, ["Model", *columns]).unpivot(["Model"], [quoted(c) for c in columns], "name", "value")

    parts = {
        "metrics": read("metrics", ["Model", "metric", "value"]).withColumnRenamed("metric", "name"),
        "shares": unpivoted("shares", CONFUSION_CELLS),
        "areas": unpivoted("areas", ["ROC-AUC"]),
        "summary": unpivoted("summary", _CELLS),
        "axes": read("axes", ["axis", "axis_floor"]).select(
            F.lit(None).cast("string").alias("Model"), F.col("axis").alias("name"), F.col("axis_floor").alias("value")
        ),
    }
    tagged = [df.select(F.lit(n).alias("report"), "Model", "name", "value") for n, df in parts.items()]
    return rounded(reduce(lambda a, b: a.unionByName(b), tagged))


@query(
    "st02_combined_metrics_job",
    with_views(THREE)
    + _K
    + """SELECT community_area, n_obs, "ModelType", round("FP_rate", 6) AS "FP_rate", round("FN_rate", 6) AS "FN_rate",
    round("Arrest_Rate_true", 6) AS "Arrest_Rate_true" FROM k""",
)
def st02_job(spark, sf):
    """The combined file of three models, read back."""
    out = scratch_path(spark, "combined")
    kinds = dict(combine_models(combined_tables(spark, sf), out).dtypes)
    schema = ", ".join(f"{c} {t}" for c, t in kinds.items())
    return rounded(read_csv_typed(spark, f"{out}/combined_by_community_metrics", schema))


# Layers by district and by area ---------------------------------------------------


def districts(spark, sf):
    """Nations as district shapes; some numbers are blank or bad."""
    n = F.col("n_nationkey")
    number = F.when(n % 10 == 7, "").when(n % 10 == 8, "n/a").otherwise(n.cast("string"))
    return table(spark, sf, "nation").select(
        F.create_map(F.lit("DIST_NUM"), number, F.lit("name"), F.col("n_name")).alias("properties")
    )


def district_scores(spark, sf):
    score = F.col("score")
    scores = F.array(
        F.struct(F.lit("A").alias("model"), score.alias("s")), F.struct(F.lit("C").alias("model"), (1.0 - score).alias("s"))
    )
    long = yearly(spark, sf).select(F.col("district").alias("District"), "label", F.inline(scores))
    return long.withColumnRenamed("s", "score").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def _by_model(scored, key, models):
    found = materialise(M.group_metrics(scored, ["model", key]), "group_metrics")
    return {m: found.filter(F.col("model") == m).drop("model") for m in models}


def _layers_sql(key: str, views: str, shapes: str, metrics) -> str:
    """CTEs of one key; ``views`` ends with rows ``t`` (model, region, label, score, prediction)."""
    value = {"ArrestRate_true": "rate", "AUC": "auc", "FP_rate": "fp / nullif(fp + tn, 0)", "FN_rate": "fn / nullif(fn + tp, 0)"}
    long = " UNION ALL ".join(f"SELECT model, region, '{m}' AS metric, ({value[m]})::double AS value FROM w" for m in metrics)
    fill = " ".join(f"WHEN '{m}' THEN {ramp_sql('value', 'vmin', 'vmax', LAYER_RAMPS[m])}" for m in metrics)
    return f"""(WITH {views},
    q AS (SELECT model, region, avg(label) AS rate,
          count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
          count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn
          FROM tt GROUP BY ALL),
    s0 AS (SELECT model, region, score, sum(label)::bigint AS pos, sum(1 - label)::bigint AS neg FROM tt GROUP BY ALL),
    s1 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, region ORDER BY score
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS nb FROM s0),
    a AS (SELECT model, region, sum(pos::double * (nb + neg / 2.0)) / nullif(sum(pos)::double * sum(neg), 0) AS auc
          FROM s1 GROUP BY ALL),
    w AS (SELECT * FROM q JOIN a USING (model, region)),
    l AS ({long}),
    f AS ({shapes}),
    j AS (SELECT f.text AS region, f.name, model AS "ModelType", metric, value FROM l JOIN f
          ON TRY_CAST(f.text AS int) = l.region WHERE value IS NOT NULL),
    z AS (SELECT "ModelType", metric, min(value) AS vmin, max(value) AS vmax FROM j GROUP BY ALL)
    SELECT '{key}' AS "key", region, name, "ModelType", metric, round(value, 6) AS value, round(vmin, 6) AS vmin,
    round(vmax, 6) AS vmax, CASE metric {fill} END AS fill FROM j JOIN z USING ("ModelType", metric))"""


_DISTRICT = (
    THREE.replace("t0 AS (", "tx AS (", 1).replace("FROM t0)", "FROM tx)", 1)
    + """, tt0 AS (SELECT 'A' AS model, district AS region, label, score FROM y
      UNION ALL SELECT 'C', district, label, 1.0 - score FROM y),
    tt AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM tt0)"""
)
_AREA = THREE + ", " + REGIONS + ", tt AS (SELECT model, area AS region, label, score, prediction FROM t WHERE model <> 'B')"


@query(
    "ge04_group_layers_job",
    _layers_sql(
        "District",
        _DISTRICT,
        """SELECT n_name AS name, CASE n_nationkey % 10 WHEN 7 THEN '' WHEN 8 THEN 'n/a' ELSE n_nationkey::varchar END AS text
        FROM nation""",
        GROUP_LAYERS["District"],
    )
    + " UNION ALL "
    + _layers_sql(
        "Community Area", _AREA, "SELECT community AS name, area_text AS text FROM g", GROUP_LAYERS["Community Area"]
    ),
)
def ge04_job(spark, sf):
    """Fourteen layers of two models, by district (with AUC) and by area, read back from the job's folders."""
    out = scratch_path(spark, "layers")
    areas = three_scores(spark, sf).withColumnRenamed("area", "Community Area")
    shapes = {"District": districts(spark, sf), "Community Area": regions(spark, sf)}
    tables = {
        "District": _by_model(district_scores(spark, sf), "District", "AC"),
        "Community Area": _by_model(areas.filter("model <> 'B'"), "Community Area", "AC"),
    }
    group_maps(shapes, tables, out)
    parts = []
    for key, folder, name in (("District", "district", "name"), ("Community Area", "community_area", "community")):
        layer = spark.read.parquet(f"{out}/layers_by_{folder}")
        parts.append(
            layer.select(
                F.lit(key).alias("key"), "region", F.col("properties")[name].alias("name"), "ModelType", "metric",
                "value", "vmin", "vmax", "fill",
            )
        )
    return rounded(parts[0].unionByName(parts[1]))


# Modelling and exploration --------------------------------------------------------

_CLEAN = with_views(RAW) + ", c AS (SELECT * FROM p WHERE label IS NOT NULL AND dt IS NOT NULL) "
_SPLIT = f", k AS (SELECT *, {hash_sql('split')} AS hashed FROM c) "


@query(
    "ag10_linear_job_by_area",
    _CLEAN
    + _SPLIT
    + f"""SELECT TRY_CAST(community_area AS int) AS community_area, count(*) AS n_obs, round(avg(label), 6) AS rate,
    sum(label)::bigint AS positives FROM k WHERE hashed < {int(0.2 * HASH_SIZE)} GROUP BY 1""",
)
def ag10_linear_job(spark, sf):
    """The logistic job at its published settings: rows, observed rate and positives of each area's report."""
    source, out = scratch_path(spark, "raw"), scratch_path(spark, "linear")
    normalize_names(raw_text(spark, sf)).write.parquet(source)
    run_linear(spark, source, out)
    schema = "community_area int, n_obs long, ArrestRate_true double, TP long, FN long"
    found = read_csv_typed(spark, f"{out}/by_community/metrics_csv", schema)
    return rounded(
        found.select(
            "community_area", "n_obs", F.col("ArrestRate_true").alias("rate"), (F.col("TP") + F.col("FN")).alias("positives")
        )
    )


@query(
    "ag10_forest_job_by_district",
    _CLEAN
    + _SPLIT
    + """, o AS (SELECT district, label, row_number() OVER (PARTITION BY label ORDER BY hashed) AS place,
      count(*) OVER (PARTITION BY label) AS own, count(*) OVER () AS n,
      count(*) OVER () - ceil(count(*) OVER () * 0.2::double)::bigint AS n_train FROM k),
    f AS (SELECT *, (own * n_train) // n AS base, (own * n_train) % n AS rest, ((n - own) * n_train) % n AS other FROM o)
    SELECT district AS "District", count(*) AS n_obs, round(avg(label), 6) AS rate, sum(label)::bigint AS positives
    FROM f WHERE place > base + CASE WHEN rest > other OR (rest = other AND rest > 0 AND label = 1) THEN 1 ELSE 0 END
    GROUP BY 1""",
)
def ag10_forest_job(spark, sf):
    """The tree job with a small forest: its report by district agrees with the rows held out, and with its errors."""
    out = scratch_path(spark, "forest")
    prepared = materialise(prepare_table(raw_text(spark, sf)), "prepared")
    run = run_trees(spark, prepared, out, "forest", hashed=["Block"], num_trees=10, max_depth=5)
    schema = "District string, n_obs long, ArrestRate_true double, TP long, FP long, FN long"
    found = read_csv_typed(spark, f"{out}/metrics_by_district", schema)
    errors = error_rates_by(run.scored, ["District"]).select("District", "total", F.col("FP").alias("fps"), F.col("FN").alias("fns"))
    agreed = (F.col("n_obs") == F.col("total")) & (F.col("FP") == F.col("fps")) & (F.col("FN") == F.col("fns"))
    return rounded(
        found.join(errors, "District", "left").select(
            "District",
            F.when(agreed, F.col("n_obs")).alias("n_obs"),
            F.col("ArrestRate_true").alias("rate"),
            (F.col("TP") + F.col("FN")).alias("positives"),
        )
    )


_EXPLORED = {
    "rate_by_hour": ("Hour", "hour(dt)"),
    "rate_by_year": ("Year", "year(dt)"),
    "rate_by_month": ("Month", "month(dt)"),
    "rate_by_dayofweek": ("DayOfWeek", "isodow(dt) - 1"),
    "rate_by_type": ("Primary Type", "primary_type"),
    "rate_by_beat": ("Beat", "beat"),
    "rate_by_season": (
        "Season",
        "CASE WHEN month(dt) IN (12, 1, 2) THEN 'Winter' WHEN month(dt) < 6 THEN 'Spring' WHEN month(dt) < 9 THEN 'Summer' ELSE 'Fall' END",
    ),
}


@query(
    "ag01_exploratory_job",
    _CLEAN
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS report, ({sql})::varchar AS "key", round(avg(label) * 100, 6) AS rate_pct FROM c
        WHERE ({sql}) IS NOT NULL GROUP BY 2"""
        for name, (_, sql) in _EXPLORED.items()
    ),
)
def ag01_job(spark, sf):
    """Raw rows to the prepared table to the single-key reports, in long form."""
    prepared = materialise(prepare_table(raw_text(spark, sf)), "prepared")
    reports = exploratory_reports(prepared)
    parts = [
        reports[name].select(F.lit(name).alias("report"), quoted(key).cast("string").alias("key"), "rate_pct")
        for name, (key, _) in _EXPLORED.items()
    ]
    return rounded(reduce(lambda a, b: a.unionByName(b), parts))
