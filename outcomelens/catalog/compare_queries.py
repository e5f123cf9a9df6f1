"""Model comparison and region layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.row_queries import ramp_sql, two_colour_sql
from outcomelens.catalog.tables import (
    REGIONS,
    THREE,
    YEARLY,
    regions,
    rounded,
    table,
    three_scores,
    with_views,
    yearly,
)
from outcomelens.constants import ERROR_RAMP, RATE_RAMP
from outcomelens.functions.numeric import ratio
from outcomelens.operators import compare as CP
from outcomelens.operators import metrics as M
from outcomelens.operators import regions as G
from outcomelens.session import materialise
from outcomelens.sources.writers import feature_lines

_T = with_views(THREE)
_TG = with_views(THREE, REGIONS)
_YG = with_views(YEARLY, REGIONS)

MIN_ROWS = 580


def model_outputs(spark, sf):
    """One row per model with the columns of a published comparison."""
    counts = M.true_rates(M.basic_metrics(M.confusion_counts(three_scores(spark, sf), ["model"])))
    auc = M.roc_auc(three_scores(spark, sf), ["model"])
    return (
        counts.join(auc, "model", "left")
        .select(
            F.col("model").alias("Model"),
            F.col("accuracy").alias("Accuracy"),
            F.col("precision").alias("Precision"),
            F.col("recall").alias("Recall"),
            F.col("f1").alias("F1-Score"),
            F.col("tn").alias("TN"),
            F.col("fp").alias("FP"),
            F.col("fn").alias("FN"),
            F.col("tp").alias("TP"),
            F.lit(None).cast("string").alias("Runtime"),
            F.when(F.col("model") != "B", F.col("auc")).alias("ROC-AUC"),
        )
    )


_OUT = (
    THREE
    + """,
s0 AS (SELECT model, score, sum(label)::bigint AS pos, sum(1 - label)::bigint AS neg FROM t GROUP BY ALL),
s AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS nb,
      sum(pos) OVER (PARTITION BY model)::bigint AS p, sum(neg) OVER (PARTITION BY model)::bigint AS n FROM s0),
auc AS (SELECT model, sum(pos::double * (nb + neg / 2.0)) / nullif(max(p)::double * max(n), 0) AS auc
        FROM s GROUP BY model),
c AS (SELECT model, sum(tn)::bigint AS tn, sum(fp)::bigint AS fp, sum(fn)::bigint AS fn,
      sum(tp)::bigint AS tp FROM m GROUP BY model),
o AS (SELECT model AS "Model", (tp + tn) / (tp + tn + fp + fn) AS "Accuracy", tp / (tp + fp) AS "Precision",
      tp / (tp + fn) AS "Recall", 2 * tp / (2 * tp + fp + fn) AS "F1-Score", tn AS "TN", fp AS "FP", fn AS "FN",
      tp AS "TP", CASE WHEN model <> 'B' THEN auc END AS "ROC-AUC" FROM c JOIN auc USING (model))
"""
)
_O = with_views(_OUT)


def area_metrics(spark, sf):
    """Supplier metrics of all models, from one pass over the scores."""
    keys = ["model", "area"]
    base = materialise(M.group_base(three_scores(spark, sf), keys), "area_metrics")
    return base.select(
        "model",
        "area",
        "n_obs",
        ratio(F.col("FP"), F.col("FP") + F.col("TN")).alias("FP_rate"),
        ratio(F.col("FN"), F.col("FN") + F.col("TP")).alias("FN_rate"),
        "ArrestRate_true",
    )


def combined_tables(spark, sf):
    """Three tables of three spellings; B has no observed rate."""
    found = area_metrics(spark, sf)
    a = found.filter("model = 'A'").select(
        F.col("area").alias("Community Area"), "n_obs", "FP_rate", "FN_rate", "ArrestRate_true"
    )
    b = found.filter("model = 'B'").select(
        F.col("area").cast("string").alias("AREA-NUMBER"),
        F.col("n_obs").alias("Support"),
        F.col("FP_rate").alias("FPR"),
        F.col("FN_rate").alias("False Negative Rate"),
    )
    c = found.filter("model = 'C'").select(
        F.col("area").cast("double").alias("area_id"),
        F.col("n_obs").alias("n"),
        F.col("FP_rate").alias("fp pct"),
        F.col("FN_rate").alias("fn pct"),
        F.col("ArrestRate_true").alias("true arrest rate"),
    )
    return {"A": a, "B": b, "C": c}


def combined(spark, sf):
    """The three tables, harmonised and stacked."""
    return CP.stack_tables([G.harmonise_metrics(df, m) for m, df in combined_tables(spark, sf).items()])


_K = """, k AS (SELECT area AS community_area, fp / nullif(fp + tn, 0) AS "FP_rate",
    fn / nullif(fn + tp, 0) AS "FN_rate", n_obs::double AS n_obs,
    CASE WHEN model <> 'B' THEN rate END AS "Arrest_Rate_true", model AS "ModelType" FROM m) """


def _round_sql(*cols: str) -> str:
    return ", ".join(f'round("{c}", 6) AS "{c}"' for c in cols)


@query(
    "ag15_confusion_shares",
    _O
    + 'SELECT "Model", '
    + ", ".join(f'round("{c}" / ("TN" + "FP" + "FN" + "TP"), 6) AS "{c}"' for c in ("TN", "FP", "FN", "TP"))
    + " FROM o",
)
def ag15(spark, sf):
    return rounded(CP.confusion_shares(model_outputs(spark, sf)))


@query(
    "ag16_metric_range",
    _T
    + _K
    + f"""SELECT "ModelType", round(coalesce(min("FP_rate") FILTER (n_obs >= {MIN_ROWS}), 0), 6) AS vmin,
    round(coalesce(max("FP_rate") FILTER (n_obs >= {MIN_ROWS}), 1), 6) AS vmax FROM k GROUP BY "ModelType" """,
)
def ag16(spark, sf):
    return rounded(CP.metric_range(combined(spark, sf), "FP_rate", "n_obs", MIN_ROWS, ["ModelType"]))


@query(
    "ag16_axis_floor",
    _O
    + """SELECT round(greatest(0.2, least(min("Accuracy"), min("Precision"), min("Recall"), min("F1-Score")) - 0.03), 6)
    AS axis_floor FROM o""",
)
def ag16_floor(spark, sf):
    metrics = ["Accuracy", "Precision", "Recall", "F1-Score"]
    return rounded(CP.axis_floor(model_outputs(spark, sf), metrics, 0.03, 0.2))


@query(
    "ag19_tall_metrics",
    _O
    + """SELECT "Model", metric, round(value, 6) AS value FROM
    (UNPIVOT (SELECT "Model", "Accuracy", "Precision", "Recall", "F1-Score" FROM o)
     ON "Accuracy", "Precision", "Recall", "F1-Score" INTO NAME metric VALUE value)""",
)
def ag19(spark, sf):
    return rounded(CP.tall_metrics(model_outputs(spark, sf)))


@query(
    "ag20_model_summary",
    _O
    + 'SELECT "Model", '
    + ", ".join(
        f'round_even(round("{c}", 9), 3) AS "{c}"'
        for c in ("Accuracy", "Precision", "Recall", "F1-Score", "ROC-AUC")
    )
    + ', "TN", "FP", "FN", "TP" FROM o',
)
def ag20(spark, sf):
    return CP.model_summary(rounded(model_outputs(spark, sf), 9))


@query("ag21_sorted_distinct", _T + 'SELECT DISTINCT model AS "ModelType" FROM m ORDER BY 1')
def ag21(spark, sf):
    return CP.sorted_distinct(combined(spark, sf), "ModelType")


@query(
    "ev13_model_comparison",
    _O + """SELECT "Model", round("ROC-AUC", 6) AS "ROC-AUC" FROM o WHERE "ROC-AUC" IS NOT NULL""",
)
def ev13(spark, sf):
    return rounded(CP.present_auc(model_outputs(spark, sf)))


@query(
    "st02_stack_models",
    _T
    + _K
    + f"""SELECT community_area, n_obs, "ModelType", {_round_sql("FP_rate", "FN_rate", "Arrest_Rate_true")}
    FROM k""",
)
def st02(spark, sf):
    return rounded(combined(spark, sf))


@query(
    "wn02_first_per_key",
    _T
    + _K
    + f"""SELECT community_area, n_obs, {_round_sql("Arrest_Rate_true")}, "ModelType" FROM (
      SELECT *, row_number() OVER (PARTITION BY community_area ORDER BY "ModelType") AS place FROM k
      WHERE "Arrest_Rate_true" IS NOT NULL) WHERE place = 1""",
)
def wn02(spark, sf):
    df = combined(spark, sf).select("community_area", "n_obs", "Arrest_Rate_true", "ModelType")
    kept = df.na.drop(subset=["community_area", "Arrest_Rate_true"])
    return rounded(CP.first_per_key(kept, "community_area", ["ModelType"]))


# Regions -----------------------------------------------------------------------


@query(
    "ge01_harmonise_metrics",
    _T
    + _K
    + f"""SELECT community_area, n_obs, "ModelType", {_round_sql("FP_rate", "FN_rate")}
    FROM k WHERE "ModelType" = 'B'""",
)
def ge01(spark, sf):
    messy = area_metrics(spark, sf).filter("model = 'B'").select(
        F.col("area").cast("string").alias("Comm Area"),
        F.col("n_obs").alias("Num-Obs"),
        F.col("FP_rate").alias(" False Positive Rate"),
        F.col("FN_rate").alias("FNR"),
    )
    return rounded(G.harmonise_metrics(messy, "B"))


# A whole key in the forms files hold it in; every fifth is no whole number.
_FORMS = """CASE area % 5 WHEN 0 THEN area::varchar WHEN 1 THEN area || '.0' WHEN 2 THEN ' ' || area || ' '
    WHEN 3 THEN area || '.5' ELSE 'n/a' END"""
_READ = "CASE WHEN area % 5 < 3 THEN area END"


def key_forms(area):
    text = area.cast("string")
    return (
        F.when(area % 5 == 0, text)
        .when(area % 5 == 1, F.concat(text, F.lit(".0")))
        .when(area % 5 == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(area % 5 == 3, F.concat(text, F.lit(".5")))
        .otherwise("n/a")
    )


@query(
    "ge01_decimal_text_keys",
    _T + _K + f"""SELECT ({_READ.replace("area", "community_area")})::int AS community_area, n_obs, "ModelType",
    {_round_sql("FP_rate", "FN_rate")} FROM k WHERE "ModelType" = 'B'""",
)
def ge01_decimal(spark, sf):
    """Whole areas written with a decimal point or blanks are read; other text is null."""
    messy = area_metrics(spark, sf).filter("model = 'B'").select(
        key_forms(F.col("area")).alias("Comm Area"), F.col("n_obs").alias("n"), "FP_rate", "FN_rate"
    )
    return rounded(G.harmonise_metrics(messy, "B"))


@query(
    "ge02_support_mask",
    _T
    + f"""SELECT model, area, CASE WHEN n_obs >= {MIN_ROWS} THEN round(rate, 6) END AS hide,
    CASE WHEN n_obs >= {MIN_ROWS} OR area % 3 = 0 THEN round(rate, 6) END AS show FROM m""",
)
def ge02(spark, sf):
    df = area_metrics(spark, sf)
    n = F.when(F.col("area") % 3 != 0, F.col("n_obs"))
    rate = F.col("ArrestRate_true")
    return rounded(
        df.select(
            "model",
            "area",
            G.supported_value(rate, F.col("n_obs"), MIN_ROWS).alias("hide"),
            G.supported_value(rate, n, MIN_ROWS, null_n="show").alias("show"),
        )
    )


def features(spark, sf):
    raw = regions(spark, sf)
    key = G.discover_property_key(raw)
    return G.feature_columns(raw, {"area_key": key, "community": "community"}).select(
        "area_key", "community"
    )


def accuracy(spark, sf):
    return M.accuracy_by_group(yearly(spark, sf), ["area"])


_ACC = """, acc AS (SELECT area, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 4)::double AS accuracy,
    count(*) AS n FROM y GROUP BY area) """


@query(
    "jn02_features_with_metrics",
    _YG
    + _ACC
    + """SELECT area_text AS area_key, community, area, accuracy, n FROM g
    JOIN acc ON TRY_CAST(area_text AS int) = area""",
)
def jn02(spark, sf):
    return G.join_features(features(spark, sf), accuracy(spark, sf), "area_key", "area")


@query(
    "jn02_decimal_text_keys",
    _YG
    + _ACC
    + f"""SELECT area_text AS area_key, community, {_FORMS} AS area, accuracy, n FROM g
    JOIN acc ON TRY_CAST(area_text AS int) = {_READ}""",
)
def jn02_decimal(spark, sf):
    right = accuracy(spark, sf).withColumn("area", key_forms(F.col("area")))
    return G.join_features(features(spark, sf), right, "area_key", "area")


def _enriched_sql() -> str:
    return (
        _YG
        + _ACC
        + f""", x AS (SELECT area_text AS area_key, community, accuracy, coalesce(n, 0) AS n,
      CASE WHEN n >= {MIN_ROWS} THEN accuracy END AS acc_plot
      FROM g LEFT JOIN acc ON TRY_CAST(area_text AS int) = area)
    SELECT *, CASE WHEN acc_plot IS NULL THEN '#dddddd' ELSE {two_colour_sql("acc_plot")} END AS fill,
      CASE WHEN acc_plot IS NULL THEN 0.3 ELSE 0.75 END AS opacity FROM x"""
    )


@query("ge03_enriched_features", _enriched_sql())
def ge03(spark, sf):
    return G.enrich_features(
        features(spark, sf), accuracy(spark, sf), "area_key", "area", min_support=MIN_ROWS
    )


@query(
    "jn03_features_left_join",
    _YG
    + _ACC
    + """SELECT area_text AS area_key, community, accuracy, coalesce(n, 0) AS n
    FROM g LEFT JOIN acc ON TRY_CAST(area_text AS int) = area""",
)
def jn03(spark, sf):
    out = G.enrich_features(features(spark, sf), accuracy(spark, sf), "area_key", "area")
    return out.select("area_key", "community", "accuracy", "n")


@query(
    "jn07_property_key",
    with_views(REGIONS) + "SELECT 'area_numbe' AS key, count(TRY_CAST(area_text AS int)) AS numbered FROM g",
)
def jn07(spark, sf):
    raw = regions(spark, sf)
    key = G.discover_property_key(raw)
    number = G.property_column(raw, key, "int")
    return raw.agg(F.lit(key).alias("key"), F.count(number).alias("numbered"))


@query(
    "jn07_column_key",
    "SELECT 'area_code' AS key, count(*) AS n, min(s_nationkey + 1) AS lowest FROM supplier",
)
def jn07_column(spark, sf):
    """Without a known name: the numeric ``area*`` column whose values all lie in 1..77."""
    df = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000).alias("area_far"),
        F.col("s_name").alias("area_name"),
        (F.col("s_nationkey") + 1).alias("area_code"),
    )
    key = G.discover_column_key(df)
    return df.agg(F.lit(key).alias("key"), F.count("*").alias("n"), F.min(key).alias("lowest"))


@query(
    "ge04_metric_layers",
    _TG
    + _K
    + f""", l AS (SELECT "ModelType", 'FP_rate' AS metric, community_area, n_obs, "FP_rate" AS value FROM k
      UNION ALL SELECT "ModelType", 'FN_rate', community_area, n_obs, "FN_rate" FROM k),
    z AS (SELECT "ModelType", metric, coalesce(min(value) FILTER (n_obs >= {MIN_ROWS}), 0.0)::double AS vmin,
      coalesce(max(value) FILTER (n_obs >= {MIN_ROWS}), 1.0)::double AS vmax FROM l GROUP BY ALL),
    j AS (SELECT area_text AS area_key, community, z."ModelType", z.metric, vmin, vmax, l.n_obs, l.value
      FROM g CROSS JOIN z LEFT JOIN l ON l."ModelType" = z."ModelType" AND l.metric = z.metric
      AND l.community_area = TRY_CAST(area_text AS int))
    SELECT area_key, community, "ModelType", metric, n_obs, {_round_sql("vmin", "vmax", "value")},
    CASE WHEN n_obs >= {MIN_ROWS} AND value IS NOT NULL THEN {ramp_sql("value", "vmin", "vmax", ERROR_RAMP)}
      ELSE '#dddddd' END AS fill,
    CASE WHEN n_obs >= {MIN_ROWS} AND value IS NOT NULL THEN 0.8 ELSE 0.3 END AS opacity FROM j""",
)
def ge04(spark, sf):
    return rounded(
        G.metric_layers(features(spark, sf), combined(spark, sf), "area_key", min_support=MIN_ROWS)
    )


@query(
    "ge04_observed_layer",
    _TG
    + _K
    + f""", l AS (SELECT community_area, n_obs, "Arrest_Rate_true" AS value FROM k WHERE "ModelType" = 'A'),
    z AS (SELECT min(value) FILTER (n_obs >= {MIN_ROWS}) AS vmin, max(value) FILTER (n_obs >= {MIN_ROWS}) AS vmax
      FROM l),
    j AS (SELECT area_text AS area_key, community, coalesce(vmin, 0.0)::double AS vmin,
      coalesce(vmax, 1.0)::double AS vmax, n_obs, value FROM g CROSS JOIN z
      LEFT JOIN l ON l.community_area = TRY_CAST(area_text AS int))
    SELECT area_key, community, n_obs, {_round_sql("vmin", "vmax", "value")},
    CASE WHEN n_obs >= {MIN_ROWS} AND value IS NOT NULL THEN {ramp_sql("value", "vmin", "vmax", RATE_RAMP)}
      ELSE '#dddddd' END AS fill,
    CASE WHEN n_obs >= {MIN_ROWS} AND value IS NOT NULL THEN 0.8 ELSE 0.3 END AS opacity FROM j""",
)
def ge04_observed(spark, sf):
    return rounded(
        G.observed_layer(features(spark, sf), combined(spark, sf), "area_key", min_support=MIN_ROWS)
    )


@query(
    "io09_feature_lines",
    _YG
    + _ACC
    + """SELECT '{"type":"Feature","properties":{"area_key":"' || area_text || '","community":"' || community
      || '","n":' || coalesce(n, 0) || '},"geometry":' || '{"type":"Point","coordinates":[' || s_nationkey
      || ',0]}' || '}' AS value FROM g LEFT JOIN acc ON TRY_CAST(area_text AS int) = area""",
)
def io09(spark, sf):
    raw = regions(spark, sf)
    named = G.feature_columns(raw, {"area_key": "area_numbe", "community": "community"})
    enriched = G.enrich_features(named, accuracy(spark, sf), "area_key", "area")
    return feature_lines(enriched, ["area_key", "community", "n"])
