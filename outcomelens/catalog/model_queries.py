"""Feature encoding and Spark ML pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.rate_queries import dated
from outcomelens.catalog.sample_queries import hash_sql
from outcomelens.catalog.metric_queries import AUC, CELLS, PR_AUC, ranks_sql
from outcomelens.catalog.tables import HOURLY, RAW, hourly, raw_text, rounded, with_views
from outcomelens.functions.hashing import HASH_SIZE
from outcomelens.functions.parsing import parse_flag
from outcomelens.operators import levels as LV
from outcomelens.operators import metrics as M
from outcomelens.operators import models as L
from outcomelens.operators.cleaning import fill_missing_levels
from outcomelens.operators.columns import normalize_names
from outcomelens.operators.model_tables import linear_model
from outcomelens.operators.sampling import add_class_weights, split_by_hash
from outcomelens.plans.prepare import prepare_linear, prepare_table
from outcomelens.session import materialise, scratch_path, spread_rows
from outcomelens.sources.writers import load_model, save_model

_H = with_views(HOURLY)
_R = with_views(RAW)
_SPLIT = hash_sql("split")

CATEGORICAL = ["primary_type", "beat"]
NUMERIC = ["domestic", "Hour", "DayOfWeek", "IsWeekend", "value"]


def planted(spark, sf):
    """Hourly incidents whose label also follows from their features, so models can learn."""
    df = dated(spark, sf)
    learnt = (F.col("value") > 40) | ((F.col("Hour") >= 18) & (F.col("domestic") == 1))
    df = df.withColumn("label", F.when(F.col("id") % 10 < 8, learnt.cast("double")).otherwise(F.col("label")))
    numeric = {c: F.col(c).cast("double") for c in NUMERIC}
    return fill_missing_levels(df.withColumns(numeric), CATEGORICAL).select(
        "id", "label", "area", *CATEGORICAL, *NUMERIC
    )


_PLANTED = """, z AS (SELECT id, area, CASE WHEN id % 10 < 8
    THEN (value > 40 OR ("Hour" >= 18 AND domestic = 1))::int ELSE label END AS label FROM h) """


def split(spark, sf):
    """Stored once: imputation, levels, training and scoring each read it."""
    return split_by_hash(materialise(spread_rows(planted(spark, sf)), "planted"), ["id"])


def logistic(train, **params):
    small = {"num_features": 1 << 12, "max_iter": 10, "reg_param": 0.01} | params
    return L.fit(L.logistic_pipeline(CATEGORICAL, NUMERIC, **small), train)


def forest(train):
    stages = L.one_hot_stages(CATEGORICAL, NUMERIC)
    pipeline = L.forest_pipeline(stages, num_trees=10, max_depth=5)
    return L.fit(pipeline, add_class_weights(train, "label", "balanced"))


def boosted(train):
    stages = L.one_hot_stages(CATEGORICAL, NUMERIC)
    pipeline = L.boosted_pipeline(stages, rounds=5, max_depth=4, step=0.1)
    return L.fit(pipeline, add_class_weights(train, "label", "positive"))


# Encoders ----------------------------------------------------------------------


@query(
    "fe04_hashed_categories",
    _H
    + """SELECT primary_type, beat::varchar AS beat, count(*) AS n, 1::bigint AS n_vectors, 2.0::double AS ones
    FROM h GROUP BY ALL""",
)
def fe04(spark, sf):
    """Every pair of levels has one vector with one entry per column."""
    hasher = FeatureHasher(
        inputCols=CATEGORICAL, categoricalCols=CATEGORICAL, outputCol="v", numFeatures=1 << 18
    )
    hashed = hasher.transform(planted(spark, sf).select(*CATEGORICAL))
    sparse = F.from_json(F.to_json(F.struct("v")), "v struct<indices array<int>, values array<double>>")
    pairs = hashed.select(*CATEGORICAL, sparse["v"].alias("v"))
    return pairs.groupBy(*CATEGORICAL).agg(
        F.count("*").alias("n"),
        F.count_distinct("v.indices").alias("n_vectors"),
        F.max(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x)).alias("ones"),
    )


@query(
    "fe05_one_hot",
    _H
    + """, t AS (SELECT primary_type, row_number() OVER (ORDER BY count(*) DESC, primary_type) - 1 AS slot
      FROM h GROUP BY primary_type)
    SELECT id, slot::int AS slot, 1.0::double AS ones, (SELECT count(*) FROM t)::int AS width
    FROM h JOIN t USING (primary_type)""",
)
def fe05(spark, sf):
    """Each level has one slot, the most frequent level the first."""
    df = planted(spark, sf).select("id", "primary_type")
    model = Pipeline(stages=L.one_hot_stages(["primary_type"], [])).fit(df)
    hot = vector_to_array("features")
    return model.transform(df).select(
        "id",
        (F.array_position(hot, 1.0) - 1).cast("int").alias("slot"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("ones"),
        F.size(hot).alias("width"),
    )


@query(
    "fe05_one_hot_unseen_level",
    _H
    + """, t AS (SELECT DISTINCT primary_type FROM h WHERE beat < 5 AND primary_type < '5')
    SELECT id, CASE WHEN t.primary_type IS NULL THEN 0.0 ELSE 1.0 END::double AS ones
    FROM h LEFT JOIN t USING (primary_type)""",
)
def fe05_unseen(spark, sf):
    df = planted(spark, sf)
    seen = df.filter("cast(beat as int) < 5 and primary_type < '5'")
    model = Pipeline(stages=L.one_hot_stages(["primary_type"], [])).fit(seen)
    hot = vector_to_array("features")
    return model.transform(df).select("id", F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("ones"))


@query(
    "fe05_levels_as_a_table",
    _H
    + """, u AS (SELECT 0 AS col, block AS level FROM h UNION ALL SELECT 1, beat::varchar FROM h),
    t AS (SELECT col, level, count(*) AS n FROM u GROUP BY ALL)
    SELECT col::int AS "column", level, n, row_number() OVER (ORDER BY col, n DESC, level) - 1 AS slot FROM t""",
)
def fe05_table(spark, sf):
    """The levels of two columns, by falling frequency; slots go on from one to the next."""
    return LV.level_table(hourly(spark, sf), ["block", "beat"])


@query(
    "fe05_slots_of_rows",
    _H
    + f""", t AS (SELECT block AS level, row_number() OVER (ORDER BY count(*) DESC, block) - 1 AS slot
      FROM h WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)} AND area > 9 GROUP BY block)
    SELECT id, block, slot FROM h LEFT JOIN t ON block = level""",
)
def fe05_slots(spark, sf):
    """Levels learnt from some rows and attached to all, with the broadcast ruled out; unseen ones have no slot."""
    rows = hourly(spark, sf).select("id", "block", "area")
    seen, _ = split_by_hash(rows, ["id"])
    levels = LV.level_table(seen.filter("area > 9"), ["block"])
    attached = LV.attach_slots(rows, levels, ["block"], ["id"], broadcast_rows=0)
    return attached.select("id", "block", F.col("__slot_0").alias("slot"))


@query(
    "fe06_assemble_skips_incomplete",
    _R
    + """SELECT id, (dom + ward::int)::double AS total FROM p WHERE dom IS NOT NULL AND ward IS NOT NULL""",
)
def fe06(spark, sf):
    r = normalize_names(raw_text(spark, sf))
    df = r.select("id", parse_flag(F.col("domestic")).alias("dom"), F.col("ward").try_cast("int").alias("ward"))
    assembler = L.one_hot_stages([], ["dom", "ward"])[-1]
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return assembler.transform(df).select("id", total.alias("total"))


@query(
    "fe07_numeric_passthrough",
    _H + 'SELECT id, "Hour"::double AS hour, value FROM h',
)
def fe07(spark, sf):
    df = planted(spark, sf).select("id", "Hour", "value")
    values = vector_to_array("features")
    assembled = L.one_hot_stages([], ["Hour", "value"])[-1].transform(df)
    return assembled.select("id", values[0].alias("hour"), values[1].alias("value"))


# Models ------------------------------------------------------------------------


@query("ml01_logistic_regression")
def ml01(spark, sf):
    train, test = split(spark, sf)
    return L.score_table(logistic(train), test, ["id", "label", "area"])


@query("ml02_random_forest")
def ml02(spark, sf):
    train, test = split(spark, sf)
    return L.score_table(forest(train), test, ["id", "label", "area"])


@query("ml03_boosted_trees")
def ml03(spark, sf):
    train, test = split(spark, sf)
    return L.score_table(boosted(train), test, ["id", "label", "area"])


@query(
    "ml04_scored_rows",
    _H
    + _PLANTED
    + f"""SELECT id, label::double AS label, true AS consistent FROM z
    WHERE {_SPLIT} < {int(0.2 * HASH_SIZE)}""",
)
def ml04(spark, sf):
    """Every test row is scored once; its prediction is its score against 0.5."""
    train, test = split(spark, sf)
    scored = L.score_table(logistic(train), test, ["id", "label"])
    ok = F.col("score").between(0, 1) & ((F.col("score") >= 0.5).cast("int") == F.col("prediction"))
    return scored.select("id", "label", ok.alias("consistent"))


@query(
    "ml01_logistic_mean_score",
    _H
    + _PLANTED
    + f"""SELECT count(*) AS n_rows, round(avg(label), 3) AS mean_score FROM z
    WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)}""",
)
def ml01_mean(spark, sf):
    """At the optimum the mean training score is the outcome rate: the intercept is not penalised."""
    train, _ = split(spark, sf)
    scored = L.score_table(logistic(train, max_iter=200), train, [])
    return rounded(scored.agg(F.count("*").alias("n_rows"), F.avg("score").alias("mean_score")), 3)


@query(
    "ml01_logistic_as_published",
    _H
    + f"""SELECT count(*) AS n_rows, round(avg(label), 2) AS mean_score FROM h
    WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)}""",
)
def ml01_published(spark, sf):
    """The published slots, rounds and penalty, which are the pipeline's defaults, on the table's own label."""
    columns = ["label", *CATEGORICAL, *NUMERIC]
    df = dated(spark, sf).withColumns({c: F.col(c).cast("double") for c in NUMERIC})
    train, _ = split_by_hash(fill_missing_levels(df, CATEGORICAL).select("id", *columns), ["id"])
    stored = materialise(train.select(*columns), "training")
    scored = L.score_table(L.fit(L.logistic_pipeline(CATEGORICAL, NUMERIC), stored), stored, [])
    return rounded(scored.agg(F.count("*").alias("n_rows"), F.avg("score").alias("mean_score")), 2)


_TEST_ROWS = (
    _H + f"SELECT count(*) AS n_rows, count(*) AS n_consistent, true AS learns FROM h "
    f"WHERE {_SPLIT} < {int(0.2 * HASH_SIZE)}"
)


def _learns(model, test):
    """Rows scored, rows whose prediction follows from the score, and whether the planted rule is found."""
    scored = L.score_table(model, test, ["label"])
    merged = M.run_metrics(scored).select((F.col("roc_auc") > 0.75).alias("learns"))
    ok = F.col("score").between(0, 1) & ((F.col("score") >= 0.5).cast("int") == F.col("prediction"))
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_if(ok).alias("n_consistent")
    ).withColumn("learns", merged.scalar())


@query("ml02_forest_learns", _TEST_ROWS)
def ml02_learns(spark, sf):
    train, test = split(spark, sf)
    return _learns(forest(train), test)


@query("ml03_boosted_learns", _TEST_ROWS)
def ml03_learns(spark, sf):
    train, test = split(spark, sf)
    return _learns(boosted(train), test)


#: A model written down rather than fitted: its scores have an exact SQL form.
#: The numbers are exact in binary, so that equal sums are equal in any order of adding.
WRITTEN = {"domestic": 0.75, "Hour": -0.0625, "value": 0.0078125}
INTERCEPT = -0.375
_SCORED = (
    _H
    + """, m AS (SELECT *, 1 / (1 + exp(-("""
    + " + ".join([f"{w}::double * {c}" if c != "Hour" else f'{w}::double * "Hour"' for c, w in WRITTEN.items()])
    + f""" + {INTERCEPT}::double))) AS p FROM h),
    w0 AS (SELECT * EXCLUDE (score, prediction), p AS score, (p >= 0.5)::int AS prediction FROM m) """
)


def written(spark):
    assembler = L.one_hot_stages([], list(WRITTEN))[-1]
    return PipelineModel([assembler, linear_model(spark, list(WRITTEN.values()), INTERCEPT)])


def written_rows(spark, sf):
    rows = dated(spark, sf).drop("score", "prediction")
    return rows.withColumns({c: F.col(c).cast("double") for c in [*WRITTEN, "label"]})


@query("sc12_positive_class_score", _SCORED + "SELECT id, round(score, 9) AS score FROM w0")
def sc12(spark, sf):
    """The score of a known model is its logistic curve."""
    scored = L.score_table(written(spark), written_rows(spark, sf), ["id", "label"])
    return rounded(scored.select("id", "score"), 9)


@query(
    "jn06_scored_rows_with_features",
    _SCORED + "SELECT id, label::double AS label, prediction, round(score, 6) AS score, primary_type, beat, area FROM w0",
)
def jn06(spark, sf):
    """Labels, scores and features of a row stay together; nothing is matched by position."""
    kept = ["id", "label", "primary_type", "beat", "area"]
    return rounded(L.score_table(written(spark), written_rows(spark, sf), kept))


@query(
    "sc12_score_is_sigmoid",
    _H + f"SELECT id, true AS of_positive_class FROM h WHERE {_SPLIT} < {int(0.2 * HASH_SIZE)}",
)
def sc12_sigmoid(spark, sf):
    """The score is the logistic curve of the positive class's raw value, not of the other one."""
    train, test = split(spark, sf)
    out = logistic(train).transform(test)
    curve = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    return out.select("id", (F.abs(curve - L.positive_score()) < 1e-9).alias("of_positive_class"))


TYPES = [f"type_{i}" for i in range(1, 10)]


def saturated(spark, sf):
    """One indicator per type but the first and no penalty, so that the optimum is known.

    Every coefficient is the difference of two log odds.
    """
    marks = {f"type_{i}": (F.col("primary_type") == str(i)).cast("double") for i in range(1, 10)}
    rows = materialise(planted(spark, sf).select("label", "primary_type").withColumns(marks), "marked")
    return L.fit(L.logistic_pipeline([], TYPES, max_iter=500, reg_param=0.0, tol=1e-9), rows)


_LOG_ODDS = (
    _H
    + _PLANTED.replace("SELECT id, area,", "SELECT id, primary_type,")
    + """, o AS (SELECT primary_type AS t, ln(sum(label) / (count(*) - sum(label))) AS odds FROM z GROUP BY ALL),
    w AS (SELECT 'type_' || t || '_imp' AS feature, odds - (SELECT odds FROM o WHERE t = '0') AS coef FROM o WHERE t <> '0') """
)


@query("ml05_numeric_coefficients", _LOG_ODDS + "SELECT feature, round(coef, 4) AS coef FROM w")
def ml05(spark, sf):
    return rounded(L.numeric_coefficients(spark, saturated(spark, sf), TYPES), 4)


@query(
    "sl03_strongest_coefficients",
    _LOG_ODDS
    + """SELECT feature, round(coef, 4) AS coef, 'positive' AS side FROM (SELECT * FROM w ORDER BY coef DESC, feature LIMIT 3)
    UNION ALL SELECT feature, round(coef, 4), 'negative' FROM (SELECT * FROM w ORDER BY coef, feature LIMIT 3)""",
)
def sl03(spark, sf):
    weights = L.numeric_coefficients(spark, saturated(spark, sf), TYPES)
    up = L.strongest(weights, 3).withColumn("side", F.lit("positive"))
    down = L.strongest(weights, 3, positive=False).withColumn("side", F.lit("negative"))
    return rounded(up.unionByName(down), 4)


@query(
    "ml01_gradient_vanishes",
    _H
    + f"""SELECT (SELECT count(*) FROM h WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)}) AS n_rows,
    (count(DISTINCT primary_type) + count(DISTINCT beat) + {len(NUMERIC)} + 1) AS n_slots, true AS vanishes
    FROM h WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)}""",
)
def ml01_gradient(spark, sf):
    """With the published slots and penalty the gradient of the penalised loss is zero in every slot."""
    train, _ = split(spark, sf)
    model = L.fit(L.logistic_pipeline(CATEGORICAL, NUMERIC, tol=1e-10), train)
    scored = model.transform(train).select("features", "label", L.positive_score().alias("score"))
    gradient = L.penalised_gradient(spark, model, materialise(scored, "scored"), 0.1)
    return gradient.agg(
        F.lit(scored.count()).cast("long").alias("n_rows"),
        F.count("*").alias("n_slots"),
        (F.max(F.abs("gradient")) < 1e-5).alias("vanishes"),
    )


def binary_rows(spark, sf):
    """Two 0/1 features, whose four cells a tree of depth 2 tells apart."""
    evening = (F.col("Hour") >= 18).cast("double")
    return planted(spark, sf).select("id", "label", "domestic", evening.alias("evening"))


_BINARY = (
    _H
    + _PLANTED.replace("SELECT id, area,", 'SELECT id, domestic, ("Hour" >= 18)::int AS evening,')
    + """, cells AS (SELECT domestic, evening, count(*)::double AS n, sum(label)::double AS p FROM z GROUP BY ALL) """
)


@query(
    "ml06_feature_importance",
    _BINARY
    + """, g AS (SELECT (SELECT 2 * sum(p) * (sum(n) - sum(p)) / sum(n) FROM cells) AS whole,
    (SELECT sum(x) FROM (SELECT 2 * sum(p) * (sum(n) - sum(p)) / sum(n) AS x FROM cells GROUP BY domestic)) AS a,
    (SELECT sum(x) FROM (SELECT 2 * sum(p) * (sum(n) - sum(p)) / sum(n) AS x FROM cells GROUP BY evening)) AS b),
    f AS (SELECT CASE WHEN a < b THEN 'domestic' ELSE 'evening' END AS root, whole - least(a, b) AS top FROM g),
    k AS (SELECT CASE WHEN root = 'domestic' THEN domestic ELSE evening END AS side, n, p FROM cells, f),
    c AS (SELECT 2 * sum(p) * (sum(n) - sum(p)) / sum(n) - sum(2 * p * (n - p) / n) AS gain FROM k
    GROUP BY side HAVING count(DISTINCT 2 * p > n) = 2),
    r AS (SELECT root AS feature, top AS gain FROM f UNION ALL
    SELECT CASE WHEN root = 'domestic' THEN 'evening' ELSE 'domestic' END, (SELECT sum(gain) FROM c) FROM f)
    SELECT feature, round(gain / (SELECT sum(gain) FROM r), 6) AS importance FROM r WHERE gain IS NOT NULL""",
)
def ml06(spark, sf):
    """The impurity a tree of depth 2 takes away, by the feature that takes it.

    A split whose two leaves say the same is taken back.
    """
    stages = L.one_hot_stages([], ["domestic", "evening"])
    tree = L.forest_pipeline(stages, num_trees=1, max_depth=2, min_leaf=1, weight=None, bootstrap=False)
    return rounded(L.feature_importance(spark, L.fit(tree, binary_rows(spark, sf))))


@query(
    "ml03_newton_leaf_values",
    _BINARY
    + """, one AS (SELECT *, 0.3 * (p - n * 0.5) / (n * 0.25 + 1) AS m FROM cells),
    two AS (SELECT *, 1 / (1 + exp(-m)) AS q FROM one),
    three AS (SELECT *, m + 0.3 * (p - n * q) / (n * q * (1 - q) + 1) AS f FROM two)
    SELECT domestic::double AS domestic, evening::double AS evening, n::bigint AS n, round(1 / (1 + exp(-f)), 9) AS score
    FROM three""",
)
def ml03_newton(spark, sf):
    """Two rounds without drawing: every leaf takes gradient over curvature, each plus its ridge."""
    rows = binary_rows(spark, sf)
    stages = L.one_hot_stages([], ["domestic", "evening"])
    whole = {"subsample": 1.0, "column_share": 1.0, "weight": None}
    model = L.fit(L.boosted_pipeline(stages, rounds=2, max_depth=2, step=0.3, **whole), rows)
    scored = L.score_table(model, rows, ["domestic", "evening"])
    return rounded(scored.groupBy("domestic", "evening").agg(F.count("*").alias("n"), F.max("score").alias("score")), 9)


@query(
    "ml07_feature_count",
    _H
    + f"""SELECT (count(DISTINCT primary_type) + count(DISTINCT beat) + {len(NUMERIC)})::int AS n_features
    FROM h WHERE {_SPLIT} >= {int(0.2 * HASH_SIZE)}""",
)
def ml07(spark, sf):
    train, _ = split(spark, sf)
    return spark.createDataFrame([(L.feature_count(forest(train)),)], "n_features int")


@query(
    "io08_model_round_trip",
    _H
    + f"""SELECT count(*) AS n_rows, count(*) AS n_equal FROM h WHERE {_SPLIT} < {int(0.2 * HASH_SIZE)}""",
)
def io08(spark, sf):
    """A saved and loaded model scores every row as the original does."""
    train, test = split(spark, sf)
    model = logistic(train)
    path = scratch_path(spark, "model")
    save_model(model, path)
    first = model.transform(test).select("id", L.positive_score().alias("before"))
    again = load_model(path).transform(test).select("id", L.positive_score().alias("after"))
    both = first.join(again, "id")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("before") == F.col("after")).alias("n_equal"))


@query(
    "ev14_model_evaluation",
    _SCORED
    + ranks_sql("w0")
    + f""", c AS (SELECT {CELLS} FROM w0)
    SELECT round((SELECT {AUC} FROM s), 6) AS roc_auc, round((SELECT {PR_AUC} FROM s), 6) AS pr_auc,
    round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, tp, tn, fp, fn FROM c""",
)
def ev14(spark, sf):
    """From a model to the summary row of the rows it scores."""
    return rounded(M.run_metrics(L.score_table(written(spark), written_rows(spark, sf), ["label"])))


# Preparation jobs --------------------------------------------------------------

_DATED = "FROM p WHERE label IS NOT NULL AND dt IS NOT NULL"


@query(
    "fe09_prepared_table",
    _R
    + f"""SELECT label AS "Arrest", primary_type AS "Primary Type", description AS "Description",
    location_description AS "Location Description", dom AS "Domestic", beat AS "Beat", block AS "Block",
    CASE WHEN block IS NOT NULL THEN count(*) OVER (PARTITION BY block) END AS "BlockFreq",
    district AS "District", ward AS "Ward", community_area AS "Community Area",
    year(dt)::int AS "Year", month(dt)::int AS "Month", (isodow(dt) - 1)::int AS "DayOfWeek",
    hour(dt)::int AS "Hour", CASE WHEN isodow(dt) IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend",
    'Winter' AS "Season", id {_DATED}""",
)
def fe09(spark, sf):
    return prepare_table(raw_text(spark, sf))


@query(
    "ml08_linear_model_table",
    _R
    + f"""SELECT id, label::double AS label, primary_type, coalesce(location_description, '__NA__')
    AS location_description, beat, district, coalesce(ward, '__NA__') AS ward,
    coalesce(TRY_CAST(community_area AS int)::varchar, '__NA__') AS community_area, fbi_code, iucr,
    coalesce(block, '__NA__') AS block, dom::double AS "DomesticNum", year(dt)::double AS "Year",
    month(dt)::double AS "Month", (dayofweek(dt) + 1)::double AS "DayOfWeek", hour(dt)::double AS "Hour",
    CASE WHEN isodow(dt) IN (6, 7) THEN 1.0 ELSE 0.0 END::double AS "IsWeekend" {_DATED}""",
)
def ml08(spark, sf):
    return prepare_linear(raw_text(spark, sf), ids=["id"])
