"""Evaluation of scored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.tables import (
    DOCUMENTED,
    HOURLY,
    YEARLY,
    documented,
    hourly,
    rounded,
    with_views,
    yearly,
)
from outcomelens.functions.numeric import ratio
from outcomelens.operators import metrics as M
from outcomelens.operators import prefix as PX

_H = with_views(HOURLY)
_Y = with_views(YEARLY)
_D = with_views(DOCUMENTED)

CELLS = """count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (label = 1 AND prediction = 1) AS tp"""


def ranks_sql(view: str, group: str = "1", score: str = "score") -> str:
    """CTE ``s``: per distinct score, counts here, strictly below, from here up, and in total."""
    below = "ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f""", s0 AS (SELECT {group} AS grp, {score} AS score, sum(label)::bigint AS pos,
      sum(1 - label)::bigint AS neg FROM {view} GROUP BY ALL),
    s1 AS (SELECT *, sum(pos) OVER (PARTITION BY grp)::bigint AS p, sum(neg) OVER (PARTITION BY grp)::bigint AS n,
      coalesce(sum(pos) OVER (PARTITION BY grp {below}), 0)::bigint AS pb,
      coalesce(sum(neg) OVER (PARTITION BY grp {below}), 0)::bigint AS nb FROM s0),
    s AS (SELECT *, p - pb AS tp, n - nb AS fp FROM s1) """


AUC = "sum(pos::double * (nb + neg / 2.0)) / nullif(max(p)::double * max(n), 0)"
PR_AUC = """sum(pos * (tp / (tp + fp)
    + CASE WHEN tp + fp > pos + neg THEN (tp - pos) / (tp + fp - pos - neg) ELSE tp / (tp + fp) END) / 2.0)
    / nullif(max(p), 0)::double"""


@query("ag08_confusion_counts", _H + f"SELECT {CELLS}, count(*) AS n FROM h")
def ag08(spark, sf):
    return M.confusion_counts(hourly(spark, sf))


@query(
    "ag09_group_base",
    _H
    + """SELECT area, count(*) AS n_obs, round(avg(score), 6) AS "MeanProb",
    count(*) FILTER (label = 1) AS "P", count(*) FILTER (label = 0) AS "N",
    count(*) FILTER (label = 1 AND prediction = 1) AS "TP", count(*) FILTER (label = 0 AND prediction = 1) AS "FP",
    count(*) FILTER (label = 0 AND prediction = 0) AS "TN", count(*) FILTER (label = 1 AND prediction = 0) AS "FN",
    round(avg(prediction), 6) AS "ArrestRate_pred", round(avg(label), 6) AS "ArrestRate_true",
    round(avg((score - label) * (score - label)), 6) AS "Brier" FROM h GROUP BY area""",
)
def ag09(spark, sf):
    return rounded(M.group_base(hourly(spark, sf), ["area"]))


def _group_metrics_sql(views: str, view: str, key: str) -> str:
    return (
        views
        + ranks_sql(view, key)
        + f""", a AS (SELECT grp, {AUC} AS auc FROM s GROUP BY grp),
    c AS (SELECT {key} AS key, count(*) AS n_obs, avg(label) AS yt, avg(prediction) AS yp, avg(score) AS ms,
      {CELLS}, avg((score - label) * (score - label)) AS brier FROM {view} GROUP BY {key}),
    r AS (SELECT *, tp / nullif(tp + fp, 0) AS pr, tp / nullif(tp + fn, 0) AS re FROM c)
    SELECT key AS {key}, n_obs, round(yt, 6) AS "ArrestRate_true", round(yp, 6) AS "ArrestRate_pred",
      round(ms, 6) AS "MeanProb", tp AS "TP", fp AS "FP", tn AS "TN", fn AS "FN",
      round(pr, 6) AS "Precision", round(re, 6) AS "Recall",
      round(2 * pr * re / nullif(pr + re, 0), 6) AS "F1", round(auc, 6) AS "AUC", round(brier, 6) AS "Brier",
      round(fp / nullif(fp + tn, 0), 6) AS "FP_rate", round(fn / nullif(fn + tp, 0), 6) AS "FN_rate"
    FROM r JOIN a ON a.grp IS NOT DISTINCT FROM r.key"""
    )


@query("ag10_group_metrics_by_area", _group_metrics_sql(_H, "h", "area"))
def ag10(spark, sf):
    return rounded(M.group_metrics(hourly(spark, sf), ["area"]))


@query("ag10_group_metrics_by_district", _group_metrics_sql(_Y, "y", "district"))
def ag10_district(spark, sf):
    return rounded(M.group_metrics(yearly(spark, sf), ["district"]))


@query(
    "jn01_metrics_with_auc",
    _H
    + ranks_sql("h", "area")
    + f""", a AS (SELECT grp, {AUC} AS auc FROM s GROUP BY grp),
    c AS (SELECT area, count(*) AS n_obs, avg(score) AS ms FROM h GROUP BY area)
    SELECT area, n_obs, round(ms, 6) AS "MeanProb", round(auc, 6) AS auc FROM c LEFT JOIN a ON grp = area""",
)
def jn01(spark, sf):
    """The two-table form; AG10 computes both sides in one plan instead."""
    df = hourly(spark, sf)
    base = M.group_base(df, ["area"]).select("area", "n_obs", "MeanProb")
    return rounded(base.join(M.roc_auc(df, ["area"]), "area", "left"))


@query(
    "ag11_accuracy_by_group",
    _H
    + """SELECT area, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 4) AS accuracy,
    count(*) AS n FROM h GROUP BY area""",
)
def ag11(spark, sf):
    return M.accuracy_by_group(hourly(spark, sf), ["area"])


_BUCKETS = """, b AS (SELECT floor(score * 200) / 200.0 AS bucket, count(*) FILTER (label = 1) AS tp_bucket,
    count(*) FILTER (label = 0) AS fp_bucket FROM h GROUP BY ALL) """


@query("ag12_bucket_counts", _H + _BUCKETS + "SELECT bucket, tp_bucket, fp_bucket FROM b")
def ag12(spark, sf):
    ranks = M.bucket_ranks(hourly(spark, sf))
    return ranks.select("bucket", F.col("pos").alias("tp_bucket"), F.col("neg").alias("fp_bucket"))


@query(
    "ag13_class_totals",
    _D
    + """SELECT lang, source, count(*) FILTER (label = 1) AS "P", count(*) FILTER (label = 0) AS "N"
    FROM d GROUP BY lang, source""",
)
def ag13(spark, sf):
    return M.class_totals(documented(spark, sf), ["lang", "source"])


@query(
    "wn01_cumulative_counts",
    _H
    + _BUCKETS
    + """SELECT bucket, (sum(tp_bucket) OVER w)::bigint AS cum_tp, (sum(fp_bucket) OVER w)::bigint AS cum_fp
    FROM b WINDOW w AS (ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def wn01(spark, sf):
    reached = M.counts_from(M.bucket_ranks(hourly(spark, sf)))
    return reached.select("bucket", F.col("pos_from").alias("cum_tp"), F.col("neg_from").alias("cum_fp"))


@query(
    "wn03_prefix_sums",
    _H
    + ranks_sql("h", "area")
    + """SELECT grp AS area, score, pos, neg, pb AS pos_below, nb AS neg_below, p AS pos_total,
    n AS neg_total FROM s""",
)
def wn03(spark, sf):
    """Always by value ranges, whatever the size."""
    merged = M.score_counts(hourly(spark, sf), ["area"])
    return PX.prefix_sums(merged, "score", ["pos", "neg"], ["area"], small_rows=0)


@query(
    "wn03_prefix_sums_of_prices",
    """WITH c AS (SELECT l_extendedprice AS price, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT price, n, coalesce(sum(n) OVER (ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    ::bigint AS n_below, (sum(n) OVER ())::bigint AS n_total FROM c""",
)
def wn03_prices(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_extendedprice").alias("price"))
    return PX.prefix_sums(PX.merge_equal(df, "price", {"n": F.lit(1).cast("long")}), "price", ["n"])


@query(
    "ev01_basic_metrics",
    _H
    + f"""SELECT tn, fp, fn, tp, n, round((tp + tn) / n, 6) AS accuracy, round(pr, 6) AS precision,
    round(re, 6) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1 FROM (
      SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS re
      FROM (SELECT {CELLS}, count(*) AS n FROM h))""",
)
def ev01(spark, sf):
    return rounded(M.basic_metrics(M.confusion_counts(hourly(spark, sf))))


@query(
    "ev01_basic_metrics_by_source",
    _D
    + f"""SELECT lang, source, tn, fp, fn, tp, n, round((tp + tn) / n, 6) AS accuracy, round(pr, 6) AS precision,
    round(re, 6) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1 FROM (
      SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS re
      FROM (SELECT lang, source, {CELLS}, count(*) AS n FROM d GROUP BY lang, source))""",
)
def ev01_groups(spark, sf):
    return rounded(M.basic_metrics(M.confusion_counts(documented(spark, sf), ["lang", "source"])))


@query(
    "ev02_classification_report",
    _H
    + f""", c AS (SELECT {CELLS} FROM h),
    q AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,
      tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n FROM c),
    f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM q)
    SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM f
    UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM f
    UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / n, 6), n FROM f
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM f
    UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
      round((f0 * s0 + f1 * s1) / n, 6), n FROM f""",
)
def ev02(spark, sf):
    return rounded(M.classification_report(hourly(spark, sf)))


@query(
    "ev03_true_rates",
    _D
    + f"""SELECT lang, source, tn, fp, fn, tp, n, round(tp / nullif(tp + fn, 0), 6) AS tpr,
    round(tn / nullif(tn + fp, 0), 6) AS tnr
    FROM (SELECT lang, source, {CELLS}, count(*) AS n FROM d GROUP BY lang, source)""",
)
def ev03(spark, sf):
    return rounded(M.true_rates(M.confusion_counts(documented(spark, sf), ["lang", "source"])))


@query("ev04_auc", _Y + ranks_sql("y") + f"SELECT round({AUC}, 6) AS auc FROM s")
def ev04(spark, sf):
    return rounded(M.roc_auc(yearly(spark, sf)))


@query(
    "ev04_auc_by_group",
    _H + ranks_sql("h", "area") + f"SELECT grp AS area, round({AUC}, 6) AS auc FROM s GROUP BY grp",
)
def ev04_area(spark, sf):
    return rounded(M.roc_auc(hourly(spark, sf), ["area"]))


@query(
    "ev04_auc_by_source",
    _D
    + ranks_sql("d", "{'l': lang, 's': source}")
    + f"SELECT grp.l AS lang, grp.s AS source, round({AUC}, 6) AS auc FROM s GROUP BY grp",
)
def ev04_source(spark, sf):
    return rounded(M.roc_auc(documented(spark, sf), ["lang", "source"]))


@query("ev05_pr_auc", _H + ranks_sql("h") + f"SELECT round({PR_AUC}, 6) AS pr_auc FROM s")
def ev05(spark, sf):
    return rounded(M.pr_auc(hourly(spark, sf)))


@query(
    "ev05_pr_auc_by_group",
    _H + ranks_sql("h", "area") + f"SELECT grp AS area, round({PR_AUC}, 6) AS pr_auc FROM s GROUP BY grp",
)
def ev05_area(spark, sf):
    return rounded(M.pr_auc(hourly(spark, sf), ["area"]))


_CURVE = (
    _H
    + _BUCKETS
    + """, c AS (SELECT bucket, sum(tp_bucket) OVER w AS tp, sum(fp_bucket) OVER w AS fp,
      sum(tp_bucket) OVER () AS p, sum(fp_bucket) OVER () AS n FROM b
      WINDOW w AS (ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) """
)


@query("ev06_roc_curve", _CURVE + "SELECT round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c")
def ev06_roc(spark, sf):
    return rounded(M.roc_curve(M.curve_points(hourly(spark, sf))))


@query(
    "ev06_pr_curve",
    _CURVE + "SELECT round(tp / p, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM c",
)
def ev06_pr(spark, sf):
    return rounded(M.pr_curve(M.curve_points(hourly(spark, sf))))


_REACH = "tp / (tp + fp) >= "


@query(
    "ev07_best_threshold",
    _H
    + ranks_sql("h")
    + f"SELECT round(coalesce(min(score) FILTER ({_REACH} 0.42::double), 0.5), 6) AS threshold FROM s",
)
def ev07(spark, sf):
    return rounded(M.best_threshold(hourly(spark, sf), min_precision=0.42))


@query(
    "ev07_best_threshold_by_group",
    _H
    + ranks_sql("h", "area")
    + f"""SELECT grp AS area, round(coalesce(min(score) FILTER ({_REACH} 0.6::double), 0.5), 6) AS threshold
    FROM s GROUP BY grp""",
)
def ev07_area(spark, sf):
    return rounded(M.best_threshold(hourly(spark, sf), ["area"]))


@query(
    "ev09_calibration",
    _H
    + """SELECT primary_type, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS observed_rate
    FROM h GROUP BY primary_type""",
)
def ev09(spark, sf):
    return rounded(M.calibration(hourly(spark, sf), ["primary_type"]))


def _at_sql(cond: str, suffix: str) -> str:
    return f"""(SELECT [(tp + tn) / n, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0),
      tp / nullif(tp + fn, 0), tn / nullif(tn + fp, 0)] FROM (
        SELECT count(*) FILTER (label = 1 AND {cond}) AS tp, count(*) FILTER (label = 0 AND {cond}) AS fp,
               count(*) FILTER (label = 1 AND NOT {cond}) AS fn, count(*) FILTER (label = 0 AND NOT {cond}) AS tn,
               count(*) AS n FROM h)) AS m{suffix}"""


_BENCH_COLS = ("acc", "f1", "tpr", "tnr")


@query(
    "ev11_benchmark_row",
    _H
    + ranks_sql("h")
    + f""", best AS (SELECT coalesce(min(score) FILTER ({_REACH} 0.42::double), 0.5) AS thr, {AUC} AS auc FROM s),
    q AS (SELECT thr, auc, {_at_sql("score >= 0.5", "05")},
      {_at_sql("score >= (SELECT thr FROM best)", "rec")} FROM best)
    SELECT 'score' AS model, round(auc, 6) AS auc_05, round(auc, 6) AS auc_rec, round(thr, 6) AS thr_rec, """
    + ", ".join(f"round(m05[{i + 1}], 6) AS {c}_05" for i, c in enumerate(_BENCH_COLS))
    + ", "
    + ", ".join(f"round(mrec[{i + 1}], 6) AS {c}_rec" for i, c in enumerate(_BENCH_COLS))
    + ", 3 AS n_features, 'floor 0.42' AS note FROM q",
)
def ev11(spark, sf):
    row = M.benchmark_row(
        hourly(spark, sf), "score", n_features=3, note="floor 0.42", min_precision=0.42
    )
    return rounded(row.drop("t_pre", "t_cv", "t_pred"))


@query(
    "ev12_run_summary",
    _Y
    + ranks_sql("y")
    + f""", c AS (SELECT {CELLS} FROM y)
    SELECT round((SELECT {AUC} FROM s), 6) AS roc_auc, round((SELECT {PR_AUC} FROM s), 6) AS pr_auc,
    round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, tp, tn, fp, fn FROM c""",
)
def ev12(spark, sf):
    return rounded(M.run_metrics(yearly(spark, sf)))


@query(
    "ag13_overall_rate",
    _H + "SELECT round(avg(label), 6) AS rate FROM h",
)
def overall(spark, sf):
    totals = M.class_totals(hourly(spark, sf))
    return rounded(totals.select(ratio(F.col("P"), F.col("P") + F.col("N")).alias("rate")))
