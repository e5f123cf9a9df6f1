"""Error sets and error shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.rate_queries import BIN_SQL, dated, dated_lines, edges_sql
from outcomelens.catalog.tables import HOURLY, YEARLY, hourly, rounded, with_views, yearly
from outcomelens.operators import errors as E

_H = with_views(HOURLY)
_Y = with_views(YEARLY)

_COUNTS = """count(*) AS total, count(*) FILTER (label = 0 AND prediction = 1) AS "FP",
    count(*) FILTER (label = 1 AND prediction = 0) AS "FN" """
_SHARES = 'round("FP" / total, 6) AS "FP_rate", round("FN" / total, 6) AS "FN_rate"'


def _rates_sql(views: str, view: str, key: str) -> str:
    return f'{views}SELECT *, {_SHARES} FROM (SELECT "{key}", {_COUNTS} FROM {view} GROUP BY "{key}")'


@query(
    "ev10_error_set_sizes",
    _H
    + """SELECT CASE WHEN prediction = 1 THEN CASE WHEN label = 1 THEN 'TP' ELSE 'FP' END
      ELSE CASE WHEN label = 1 THEN 'FN' ELSE 'TN' END END AS outcome, count(*) AS n FROM h GROUP BY 1""",
)
def ev10_sizes(spark, sf):
    return E.error_set_sizes(hourly(spark, sf))


@query(
    "ev10_false_positives",
    _H + "SELECT id, label, prediction, area FROM h WHERE label = 0 AND prediction = 1",
)
def ev10_fp(spark, sf):
    return E.error_set(hourly(spark, sf), "FP").select("id", "label", "prediction", "area")


@query(
    "ev10_false_negatives",
    _H + "SELECT id, label, prediction, area FROM h WHERE label = 1 AND prediction = 0",
)
def ev10_fn(spark, sf):
    return E.error_set(hourly(spark, sf), "FN").select("id", "label", "prediction", "area")


@query(
    "jn05_total_fp_fn_by_key",
    _Y
    + """SELECT t.beat, t.total, coalesce(fp."FP", 0) AS "FP", coalesce(fn."FN", 0) AS "FN" FROM
    (SELECT beat, count(*) AS total FROM y GROUP BY beat) t
    FULL JOIN (SELECT beat, count(*) AS "FP" FROM y WHERE label = 0 AND prediction = 1 GROUP BY beat) fp USING (beat)
    FULL JOIN (SELECT beat, count(*) AS "FN" FROM y WHERE label = 1 AND prediction = 0 GROUP BY beat) fn USING (beat)
    """,
)
def jn05(spark, sf):
    """Three counts per key without a join: the error sets are part of the total."""
    return E.error_rates_by(yearly(spark, sf), ["beat"]).select("beat", "total", "FP", "FN")


@query("ag17_errors_by_primary_type", _rates_sql(_H, "h", "primary_type"))
def ag17_type(spark, sf):
    return rounded(E.error_rates_by(hourly(spark, sf), ["primary_type"]))


@query("ag17_errors_by_beat", _rates_sql(_Y, "y", "beat"))
def ag17_beat(spark, sf):
    return rounded(E.error_rates_by(yearly(spark, sf), ["beat"]))


@query("ag17_errors_by_season", _rates_sql(_Y, "y", "Season"))
def ag17_season(spark, sf):
    return rounded(E.error_rates_by(dated_lines(spark, sf), ["Season"]))


@query("ag17_errors_by_domestic", _rates_sql(_H, "h", "domestic"))
def ag17_domestic(spark, sf):
    return rounded(E.error_rates_by(hourly(spark, sf), ["domestic"]))


@query("ag18_errors_by_hour", _rates_sql(_H, "h", "Hour"))
def ag18_hour(spark, sf):
    return rounded(E.error_rates_by(dated(spark, sf), ["Hour"]))


def _bins_sql(views: str, source: str, q: int) -> str:
    return (
        views
        + f", vals AS ({source}),"
        + edges_sql("vals", q)
        + f""", b AS (SELECT {BIN_SQL} AS bin, label, prediction, e FROM vals, edges)
    SELECT *, {_SHARES} FROM (SELECT bin::int AS bin, round(e[bin], 6) AS bin_low, round(e[bin + 1], 6) AS bin_high,
    {_COUNTS} FROM b GROUP BY bin, e)"""
    )


@query(
    "ag18_errors_by_year_bin",
    _bins_sql(_Y, 'SELECT "Year" AS v, label, prediction FROM y', 10),
)
def ag18_year(spark, sf):
    return rounded(E.error_rates_by_bin(yearly(spark, sf), "Year", 10))


@query(
    "ag18_errors_by_value_bin",
    _bins_sql(_H, "SELECT value AS v, label, prediction FROM h", 12),
)
def ag18_value(spark, sf):
    return rounded(E.error_rates_by_bin(hourly(spark, sf), "value", 12))


def _top_sql(by: str, n: int) -> str:
    inner = _rates_sql("", "y", "beat")
    return f'{_Y}SELECT * FROM ({inner}) ORDER BY "{by}" DESC, beat LIMIT {n}'


@query("sl02_top_fn_rate", _top_sql("FN_rate", 15))
def sl02_fn(spark, sf):
    return E.top_errors(rounded(E.error_rates_by(yearly(spark, sf), ["beat"])), "FN_rate", "beat", 15)


@query("sl02_top_fp_rate", _top_sql("FP_rate", 10))
def sl02_fp(spark, sf):
    return E.top_errors(rounded(E.error_rates_by(yearly(spark, sf), ["beat"])), "FP_rate", "beat", 10)


@query(
    "ev10_outcome_tag",
    _H
    + """SELECT id, CASE WHEN prediction = 1 THEN CASE WHEN label = 1 THEN 'TP' ELSE 'FP' END
      ELSE CASE WHEN label = 1 THEN 'FN' ELSE 'TN' END END AS outcome FROM h""",
)
def ev10_tag(spark, sf):
    return E.add_outcome(hourly(spark, sf)).select(F.col("id"), "outcome")
