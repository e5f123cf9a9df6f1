"""Outcome rates, pivots, frequency and quantile bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.tables import HOURLY, RAW, YEARLY, hourly, raw_text, rounded, with_views, yearly
from outcomelens.functions.parsing import parse_flag
from outcomelens.operators import features as FE
from outcomelens.operators import quantiles as Q
from outcomelens.operators import rates as R
from outcomelens.operators.columns import normalize_names
from outcomelens.operators.encoders import MedianImputer
from outcomelens.operators.ranks import number_rows
from outcomelens.plans.explore import exploratory_reports

_H = with_views(HOURLY)
_Y = with_views(YEARLY)


def dated(spark, sf):
    return FE.add_calendar(hourly(spark, sf), "ts")


def dated_lines(spark, sf):
    return FE.add_calendar(yearly(spark, sf).drop("Year", "Month"), "ts")


def _rate_sql(views: str, view: str, key: str) -> str:
    return f'{views}SELECT "{key}", round(avg(label) * 100, 6) AS rate_pct FROM {view} GROUP BY "{key}"'


@query("ag01_rate_by_hour", _rate_sql(_H, "h", "Hour"))
def ag01_hour(spark, sf):
    return rounded(R.outcome_rate(dated(spark, sf), ["Hour"], "label"))


@query("ag01_rate_by_dayofweek", _rate_sql(_H, "h", "DayOfWeek"))
def ag01_day(spark, sf):
    return rounded(R.outcome_rate(dated(spark, sf), ["DayOfWeek"], "label"))


@query("ag01_rate_by_beat", _rate_sql(_H, "h", "beat"))
def ag01_beat(spark, sf):
    return rounded(R.outcome_rate(hourly(spark, sf), ["beat"], "label"))


@query("ag01_rate_by_year", _rate_sql(_Y, "y", "Year"))
def ag01_year(spark, sf):
    return rounded(R.outcome_rate(yearly(spark, sf), ["Year"], "label"))


@query("ag01_rate_by_month", _rate_sql(_Y, "y", "Month"))
def ag01_month(spark, sf):
    return rounded(R.outcome_rate(yearly(spark, sf), ["Month"], "label"))


@query("ag01_rate_by_primary_type", _rate_sql(_Y, "y", "primary_type"))
def ag01_type(spark, sf):
    return rounded(R.outcome_rate(yearly(spark, sf), ["primary_type"], "label"))


@query("ag01_rate_by_season", _rate_sql(_Y, "y", "Season"))
def ag01_season(spark, sf):
    return rounded(R.outcome_rate(dated_lines(spark, sf), ["Season"], "label"))


@query(
    "ag01_rate_null_keys_kept",
    with_views(RAW)
    + "SELECT ward, round(avg(label) * 100, 6) AS rate_pct FROM p WHERE label IS NOT NULL GROUP BY ward",
)
def ag01_nulls(spark, sf):
    df = normalize_names(raw_text(spark, sf)).select("ward", parse_flag(F.col("arrest")).alias("label"))
    return rounded(R.outcome_rate(df.na.drop(subset=["label"]), ["ward"], "label", null_keys="keep"))


@query(
    "ag02_rate_by_hour_and_weekend",
    _H
    + """SELECT "Hour", "IsWeekend", round(avg(label) * 100, 6) AS rate_pct FROM h
    GROUP BY "Hour", "IsWeekend" """,
)
def ag02(spark, sf):
    return rounded(R.outcome_rate(dated(spark, sf), ["Hour", "IsWeekend"], "label"))


@query(
    "ag03_pivot_day_by_hour",
    _H
    + 'SELECT "DayOfWeek", '
    + ", ".join(f'round(avg(label) FILTER ("Hour" = {i}), 6) AS h{i}' for i in range(24))
    + ' FROM h GROUP BY "DayOfWeek"',
)
def ag03(spark, sf):
    return rounded(R.outcome_pivot(dated(spark, sf), "DayOfWeek", "Hour", range(24), "label", "h"))


@query(
    "ag04_busiest_groups",
    _H
    + """SELECT block, round(avg(label) * 100, 6) AS rate_pct, count(*) AS n FROM h GROUP BY block
    HAVING count(*) > 20 ORDER BY n DESC, block LIMIT 20""",
)
def ag04(spark, sf):
    return rounded(R.busiest_groups(hourly(spark, sf), "block", "label", min_count=20))


@query(
    "ag05_intensity_by_hour",
    _H
    + """SELECT "Hour", count(*) AS n, sum(label)::bigint AS outcomes,
    round(100.0 * sum(label) / count(*), 6) AS rate_pct,
    (SELECT round(100 * avg(label), 6) FROM h) AS overall_pct FROM h GROUP BY "Hour" """,
)
def ag05(spark, sf):
    return rounded(R.intensity(dated(spark, sf), "Hour", "label"))


def edges_sql(values: str, q: int) -> str:
    """CTEs: interpolated quantile edges of ``values(v)``, without duplicates, numbered from 0."""
    return f"""
    ordered AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos, count(*) OVER () AS n FROM {values}),
    ranks AS (SELECT i, ((i * (n - 1)) // {q})::bigint AS lo, ((i * (n - 1)) % {q}) AS rest, n
              FROM range(0, {q} + 1) t(i), (SELECT max(n) AS n FROM ordered)),
    ends AS (SELECT i, rest / {q}.0::double AS part, a.v AS va, b.v AS vb FROM ranks
             JOIN ordered a ON a.pos = lo JOIN ordered b ON b.pos = least(lo + 1, ranks.n - 1)),
    edges AS (SELECT list_sort(list(DISTINCT CASE WHEN part = 0 THEN va
                WHEN part < 0.5 THEN va + (vb - va) * part
                ELSE vb - (vb - va) * (1.0::double - part) END)) AS e FROM ends)"""


BIN_SQL = "greatest(len(list_filter(e, lambda x: x < v)), 1)"


@query(
    "ag06_rate_by_frequency_bin",
    _H
    + ", c AS (SELECT block, ln(1 + count(*)) AS v FROM h GROUP BY block),"
    + " vals AS (SELECT v, label FROM h JOIN c USING (block)),"
    + edges_sql("vals", 20)
    + f""", b AS (SELECT {BIN_SQL} AS bin, v, label, e FROM vals, edges)
    SELECT bin::int AS bin, round(e[bin], 6) AS bin_low, round(e[bin + 1], 6) AS bin_high,
    count(*) AS n, round(100 * avg(label), 6) AS rate_pct FROM b GROUP BY bin, e""",
)
def ag06(spark, sf):
    return rounded(R.rate_by_frequency_bin(hourly(spark, sf), "block", "label", 20))


@query(
    "ag06_rate_by_stored_frequency",
    _H
    + ", c AS (SELECT block, count(*) AS freq FROM h GROUP BY block),"
    + " vals AS (SELECT ln(1 + freq) AS v, label FROM h JOIN c USING (block)),"
    + edges_sql("vals", 20)
    + f""", b AS (SELECT {BIN_SQL} AS bin, v, label, e FROM vals, edges)
    SELECT bin::int AS bin, round(e[bin], 6) AS bin_low, round(e[bin + 1], 6) AS bin_high,
    count(*) AS n, round(100 * avg(label), 6) AS rate_pct FROM b GROUP BY bin, e""",
)
def ag06_stored(spark, sf):
    """A prepared table brings its frequencies along; the report reads them instead of counting again."""
    counted = FE.add_frequency(hourly(spark, sf).select("id", "block", "label"), "block", "BlockFreq", ["id"])
    report = exploratory_reports(counted.withColumnRenamed("block", "Block"), "label")
    return rounded(report["rate_by_block_frequency"])


@query(
    "ag07_season_report",
    _Y
    + """SELECT "Season", round(avg(label) * 100, 6) AS rate_pct FROM y GROUP BY "Season"
    ORDER BY list_position(['Winter', 'Spring', 'Summer', 'Fall'], "Season")""",
)
def ag07(spark, sf):
    return rounded(R.rate_by_season(dated_lines(spark, sf), "Season", "label"))


@query(
    "fe02_frequency_encoding",
    with_views(RAW)
    + """SELECT id, block, CASE WHEN block IS NOT NULL THEN count(*) OVER (PARTITION BY block) END AS block_freq
    FROM r""",
)
def fe02(spark, sf):
    df = normalize_names(raw_text(spark, sf)).select("id", "block")
    return FE.add_frequency(df, "block", "block_freq", ["id"])


@query(
    "jn04_frequency_lookup",
    _Y + "SELECT id, block, count(*) OVER (PARTITION BY block) AS block_freq FROM y",
)
def jn04(spark, sf):
    """The same lookup with the broadcast ruled out: hot keys split off, the rest shuffled."""
    df = yearly(spark, sf).select("id", "block")
    return FE.add_frequency(df, "block", "block_freq", ["id"], broadcast_rows=0)


@query(
    "fe03_median_imputation",
    with_views(RAW)
    + """, v AS (SELECT id, dom::double AS dom, TRY_CAST(ward AS double) AS ward,
      TRY_CAST(community_area AS double) AS area FROM p)
    SELECT id, dom, ward, area,
    coalesce(dom, (SELECT quantile_disc(dom, 0.5) FROM v)) AS dom_imp,
    coalesce(ward, (SELECT quantile_disc(ward, 0.5) FROM v)) AS ward_imp,
    coalesce(area, (SELECT quantile_disc(area, 0.5) FROM v)) AS area_imp FROM v""",
)
def fe03(spark, sf):
    r = normalize_names(raw_text(spark, sf))
    df = r.select(
        "id",
        parse_flag(F.col("domestic")).cast("double").alias("dom"),
        F.col("ward").try_cast("double").alias("ward"),
        F.col("community_area").try_cast("double").alias("area"),
    )
    columns = ["dom", "ward", "area"]
    return MedianImputer(inputCols=columns, outputCols=[f"{c}_imp" for c in columns]).fit(df).transform(df)


@query(
    "fe08_quantile_bins",
    _H
    + ", vals AS (SELECT id, value AS v FROM h),"
    + edges_sql("vals", 20)
    + f""", b AS (SELECT id, v, {BIN_SQL} AS bin, e FROM vals, edges)
    SELECT id, v AS value, bin::int AS bin, round(e[bin], 6) AS bin_low, round(e[bin + 1], 6) AS bin_high
    FROM b""",
)
def fe08(spark, sf):
    return rounded(Q.quantile_bins(hourly(spark, sf).select("id", "value"), "value", 20))


@query(
    "fe08_quantile_bins_with_ties",
    _Y
    + ", vals AS (SELECT id, CASE WHEN quantity < 30 THEN 1.0 ELSE quantity END AS v FROM y),"
    + edges_sql("vals", 20)
    + f""", b AS (SELECT {BIN_SQL} AS bin, e FROM vals, edges)
    SELECT bin::int AS bin, round(e[bin], 6) AS bin_low, round(e[bin + 1], 6) AS bin_high, count(*) AS n
    FROM b GROUP BY bin, e""",
)
def fe08_ties(spark, sf):
    v = F.when(F.col("quantity") < 30, 1.0).otherwise(F.col("quantity"))
    binned = Q.quantile_bins(yearly(spark, sf).select(v.alias("v")), "v", 20)
    return rounded(binned.groupBy("bin", "bin_low", "bin_high").agg(F.count("*").alias("n")))


@query(
    "sl01_rates_in_order",
    _H
    + """SELECT beat, rate_pct, row_number() OVER (ORDER BY rate_pct DESC, beat) AS place FROM
    (SELECT beat, round(avg(label) * 100, 6) AS rate_pct FROM h GROUP BY beat)""",
)
def sl01(spark, sf):
    report = rounded(R.outcome_rate(hourly(spark, sf), ["beat"], "label"))
    return number_rows(report, R.rate_order(["beat"]))
