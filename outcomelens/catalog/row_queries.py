"""Columns, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.tables import HOURLY, RAW, YEARLY, hourly, raw_text, rounded, table, with_views, yearly
from outcomelens.constants import LINEAR_COLUMNS, METRIC_ALIASES, RATE_RAMP, RAW_COLUMNS
from outcomelens.functions import calendar as C
from outcomelens.functions import colour as X
from outcomelens.functions import numeric as N
from outcomelens.functions import parsing as P
from outcomelens.operators import cleaning as K
from outcomelens.operators import columns as O
from outcomelens.operators import features as FE
from outcomelens.operators import metrics as M
from outcomelens.operators.ranks import number_rows

_RAW = with_views(RAW)
_H = with_views(HOURLY)
_Y = with_views(YEARLY)


def _parsed(spark, sf):
    return O.normalize_names(raw_text(spark, sf))


# Columns -----------------------------------------------------------------------


@query(
    "pr01_select_wanted",
    _RAW
    + """SELECT id AS "ID", case_number AS "Case Number", date AS "Date", block AS "Block", iucr AS "IUCR",
    primary_type AS "Primary Type", description AS "Description",
    location_description AS "Location Description", arrest AS "Arrest", domestic AS "Domestic",
    beat AS "Beat", district AS "District", ward AS "Ward", community_area AS " COMMUNITY AREA " FROM r""",
)
def pr01(spark, sf):
    return O.select_wanted(raw_text(spark, sf), RAW_COLUMNS)


@query(
    "pr01_select_wanted_none_matches",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
)
def pr01_none(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return O.select_wanted(line, RAW_COLUMNS)


@query("pr02_select_renamed", _RAW + "SELECT " + ", ".join(LINEAR_COLUMNS) + " FROM r")
def pr02(spark, sf):
    return O.select_wanted(raw_text(spark, sf), LINEAR_COLUMNS, "error", rename=True, normalize=True)


@query(
    "pr03_normalize_names",
    _RAW
    + """SELECT id, case_number, date, block, iucr, primary_type, description, location_description,
    arrest, domestic, beat, district, ward, community_area, fbi_code,
    value::varchar AS extra FROM r""",
)
def pr03(spark, sf):
    return O.normalize_names(raw_text(spark, sf))


@query(
    "pr04_resolve_aliases",
    _H
    + """SELECT area AS community_area, round(fp / nullif(n, 0), 6) AS fp_rate, NULL::double AS fn_rate,
    n::double AS n_obs, round(rate, 6) AS arrest_rate_true FROM (
      SELECT area, count(*) AS n, count(*) FILTER (label = 0 AND prediction = 1) AS fp, avg(label) AS rate
      FROM h GROUP BY area)""",
)
def pr04(spark, sf):
    messy = (
        hourly(spark, sf)
        .groupBy(F.col("area").cast("string").alias("Area Number"))
        .agg(
            N.ratio(F.count_if(F.expr("label = 0 and prediction = 1")), F.count("*")).alias("FPR "),
            F.count("*").alias("Support"),
            F.avg("label").alias("ArrestRate-True"),
        )
    )
    kinds = dict.fromkeys(METRIC_ALIASES, "double") | {"community_area": "int"}
    named = O.normalize_names(messy)
    return rounded(O.select_aliased(named, METRIC_ALIASES, kinds, ["community_area"]))


@query("pr05_keep_columns", _H + "SELECT id, label, area FROM h")
def pr05(spark, sf):
    return O.keep_present(hourly(spark, sf), ["id", "label", "not there", "area"])


@query(
    "pr06_drop_missing",
    _RAW + "SELECT id, block, date FROM r WHERE block IS NOT NULL AND date IS NOT NULL",
)
def pr06(spark, sf):
    return K.drop_missing(_parsed(spark, sf).select("id", "block", "date"), ["block", "date"])


@query(
    "pr07_keep_parsed",
    _RAW
    + """SELECT id, label, strftime(dt, '%Y-%m-%d %H:%M:%S') AS dt FROM p
    WHERE label IS NOT NULL AND dt IS NOT NULL""",
)
def pr07(spark, sf):
    df = K.keep_dated(K.keep_labelled(_parsed(spark, sf), "arrest"), "date")
    return df.select("id", "label", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query(
    "pr08_fill_missing_levels",
    _RAW
    + """SELECT id, coalesce(block, '__NA__') AS block, coalesce(ward, '__NA__') AS ward,
    coalesce(location_description, '__NA__') AS location_description FROM r""",
)
def pr08(spark, sf):
    df = _parsed(spark, sf).select("id", "block", "ward", "location_description")
    return K.fill_missing_levels(df, ["block", "ward", "location_description", "absent"])


@query(
    "pr09_coerce_numeric",
    _RAW
    + """SELECT id, TRY_CAST(community_area AS int) AS community_area, TRY_CAST(ward AS int) AS ward,
    TRY_CAST(date AS double) AS date FROM r""",
)
def pr09(spark, sf):
    df = _parsed(spark, sf).select("id", "community_area", "ward", "date")
    return O.coerce_numeric(df, {"community_area": "int", "ward": "int", "date": "double"})


@query(
    "pr09_whole_numbers",
    """SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE o_custkey END::int AS whole,
    CASE WHEN o_orderkey % 5 <> 4 THEN o_custkey + CASE WHEN o_orderkey % 5 = 3 THEN 0.5 ELSE 0 END END::double AS number
    FROM orders""",
)
def pr09_whole(spark, sf):
    """Whole numbers of several spellings; the same text also read as a double."""
    key, text = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    spelled = (
        F.when(key == 0, text)
        .when(key == 1, F.concat(text, F.lit(".0")))
        .when(key == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(key == 3, F.concat(text, F.lit(".5")))
        .otherwise("n/a")
    )
    df = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), spelled.alias("whole"), spelled.alias("number"))
    return O.coerce_numeric(df, {"whole": "int", "number": "double"})


@query(
    "pr10_completeness",
    _RAW + "SELECT count(TRY_CAST(community_area AS int)) AS non_null, count(*) AS total FROM r",
)
def pr10(spark, sf):
    df = O.coerce_numeric(_parsed(spark, sf), {"community_area": "int"})
    return K.completeness(df, "community_area")


@query(
    "pr11_key_exists",
    _RAW + "SELECT coalesce(max((ward IS NOT NULL)::int), 0)::boolean AS has_ward, false AS has_none FROM r",
)
def pr11(spark, sf):
    df = _parsed(spark, sf).withColumn("none", F.when(F.col("id") < "", F.col("id")))
    found = [(K.has_key(df, "ward"), K.has_key(df, "none"))]
    return spark.createDataFrame(found, "has_ward boolean, has_none boolean")


@query(
    "pr12_membership",
    _RAW + "SELECT id, arrest FROM r WHERE arrest IN ('TRUE', 'Y', 'NO')",
)
def pr12(spark, sf):
    return K.keep_members(_parsed(spark, sf).select("id", "arrest"), "arrest", ["TRUE", "Y", "NO"])


@query("pr13_tag_rows", _H + "SELECT id, label, 'events' AS origin FROM h")
def pr13(spark, sf):
    return O.tag_rows(hourly(spark, sf).select("id", "label"), "origin", "events")


@query(
    "pr14_keep_in_range",
    _H + "SELECT id, value, beat FROM h WHERE value BETWEEN 5 AND 60 AND beat BETWEEN 3 AND 20",
)
def pr14(spark, sf):
    df = hourly(spark, sf).select("id", "value", "beat")
    return K.keep_in_range(df, {"value": (5, 60), "beat": (3, 20)})


@query(
    "pr15_row_filters",
    _H + "SELECT id, primary_type, score FROM h WHERE primary_type = '4' AND score >= 0.25",
)
def pr15(spark, sf):
    df = hourly(spark, sf).select("id", "primary_type", "score")
    return K.keep_at_least(K.keep_equal(df, "primary_type", "4"), "score", 0.25)


@query("pr16_drop_helpers", _H + "SELECT id, label, prediction FROM h")
def pr16(spark, sf):
    df = hourly(spark, sf).select("id", "label", "prediction", "score", "score_b")
    return O.drop_helpers(df, "score", "score_b", "absent")


# Scalar functions --------------------------------------------------------------


@query(
    "sc01_parse_timestamp",
    _RAW + "SELECT id, date, strftime(dt, '%Y-%m-%d %H:%M:%S') AS parsed FROM p",
)
def sc01(spark, sf):
    at = P.parse_timestamp(F.col("date"))
    return _parsed(spark, sf).select("id", "date", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("sc02_parse_flag", _RAW + "SELECT id, label AS arrest, dom AS domestic FROM p")
def sc02(spark, sf):
    return _parsed(spark, sf).select(
        "id", P.parse_flag(F.col("arrest")).alias("arrest"), P.parse_flag(F.col("domestic")).alias("domestic")
    )


@query(
    "sc03_strict_flag",
    "SELECT doc_id, quality::int AS quality, (toxic = 1)::int AS toxic FROM labels",
)
def sc03(spark, sf):
    df = table(spark, sf, "labels")
    return df.select(
        "doc_id",
        P.strict_flag(F.col("quality").cast("string")).alias("quality"),
        P.strict_flag(F.col("toxic") == 1).alias("toxic"),
    )


@query(
    "sc04_date_parts",
    """SELECT event_id AS id, year(ts)::int AS y, month(ts)::int AS mo, day(ts)::int AS d, hour(ts)::int AS h
    FROM events""",
)
def sc04(spark, sf):
    ts = F.col("ts")
    return hourly(spark, sf).select(
        "id", F.year(ts).alias("y"), F.month(ts).alias("mo"), F.dayofmonth(ts).alias("d"), F.hour(ts).alias("h")
    )


@query(
    "sc05_day_of_week",
    """SELECT event_id AS id, (isodow(ts) - 1)::int AS monday0, (dayofweek(ts) + 1)::int AS sunday1 FROM events""",
)
def sc05(spark, sf):
    ts = F.col("ts")
    return hourly(spark, sf).select(
        "id",
        C.day_of_week(ts, C.MONDAY0).alias("monday0"),
        C.day_of_week(ts, C.SUNDAY1).alias("sunday1"),
    )


@query("sc06_weekend", _H + 'SELECT id, "IsWeekend" AS weekend FROM h')
def sc06(spark, sf):
    return hourly(spark, sf).select("id", C.is_weekend(F.col("ts")).alias("weekend"))


@query("sc07_season", _Y + 'SELECT id, "Season" AS season FROM y')
def sc07(spark, sf):
    return yearly(spark, sf).select("id", C.season(F.col("Month")).alias("season"))


@query(
    "sc08_log_count",
    _H + "SELECT block, round(ln(1 + count(*)), 6) AS log_n FROM h GROUP BY block",
)
def sc08(spark, sf):
    counts = hourly(spark, sf).groupBy("block").agg(F.count("*").alias("n"))
    return rounded(counts.select("block", N.log_count(F.col("n")).alias("log_n")))


@query("sc09_percent", _H + "SELECT beat, round(avg(label) * 100, 6) AS pct FROM h GROUP BY beat")
def sc09(spark, sf):
    rates = hourly(spark, sf).groupBy("beat").agg(F.avg("label").alias("rate"))
    return rounded(rates.select("beat", N.percent(F.col("rate")).alias("pct")))


@query(
    "sc10_rounding",
    _H + "SELECT id, round(score, 4) AS up4, round_even(value / 4, 1) AS even1 FROM h",
)
def sc10(spark, sf):
    return hourly(spark, sf).select(
        "id",
        N.round_half_up(F.col("score"), 4).alias("up4"),
        N.round_half_even(F.col("value") / 4, 1).alias("even1"),
    )


@query(
    "sc11_safe_ratio",
    """SELECT doc_id, round(quality / nullif(toxic, 0), 6) AS or_null,
    coalesce(round(quality / nullif(toxic, 0), 6), 0.0) AS or_zero FROM labels""",
)
def sc11(spark, sf):
    q, t = F.col("quality"), F.col("toxic")
    return table(spark, sf, "labels").select(
        "doc_id", N.ratio(q, t).alias("or_null"), N.ratio_or_zero(q, t).alias("or_zero")
    )


@query("sc13_threshold", _H + "SELECT id, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS above FROM h")
def sc13(spark, sf):
    return hourly(spark, sf).select("id", N.above_threshold(F.col("score"), 0.3).alias("above"))


@query("sc14_score_bucket", _H + "SELECT id, floor(score * 200) / 200.0 AS bucket FROM h")
def sc14(spark, sf):
    return hourly(spark, sf).select("id", N.score_bucket(F.col("score")).alias("bucket"))


@query("sc15_squared_error", _H + "SELECT id, round((score - label) * (score - label), 6) AS err FROM h")
def sc15(spark, sf):
    err = N.squared_error(F.col("score"), F.col("label"))
    return rounded(hourly(spark, sf).select("id", err.alias("err")))


def two_colour_sql(v: str) -> str:
    t = f"((greatest(0.4, least(0.9, {v})) - 0.4) / {0.9 - 0.4 + 1e-9!r}::double)"
    channels = ", ".join(
        f"trunc({a}.0::double + {t} * {b - a}.0::double)::int" for a, b in ((33, 215), (113, 25), (181, 28))
    )
    return f"format('#{{:02x}}{{:02x}}{{:02x}}', {channels})"


@query(
    "sc16_two_colour_fill",
    _H
    + f"""SELECT id, CASE WHEN label = 1 THEN {two_colour_sql('score::double')} ELSE '#dddddd' END AS fill
    FROM h""",
)
def sc16(spark, sf):
    value = F.when(F.col("label") == 1, F.col("score"))
    return hourly(spark, sf).select("id", X.two_colour_fill(value).alias("fill"))


def ramp_sql(v: str, lo: str, hi: str, stops) -> str:
    last = len(stops) - 1

    def edge(i: int) -> str:
        return f"({lo} + ({hi} - {lo}) * {i / last!r}::double)"

    def colour(parts) -> str:
        chans = ", ".join(f"trunc(({p}) * 255.9999::double)::int" for p in parts)
        return f"format('#{{:02x}}{{:02x}}{{:02x}}ff', {chans})"

    def fixed(stop) -> str:
        return colour([f"{c / 255.0!r}::double" for c in stop])

    out = f"CASE WHEN {v} <= {edge(0)} THEN {fixed(stops[0])} WHEN {v} >= {edge(last)} THEN {fixed(stops[last])}"
    for i in range(1, last + 1):
        p = f"(({v} - {edge(i - 1)}) / nullif({edge(i)} - {edge(i - 1)}, 0))"
        mixed = [
            f"(1.0::double - {p}) * {a / 255.0!r}::double + {p} * {b / 255.0!r}::double"
            for a, b in zip(stops[i - 1], stops[i])
        ]
        out += f" WHEN {v} <= {edge(i)} THEN {colour(mixed)}"
    return out + " END"


@query(
    "sc17_ramp_fill",
    _H + f"SELECT id, {ramp_sql('score::double', '0.1::double', '0.8::double', RATE_RAMP)} AS fill FROM h",
)
def sc17(spark, sf):
    fill = X.ramp_fill(F.col("score"), F.lit(0.1), F.lit(0.8), RATE_RAMP)
    return hourly(spark, sf).select("id", fill.alias("fill"))


@query(
    "sc18_cyclical",
    """SELECT event_id AS id, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin,
    round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
    round(sin(2 * pi() * month(ts) / 12), 6) AS month_sin,
    round(cos(2 * pi() * month(ts) / 12), 6) AS month_cos FROM events""",
)
def sc18(spark, sf):
    df = hourly(spark, sf).select("id", F.hour("ts").alias("hour"), F.month("ts").alias("month"))
    out = FE.add_cyclical(df, {"hour": 24, "month": 12}).drop("hour", "month")
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    waves = [c for c in out.columns if c != "id"]
    return rounded(out).withColumns({c: F.col(c) + 0.0 for c in waves})


@query(
    "sc19_numeric_then_text_order",
    _RAW
    + """SELECT community_area, count(*) AS n,
    row_number() OVER (ORDER BY TRY_CAST(community_area AS int) NULLS LAST, community_area) AS place
    FROM r GROUP BY community_area""",
)
def sc19(spark, sf):
    counts = _parsed(spark, sf).groupBy("community_area").agg(F.count("*").alias("n"))
    return number_rows(counts, P.numeric_then_text(F.col("community_area")))


@query(
    "fe01_calendar",
    _Y
    + """SELECT id, "Year", "Month", (isodow(ts) - 1)::int AS "DayOfWeek", hour(ts)::int AS "Hour",
    CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend", "Season" FROM y""",
)
def fe01(spark, sf):
    df = yearly(spark, sf).select("id", "ts")
    return FE.add_calendar(df, "ts").drop("ts")


@query(
    "ag14_table_profile",
    _H + "SELECT count(*) AS n_rows, 3::bigint AS n_columns, round(avg(label), 6) AS outcome_mean FROM h",
)
def ag14(spark, sf):
    return rounded(K.table_profile(hourly(spark, sf).select("id", "label", "score"), "label"))


@query(
    "ev08_brier",
    _H + "SELECT area, round(avg((score - label) * (score - label)), 6) AS brier FROM h GROUP BY area",
)
def ev08(spark, sf):
    return rounded(M.brier_score(hourly(spark, sf), ["area"]))
