from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from outcomelens.functions import calendar as C
from outcomelens.functions import colour as X
from outcomelens.functions import numeric as N
from outcomelens.functions import parsing as P
from outcomelens.functions.hashing import HASH_SIZE, hash_below, stable_hash


def values(spark, rows, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_timestamps_in_each_format(spark):
    texts = [
        "12/31/2024 11:05:00 PM",
        "02/03/2024 23:10:15",
        "02/03/2024 23:10",
        "2024-02-03 04:05:06",
        "2024-02-03T04:05:06",
        "junk",
        None,
    ]
    out = values(spark, texts, "string", lambda c: F.date_format(P.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
    assert out == [
        "2024-12-31 23:05:00",
        "2024-02-03 23:10:15",
        "2024-02-03 23:10:00",
        "2024-02-03 04:05:06",
        "2024-02-03 04:05:06",
        None,
        None,
    ]


def test_shape_guard_does_not_change_results(spark):
    texts = ["02/03/2024 23:10:15", "2/3/2024 23:10", "02/03/2024 23:10 ", "02/03/2024 11:10:15 pm", "13/40/2024 23:10"]
    texts += ["02/03/2024 13:10:15 PM", "02/03/2024", "2024-02-03T04:05:06Z", "2024-02-30 04:05:06", ""]
    plain = lambda c: F.coalesce(
        F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(p)) for p in P.TIMESTAMP_PATTERNS]
    )
    assert values(spark, texts, "string", P.parse_timestamp) == values(spark, texts, "string", plain)
    assert P._shape("yyyy-MM-dd'T'HH:mm:ss") == r"^[+-]?\d{4,}\-\d{2}\-\d{2}T\d{2}:\d{2}:\d{2}$"
    assert P._shape("EEE, dd MMM") is None


def test_boolean_words(spark):
    words = ["TRUE", " t ", "1", "Y", "yes", "False", "f", "0", "n", "NO", "maybe", "", None]
    assert values(spark, words, "string", P.parse_flag) == [1] * 5 + [0] * 5 + [None] * 3
    assert values(spark, [True, False, None], "boolean", P.parse_flag) == [1, 0, None]


def test_strict_flag_rejects_words(spark):
    assert values(spark, ["1", "0"], "string", P.strict_flag) == [1, 0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["maybe"], "string", P.strict_flag)


def test_day_of_week_bases_share_the_weekend(spark):
    # Saturday, Sunday, Monday
    days = ["2024-06-01", "2024-06-02", "2024-06-03"]
    assert values(spark, days, "string", lambda c: C.day_of_week(c.cast("timestamp"))) == [5, 6, 0]
    assert values(spark, days, "string", lambda c: C.day_of_week(c.cast("timestamp"), C.SUNDAY1)) == [7, 1, 2]
    assert values(spark, days, "string", lambda c: C.is_weekend(c.cast("timestamp"))) == [1, 1, 0]
    with pytest.raises(ValueError):
        C.day_of_week(F.col("v"), "other")


def test_seasons(spark):
    assert values(spark, list(range(1, 13)) + [None], "int", C.season) == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter", None]
    )


def test_rounding_rules_differ_at_the_half(spark):
    assert values(spark, [0.0625, 0.1875], "double", lambda c: N.round_half_even(c, 3)) == [0.062, 0.188]
    assert values(spark, [0.03125, 0.09375], "double", lambda c: N.round_half_up(c, 4)) == [0.0313, 0.0938]


def test_ratios(spark):
    assert values(spark, [0.0, 4.0], "double", lambda c: N.ratio(F.lit(1), c)) == [None, 0.25]
    assert values(spark, [0.0, 4.0], "double", lambda c: N.ratio_or_zero(F.lit(1), c)) == [0.0, 0.25]


def test_score_one_is_its_own_bucket(spark):
    assert values(spark, [0.0, 0.0049, 0.005, 0.999, 1.0], "double", N.score_bucket) == [0.0, 0.0, 0.005, 0.995, 1.0]


def two_colour(a):
    if a is None:
        return "#dddddd"
    t = (max(0.4, min(0.9, a)) - 0.4) / (0.9 - 0.4 + 1e-9)
    return "#%02x%02x%02x" % tuple(int(p + t * (q - p)) for p, q in ((33, 215), (113, 25), (181, 28)))


def test_two_colour_fill(spark):
    scores = [None, 0.0, 0.4, 0.41, 0.6, 0.75, 0.8999, 0.9, 1.0]
    assert values(spark, scores, "double", X.two_colour_fill) == [two_colour(a) for a in scores]
    assert values(spark, [float("nan")], "double", X.two_colour_fill) == ["#dddddd"]


def test_ramp_takes_end_colours_outside_and_stops_inside(spark):
    stops = ((0, 0, 255), (0, 255, 0), (255, 0, 0))
    fill = lambda c: X.ramp_fill(c, F.lit(0.0), F.lit(1.0), stops)
    out = values(spark, [-1.0, 0.0, 0.25, 0.5, 0.75, 1.0, 2.0, None], "double", fill)
    assert out == [
        "#0000ffff", "#0000ffff", "#007f7fff", "#00ff00ff", "#7f7f00ff", "#ff0000ff", "#ff0000ff", None,
    ]


def test_ramp_of_no_width(spark):
    fill = lambda c: X.ramp_fill(c, F.lit(0.5), F.lit(0.5), ((0, 0, 255), (255, 0, 0)))
    assert values(spark, [0.4, 0.5, 0.6], "double", fill) == ["#0000ffff", "#0000ffff", "#ff0000ff"]


def test_stable_hash_is_uniform_and_fixed(spark):
    out = spark.range(20_000).select(stable_hash(F.col("id")).alias("h"))
    low = out.filter(hash_below(F.col("h"), 0.25)).count()
    assert 4_700 < low < 5_300
    assert out.agg(F.max("h")).first()[0] < HASH_SIZE
    # md5("7") = 8f14e45fceea167...
    assert spark.range(7, 8).select(stable_hash(F.col("id"))).first()[0] == int("8f14e45fceea167", 16)
