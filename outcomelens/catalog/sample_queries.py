"""Sampling, splitting, class weights and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelens.catalog import query
from outcomelens.catalog.tables import HOURLY, YEARLY, hourly, rounded, with_views, yearly
from outcomelens.functions.hashing import HASH_SIZE
from outcomelens.operators import sampling as S


def hash_sql(salt: str) -> str:
    return f"('0x' || substr(md5('{salt}|' || id), 1, 15))::bigint"


def _h(salt: str) -> str:
    return with_views(HOURLY, f"k AS (SELECT *, {hash_sql(salt)} AS hashed FROM h) ")


def _y(salt: str) -> str:
    return with_views(YEARLY, f"k AS (SELECT *, {hash_sql(salt)} AS hashed FROM y) ")



def _part(df, name):
    return df.select("id", "label", F.lit(name).alias("part"))


@query(
    "sm01_sample_by_hash",
    _y("sample") + f"SELECT id, label FROM k WHERE hashed < {int(0.25 * HASH_SIZE)}",
)
def sm01(spark, sf):
    return S.sample_by_hash(yearly(spark, sf).select("id", "label"), ["id"], 0.25)


@query(
    "sm01_stratified_sample_exact",
    _y("sample")
    + """SELECT id, label FROM (
      SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY hashed) AS place,
             count(*) OVER (PARTITION BY label) AS n FROM k)
    WHERE place <= round_even(n * 0.3::double, 0)""",
)
def sm01_exact(spark, sf):
    return S.stratified_sample(yearly(spark, sf).select("id", "label"), "label", ["id"], 0.3)


@query(
    "sm01_stratified_sample_size",
    _h("sample")
    + """SELECT id, label FROM (
      SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY hashed) AS place,
             count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total FROM k)
    WHERE place <= CASE WHEN 3000.0 / total >= 1 THEN n
                        ELSE round_even(n * (3000.0::double / total), 0) END""",
)
def sm01_size(spark, sf):
    return S.stratified_sample_size(hourly(spark, sf).select("id", "label"), "label", ["id"], 3000)


@query(
    "sm02_thin_negatives",
    _h("thin") + f"SELECT id, label FROM k WHERE label = 1 OR hashed < {int(0.2 * HASH_SIZE)}",
)
def sm02(spark, sf):
    return S.thin_negatives(hourly(spark, sf).select("id", "label"), "label", ["id"], 0.2)


@query(
    "sm03_split_by_hash",
    _h("split")
    + f"""SELECT id, label, CASE WHEN hashed < {int(0.2 * HASH_SIZE)} THEN 'test' ELSE 'train' END AS part
    FROM k""",
)
def sm03(spark, sf):
    train, test = S.split_by_hash(hourly(spark, sf).select("id", "label"), ["id"])
    return _part(train, "train").unionByName(_part(test, "test"))


@query(
    "sm04_stratified_split",
    _h("split")
    + """, c AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY hashed) AS place,
      count(*) OVER (PARTITION BY label) AS own, count(*) OVER () AS n,
      count(*) OVER () - ceil(count(*) OVER () * 0.2::double)::bigint AS n_train FROM k),
    f AS (SELECT *, (own * n_train) // n AS base, (own * n_train) % n AS rest,
      ((n - own) * n_train) % n AS other FROM c)
    SELECT id, label, CASE WHEN place <= base +
      CASE WHEN rest > other OR (rest = other AND rest > 0 AND label = 1) THEN 1 ELSE 0 END
      THEN 'train' ELSE 'test' END AS part FROM f""",
)
def sm04(spark, sf):
    train, test = S.stratified_split(hourly(spark, sf).select("id", "label"), "label", ["id"])
    return _part(train, "train").unionByName(_part(test, "test"))


@query(
    "sm05_balanced_weights",
    _h("split")
    + """SELECT id, label, round((SELECT count(*) FROM h) / (2.0 * count(*) OVER (PARTITION BY label)), 6)
    AS weight FROM h""",
)
def sm05(spark, sf):
    return rounded(S.add_class_weights(hourly(spark, sf).select("id", "label"), "label", "balanced"))


@query(
    "sm05_positive_weights",
    _h("split")
    + """SELECT id, label, CASE WHEN label = 1 THEN
      round((SELECT count(*) FILTER (label = 0) / count(*) FILTER (label = 1) FROM h), 6) ELSE 1.0 END
    AS weight FROM h""",
)
def sm05_positive(spark, sf):
    return rounded(S.add_class_weights(hourly(spark, sf).select("id", "label"), "label", "positive"))


@query(
    "st01_union_by_name",
    _h("sample")
    + f"""SELECT id, label, area FROM k WHERE label = 1
    UNION ALL SELECT id, label, area FROM k WHERE label = 0 AND hashed < {int(0.5 * HASH_SIZE)}""",
)
def st01(spark, sf):
    df = hourly(spark, sf)
    positives = df.filter("label = 1").select("id", "label", "area")
    negatives = df.filter("label = 0").select("area", "label", "id")
    return positives.unionByName(S.sample_by_hash(negatives, ["id"], 0.5))
