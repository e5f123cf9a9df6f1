"""Incident views over the driver tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: hours of one month, 77 areas, a score with ties."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    score = F.col("value") / (F.col("value") + 50.0)
    return e.select(
        F.col("event_id").alias("id"),
        "ts",
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
        (k % 2).alias("domestic"),
        F.floor(k / 10).cast("string").alias("primary_type"),
        (F.col("user_id") % 25).cast("int").alias("beat"),
        (F.col("user_id") % 77).cast("int").alias("area"),
        F.col("user_id").cast("string").alias("block"),
        "value",
        score.alias("score"),
        (score >= 0.5).cast("int").alias("prediction"),
        (F.col("value") / (F.col("value") + 20.0)).alias("score_b"),
        (1.0 - score).alias("score_c"),
    )


HOURLY = """
h AS (
  SELECT event_id AS id, ts,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS label,
         json_extract_string(props, '$.k')::int % 2 AS domestic,
         (json_extract_string(props, '$.k')::int // 10)::varchar AS primary_type,
         (user_id % 25)::int AS beat,
         (user_id % 77)::int AS area,
         user_id::varchar AS block,
         value,
         value / (value + 50.0) AS score,
         CASE WHEN value / (value + 50.0) >= 0.5 THEN 1 ELSE 0 END AS prediction,
         value / (value + 20.0) AS score_b,
         1.0 - value / (value + 50.0) AS score_c,
         hour(ts)::int AS "Hour", (isodow(ts) - 1)::int AS "DayOfWeek",
         CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend"
  FROM events)
"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: several years and all seasons, categories from its part."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    score = F.col("l_quantity") / (F.col("l_quantity") + 25.0)
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_shipdate").alias("ts"),
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            F.col("p_type").alias("primary_type"),
            F.col("p_brand").alias("beat"),
            F.col("s_nationkey").alias("district"),
            F.col("l_suppkey").cast("int").alias("area"),
            F.col("l_partkey").cast("string").alias("block"),
            F.col("l_quantity").alias("quantity"),
            score.alias("score"),
            (score >= 0.5).cast("int").alias("prediction"),
            F.year("l_shipdate").alias("Year"),
            F.month("l_shipdate").alias("Month"),
        )
    )


YEARLY = """
y AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_shipdate AS ts,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         p_type AS primary_type, p_brand AS beat, s_nationkey AS district,
         l_suppkey::int AS area, l_partkey::varchar AS block, l_quantity AS quantity,
         l_quantity / (l_quantity + 25.0) AS score,
         CASE WHEN l_quantity / (l_quantity + 25.0) >= 0.5 THEN 1 ELSE 0 END AS prediction,
         year(l_shipdate)::int AS "Year", month(l_shipdate)::int AS "Month",
         CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter'
              WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Spring'
              WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Fall' END AS "Season"
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
"""


def documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled document: many small groups, some of a single class."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    q = table(spark, sf_dir, "labels")
    score = F.col("n_chars") / (F.col("n_chars") + 2000.0)
    return q.join(d, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        "lang",
        "source",
        score.alias("score"),
        (score >= 0.5).cast("int").alias("prediction"),
    )


DOCUMENTED = """
d AS (
  SELECT labels.doc_id AS id, quality AS label, lang, source,
         n_chars / (n_chars + 2000.0) AS score,
         CASE WHEN n_chars / (n_chars + 2000.0) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labels JOIN documents ON labels.doc_id = documents.doc_id)
"""


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a raw incident file would hold them: all text, mixed date formats,
    boolean words, blanks and nulls, names with spaces."""
    e = table(spark, sf_dir, "events")
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    date = (
        F.when(eid % 6 == 0, F.date_format(ts, "MM/dd/yyyy hh:mm:ss a"))
        .when(eid % 6 == 1, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
        .when(eid % 6 == 2, F.date_format(ts, "MM/dd/yyyy HH:mm"))
        .when(eid % 6 == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(eid % 6 == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(eid % 12 == 5, "not a date")
    )
    yes = F.element_at(F.array(*map(F.lit, ("TRUE", " t ", "1", "Y", "yes"))), (eid % 5 + 1).cast("int"))
    no = F.element_at(F.array(*map(F.lit, ("False", "f", "0", "n", "NO"))), (eid % 5 + 1).cast("int"))
    arrest = (
        F.when(eid % 20 == 19, "maybe")
        .when(F.col("event_type").isin("purchase", "signup"), yes)
        .otherwise(no)
    )
    text = "string"
    return e.select(
        eid.cast(text).alias("ID"),
        F.concat(F.lit("C"), eid.cast(text)).alias("Case Number"),
        date.alias("Date"),
        F.when(uid % 10 != 3, F.concat(F.lit("B"), uid.cast(text))).alias("Block"),
        k.cast(text).alias("IUCR"),
        F.concat(F.lit("T"), F.floor(k / 10).cast(text)).alias("Primary Type"),
        F.col("event_type").alias("Description"),
        F.when(k % 7 != 0, F.concat(F.lit("L"), (k % 7).cast(text))).alias("Location Description"),
        arrest.alias("Arrest"),
        F.when(k % 11 != 0, F.when(k % 2 == 1, "true").otherwise("false")).alias("Domestic"),
        (uid % 25).cast(text).alias("Beat"),
        (uid % 22).cast(text).alias("District"),
        F.when(uid % 5 != 4, (uid % 50).cast(text)).alias("Ward"),
        F.when(uid % 31 != 0, (uid % 77).cast(text)).otherwise("n/a").alias(" COMMUNITY AREA "),
        F.concat(F.lit("F"), (k % 15).cast(text)).alias("FBI-Code"),
        F.col("value").cast(text).alias("Extra"),
    )


RAW = """
r AS (
  SELECT event_id::varchar AS id, 'C' || event_id AS case_number,
         CASE event_id % 6
           WHEN 0 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
           WHEN 1 THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
           WHEN 2 THEN strftime(ts, '%m/%d/%Y %H:%M')
           WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
           ELSE CASE WHEN event_id % 12 = 5 THEN 'not a date' END END AS date,
         CASE WHEN user_id % 10 <> 3 THEN 'B' || user_id END AS block,
         k::varchar AS iucr, 'T' || (k // 10) AS primary_type, event_type AS description,
         CASE WHEN k % 7 <> 0 THEN 'L' || (k % 7) END AS location_description,
         CASE WHEN event_id % 20 = 19 THEN 'maybe'
              WHEN event_type IN ('purchase', 'signup')
                THEN (['TRUE', ' t ', '1', 'Y', 'yes'])[event_id % 5 + 1]
              ELSE (['False', 'f', '0', 'n', 'NO'])[event_id % 5 + 1] END AS arrest,
         CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 2 = 1 THEN 'true' ELSE 'false' END END AS domestic,
         (user_id % 25)::varchar AS beat, (user_id % 22)::varchar AS district,
         CASE WHEN user_id % 5 <> 4 THEN (user_id % 50)::varchar END AS ward,
         CASE WHEN user_id % 31 <> 0 THEN (user_id % 77)::varchar ELSE 'n/a' END AS community_area,
         'F' || (k % 15) AS fbi_code, value
  FROM (SELECT *, json_extract_string(props, '$.k')::int AS k FROM events)),
p AS (
  SELECT *,
         CASE WHEN lower(trim(arrest)) IN ('true', 't', '1', 'y', 'yes') THEN 1
              WHEN lower(trim(arrest)) IN ('false', 'f', '0', 'n', 'no') THEN 0 END AS label,
         CASE WHEN lower(trim(domestic)) IN ('true', 't', '1', 'y', 'yes') THEN 1
              WHEN lower(trim(domestic)) IN ('false', 'f', '0', 'n', 'no') THEN 0 END AS dom,
         try_strptime(date, ['%m/%d/%Y %I:%M:%S %p', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M',
                             '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) AS dt
  FROM r)
"""

# Per-supplier metrics of three scores, and suppliers as region features.
MODELS = {"A": "score", "B": "score_b", "C": "score_c"}


def three_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with three scores in long form: model, area, label, score, prediction."""
    y = yearly(spark, sf_dir)
    q = F.col("quantity")
    scores = F.array(
        F.struct(F.lit("A").alias("model"), (q / (q + 25.0)).alias("score")),
        F.struct(F.lit("B").alias("model"), (q / (q + 10.0)).alias("score")),
        F.struct(F.lit("C").alias("model"), (1.0 - q / (q + 25.0)).alias("score")),
    )
    return y.select("area", "label", F.inline(scores)).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


THREE = (
    YEARLY
    + """,
t0 AS (
  SELECT area, label, 'A' AS model, quantity / (quantity + 25.0) AS score FROM y
  UNION ALL SELECT area, label, 'B', quantity / (quantity + 10.0) FROM y
  UNION ALL SELECT area, label, 'C', 1.0 - quantity / (quantity + 25.0) FROM y),
t AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM t0),
m AS (
  SELECT model, area, count(*) AS n_obs,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         avg(label) AS rate
  FROM t GROUP BY model, area)
"""
)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as region features; some keys are blank, bad or without metrics."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    number = (
        F.when(key % 20 == 7, "")
        .when(key % 20 == 8, "n/a")
        .when(key % 20 == 9, (key + 1_000_000).cast("string"))
        .otherwise(key.cast("string"))
    )
    return s.select(
        F.create_map(F.lit("area_numbe"), number, F.lit("community"), F.col("s_name")).alias("properties"),
        F.concat(F.lit('{"type":"Point","coordinates":['), F.col("s_nationkey"), F.lit(",0]}")).alias(
            "geometry"
        ),
    )


REGIONS = """
g AS (
  SELECT s_suppkey, s_name AS community, s_nationkey,
         CASE s_suppkey % 20 WHEN 7 THEN '' WHEN 8 THEN 'n/a'
              WHEN 9 THEN (s_suppkey + 1000000)::varchar ELSE s_suppkey::varchar END AS area_text
  FROM supplier)
"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views)
