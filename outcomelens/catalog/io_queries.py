"""Round trips through the readers and writers, in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.catalog import query
from outcomelens.catalog.metric_queries import AUC, CELLS, PR_AUC, ranks_sql
from outcomelens.catalog.rate_queries import dated
from outcomelens.catalog.tables import (
    HOURLY,
    RAW,
    REGIONS,
    hourly,
    raw_text,
    regions,
    rounded,
    table,
    with_views,
)
from outcomelens.operators import metrics as M
from outcomelens.operators import rates as R
from outcomelens.operators import regions as G
from outcomelens.operators.columns import normalize_names
from outcomelens.plans.convert import convert_csv
from outcomelens.plans.linear import SUMMARY_SCHEMA
from outcomelens.session import scratch_path
from outcomelens.operators.ranks import number_rows
from outcomelens.sources import readers as RD
from outcomelens.sources import writers as WR

_H = with_views(HOURLY)
_R = with_views(RAW)


@query(
    "io01_raw_csv",
    _R
    + """SELECT id, case_number, date, block, iucr, primary_type, description, location_description,
    arrest, domestic, beat, district, ward, community_area, fbi_code, value::varchar AS extra FROM r""",
)
def io01(spark, sf):
    path = scratch_path(spark, "raw")
    WR.write_csv(raw_text(spark, sf), path)
    return normalize_names(RD.read_raw_csv(spark, path))


@query(
    "io01_csv_to_parquet_job",
    _R
    + """SELECT id, case_number, date, block, iucr, primary_type, description, location_description,
    arrest, domestic, beat, district, ward, community_area, (SELECT count(*) FROM r) AS written FROM r""",
)
def io01_job(spark, sf):
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "converted")
    raw = raw_text(spark, sf)
    WR.write_csv(raw, source)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in raw.columns])
    written = convert_csv(spark, source, target, schema=schema)
    return normalize_names(RD.read_parquet(spark, target)).withColumn("written", F.lit(written))


@query("io02_typed_csv", _H + "SELECT id, label, area, value, block FROM h")
def io02(spark, sf):
    path = scratch_path(spark, "typed")
    WR.write_csv(hourly(spark, sf).select("id", "label", "area", "value", "block"), path)
    return RD.read_csv_typed(spark, path, "id long, label int, area int, value double, block string")


@query("io02_reordered_header", _H + "SELECT id, label, area, value, block FROM h")
def io02_reordered(spark, sf):
    """Columns are found by name, and one that nobody asked for does not matter."""
    path = scratch_path(spark, "reordered")
    WR.write_csv(hourly(spark, sf).select("block", "value", "beat", "id", "area", "label"), path)
    return RD.read_csv_typed(spark, path, "id long, label int, area int, value double, block string")


_QUOTED = """CASE event_id % 3 WHEN 0 THEN 'a "' || event_type || '", b' WHEN 1 THEN event_type || ', "' ELSE event_type END"""


@query("io02_quotes", f"SELECT event_id, {_QUOTED} AS note, value FROM events")
def io02_quotes(spark, sf):
    """Quotes and commas inside fields survive a round trip."""
    kind = F.col("event_type")
    note = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('a "'), kind, F.lit('", b')))
        .when(F.col("event_id") % 3 == 1, F.concat(kind, F.lit(', "')))
        .otherwise(kind)
    )
    path = scratch_path(spark, "quotes")
    WR.write_csv(table(spark, sf, "events").select("event_id", note.alias("note"), "value"), path)
    return RD.read_csv_typed(spark, path, "event_id long, note string, value double")


@query(
    "io03_parquet_scan",
    "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 100",
)
def io03(spark, sf):
    events = RD.read_parquet(spark, f"{sf}/events.parquet")
    return events.filter("event_type = 'purchase' and value > 100").select("event_id", "value")


@query(
    "io04_geojson",
    with_views(REGIONS)
    + """SELECT area_text AS area_key, community,
    '{"type":"Point","coordinates":[' || s_nationkey || ',0]}' AS geometry FROM g""",
)
def io04(spark, sf):
    path = scratch_path(spark, "features")
    named = G.feature_columns(regions(spark, sf), {"area_numbe": "area_numbe", "community": "community"})
    WR.write_feature_lines(named, path, ["area_numbe", "community"])
    read = RD.read_geojson(spark, path, layout="lines")
    return G.feature_columns(read, {"area_key": "area_numbe", "community": "community"}).select(
        "area_key", "community", "geometry"
    )


@query(
    "io04_geojson_document",
    with_views(REGIONS)
    + """SELECT area_text AS area_key, community,
    '{"type":"Point","coordinates":[' || s_nationkey || ',0]}' AS geometry FROM g""",
)
def io04_document(spark, sf):
    """Features in FeatureCollection documents, read back in byte ranges."""
    named = G.feature_columns(regions(spark, sf), {"area_numbe": "area_numbe", "community": "community"})
    path = scratch_path(spark, "collection")
    WR.write_feature_collections(named, path, ["area_numbe", "community"], per_file=40)
    read = RD.read_geojson(spark, path)
    return G.feature_columns(read, {"area_key": "area_numbe", "community": "community"}).select(
        "area_key", "community", "geometry"
    )


@query(
    "io05_parquet_write",
    _H + "SELECT id, label, area, primary_type, (SELECT count(*) FROM h) AS written FROM h",
)
def io05(spark, sf):
    path = scratch_path(spark, "parquet")
    df = hourly(spark, sf).select("id", "label", "area", "primary_type")
    written = WR.write_parquet(df, path, partition_by=["primary_type"])
    back = spark.read.schema("id long, label int, area int, primary_type string").parquet(path)
    return back.withColumn("written", F.lit(written))


@query(
    "io06_csv_report",
    _H + 'SELECT "Hour", round(avg(label) * 100, 6) AS rate_pct, 1::bigint AS files FROM h GROUP BY "Hour"',
)
def io06(spark, sf):
    path = scratch_path(spark, "report")
    report = rounded(R.outcome_rate(dated(spark, sf), ["Hour"], "label"))
    WR.write_csv(report, path, single_file=True, order_by=["Hour"])
    back = RD.read_csv_typed(spark, path, "Hour int, rate_pct double")
    return back.withColumn("files", F.lit(len(back.inputFiles())).cast("long"))


@query(
    "io06_ordered_parts",
    _H
    + """, t AS (SELECT area, count(*) AS n, round(avg(score), 6) AS mean_score FROM h GROUP BY area)
    SELECT area, n, mean_score, row_number() OVER (ORDER BY mean_score DESC, area) AS line FROM t""",
)
def io06_parts(spark, sf):
    """A table in order over several files; the lines counted through the files in the order of their names."""
    path = scratch_path(spark, "ordered")
    by_area = rounded(hourly(spark, sf).groupBy("area").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score")))
    WR.write_ordered_csv(by_area, path, [F.desc("mean_score"), F.asc("area")], rows_per_file=20)
    back = spark.read.schema("area int, n long, mean_score double").option("header", True).csv(path)
    file = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("int")
    placed = back.select("*", file.alias("file"), F.monotonically_increasing_id().alias("at"))
    return number_rows(placed, [F.col("file").asc(), F.col("at").asc()], "line").drop("file", "at")


@query(
    "io07_summary_json",
    _H
    + ranks_sql("h")
    + f""", c AS (SELECT {CELLS} FROM h)
    SELECT round((SELECT {AUC} FROM s), 6) AS roc_auc, round((SELECT {PR_AUC} FROM s), 6) AS pr_auc,
    round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, tp, tn, fp, fn,
    'events' AS input_path, 'summary' AS output_dir, '2024-01-31 12:00:00' AS "timestamp", 1.5::double AS runtime_min FROM c""",
)
def io07(spark, sf):
    """The job's summary row, all eleven fields, written and read back."""
    path = scratch_path(spark, "summary")
    row = M.run_metrics(hourly(spark, sf)).first().asDict() | {
        "input_path": "events",
        "output_dir": "summary",
        "timestamp": "2024-01-31 12:00:00",
        "runtime_min": 1.5,
    }
    WR.write_json_row(spark, row, SUMMARY_SCHEMA, path)
    return rounded(spark.read.schema(SUMMARY_SCHEMA).json(path))


@query(
    "io10_partition_control",
    "SELECT count(*) AS n_rows, 16::bigint AS spread_to, 1::bigint AS gathered_to FROM lineitem",
)
def io10(spark, sf):
    line = table(spark, sf, "lineitem").select("l_linestatus")
    wide = WR.spread(line, 16)
    small = WR.gather(line.groupBy("l_linestatus").agg(F.count("*").alias("n")))  # one row per status
    parts = wide.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    gathered = small.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p")).scalar()
    return parts.agg(F.sum("n").alias("n_rows"), F.count("*").alias("spread_to")).withColumn(
        "gathered_to", gathered
    )
