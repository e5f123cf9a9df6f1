"""Parquet, CSV, JSON, model and feature-line writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.operators.ranks import RANGE_ROWS, number_rows
from outcomelens.session import materialise


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite ``path``; returns the row count, read from the new files' footers.

    ``df`` is computed once. (An ``Observation`` would save the footer read, but it
    leaves the session in a state in which Spark 4.1 cannot ship a freshly fitted
    logistic model to its tasks.)
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    order_by: Sequence[str | Column] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Headered CSV, overwrite; blanks inside values are kept.

    ``single_file`` is for small report tables only: they are gathered and then
    sorted, so that the file is in order.
    """
    out = gather(df) if single_file else df
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    writer = (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_ordered_csv(
    df: DataFrame, path: str, order_by: Sequence[Column], header: str = "each", rows_per_file: int = RANGE_ROWS
) -> None:
    """CSV in one order over as many files as the table needs; files follow one another by name.

    Rows are dealt into ascending ranges, so nothing is gathered. ``header``: ``each`` file has one, as
    Spark's reader wants it, or the ``first`` only, so that the files can be strung together.
    """
    stored = materialise(df, "ordered")
    files = max(1, -(-stored.count() // rows_per_file))
    rows = stored.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by)
    if header == "each":
        write_csv(rows, path)
        return
    if header != "first":
        raise ValueError(f"unknown header: {header}")
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    head = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    lines = rows.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options).alias("value"))
    # Files are numbered by the task that writes them: the header's partition comes first.
    head.coalesce(1).select(F.to_csv(F.struct("*"), options).alias("value")).union(lines).write.mode("overwrite").text(path)


def write_json_row(spark: SparkSession, row: Mapping[str, object], schema: T.StructType, path: str) -> None:
    """One-row JSON file, overwrite."""
    values = tuple(row.get(f.name) for f in schema.fields)
    spark.createDataFrame([values], schema).coalesce(1).write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, overwrite."""
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_lines(df: DataFrame, property_cols: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature per row as text; the columns become its properties.

    ``geometry`` holds JSON text (or null) and is embedded as it is.
    """
    props = F.to_json(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in property_cols]), {"ignoreNullFields": "false"}
    )
    shape = F.coalesce(F.col(geometry), F.lit("null"))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), shape, F.lit("}")
        ).alias("value")
    )


def write_feature_lines(
    df: DataFrame, path: str, property_cols: Sequence[str], geometry: str = "geometry"
) -> None:
    feature_lines(df, property_cols, geometry).write.mode("overwrite").text(path)


def write_feature_collections(
    df: DataFrame,
    path: str,
    property_cols: Sequence[str],
    geometry: str = "geometry",
    per_file: int = 100_000,
) -> None:
    """FeatureCollection documents of at most ``per_file`` features, each a file in a folder of its own.

    A task holds one line of a file at a time: features are lines between a first and a last line.
    """
    lines = feature_lines(df, property_cols, geometry).withColumn("at", F.monotonically_increasing_id())
    numbered = number_rows(lines, [F.asc("at")], "place").drop("at")
    inside = F.pmod(F.col("place") - 1, F.lit(per_file))
    placed = numbered.select(
        F.expr(f"(place - 1) div {per_file}").alias("file"),
        inside.alias("at"),
        F.concat(F.when(inside > 0, F.lit(",")).otherwise(F.lit("")), F.col("value")).alias("value"),
    )
    ends = F.array(
        F.struct(F.lit(-1).cast("long").alias("at"), F.lit('{"type":"FeatureCollection","features":[').alias("value")),
        F.struct(F.lit(per_file).cast("long").alias("at"), F.lit("]}").alias("value")),
    )
    framed = placed.unionByName(placed.select("file").distinct().select("file", F.inline(ends)))
    files = framed.repartition("file").sortWithinPartitions("file", "at").drop("at")
    files.write.partitionBy("file").mode("overwrite").text(path)


def spread(df: DataFrame, partitions: int, keys: Sequence[str] = ()) -> DataFrame:
    """Set the number of partitions before a wide write or a training run."""
    return df.repartition(partitions, *keys)


def gather(df: DataFrame) -> DataFrame:
    """One partition, for small report tables.

    A shuffle, not ``coalesce(1)``: the stage that computes the table keeps its tasks.
    """
    return df.repartition(1)
