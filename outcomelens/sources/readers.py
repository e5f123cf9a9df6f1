"""CSV, Parquet and GeoJSON readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.operators.columns import quoted
from outcomelens.sources.features import feature_texts

_FEATURE = T.StructType(
    [
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StringType()),
    ]
)


def _text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV as text; doubled quotes inside quoted fields are quotes."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _by_header(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """The file's column for each wanted name; marks and line ends around header names do not count."""
    found = {c.replace("\ufeff", "").strip(): c for c in df.columns}
    absent = [n for n in names if n.strip() not in found]
    if absent:
        raise ValueError(f"columns absent from the header: {absent}; it has {sorted(found)}")
    return {n: found[n.strip()] for n in names}


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV with every column as text.

    With ``schema`` its columns are taken by their name in the header, in the schema's order.
    """
    df = _text_csv(spark, path)
    if schema is None:
        return df
    actual = _by_header(df, schema.fieldNames())
    return df.select(*[quoted(actual[n]).alias(n) for n in schema.fieldNames()])


def read_csv_typed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Headered CSV with a given schema; columns are matched by name.

    Further columns of the file are left out, an absent one is an error, and a value that
    does not fit its type is null. A byte-order mark in the header and carriage returns left at
    line ends do not reach the values.
    """
    df = _text_csv(spark, path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    actual = _by_header(df, wanted.fieldNames())
    out = []
    for f in wanted.fields:
        text = F.regexp_replace(quoted(actual[f.name]), r"\s+$", "")
        typed = text if isinstance(f.dataType, T.StringType) else F.trim(text).try_cast(f.dataType)
        out.append(typed.alias(f.name))
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_geojson(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Region features: ``properties`` map and ``geometry`` as JSON text.

    ``lines``: one feature per line, as :func:`writers.write_feature_lines` writes
    it. ``document``: each file is a FeatureCollection, of any size; see :mod:`outcomelens.sources.features`.
    """
    if layout == "lines":
        texts = spark.read.text(path).withColumnRenamed("value", "text")
    elif layout == "document":
        texts = feature_texts(spark, path)
    else:
        raise ValueError(f"unknown layout: {layout}")
    return texts.select(F.from_json("text", _FEATURE).alias("f")).select("f.*")
