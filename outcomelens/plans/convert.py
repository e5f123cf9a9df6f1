"""Raw CSV to Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from outcomelens.constants import RAW_COLUMNS
from outcomelens.operators.columns import select_wanted
from outcomelens.sources.readers import read_raw_csv
from outcomelens.sources.writers import write_parquet


def convert_csv(
    spark: SparkSession,
    source: str,
    target: str,
    wanted: Sequence[str] = RAW_COLUMNS,
    schema: T.StructType | None = None,
) -> int:
    """Write the wanted columns as Parquet; returns the row count."""
    raw = read_raw_csv(spark, source, schema)
    return write_parquet(select_wanted(raw, wanted), target)
