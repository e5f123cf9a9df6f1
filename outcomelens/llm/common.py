"""What the corpus operators share: tables, shared files, worker set-up."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Rows of one Arrow batch; texts may be long, so batches are kept short.
BATCH_ROWS = 200
BATCH_BYTES = 16 << 20

#: The white space that separates words wherever the contracts say ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its twin."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Short Arrow batches, and workers that can import this package from a shared path.

    On a cluster without a shared installation the package is sent with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*filter(None, paths), root])


def packed(df: DataFrame, carry: Sequence[str] | None = None, **needed: str) -> DataFrame:
    """The row (or its ``carry`` columns) as one struct ``doc`` beside the named inputs.

    So no column of the input clashes with one of the operator's.
    """
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("doc"),
        *[F.col(f"`{c}`").alias(name) for name, c in needed.items()],
    )


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column) -> Column:
    """0, 1 or 2; rows of fold 1 are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors reach."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives empty bytes."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
