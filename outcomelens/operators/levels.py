"""Levels of categorical columns as a table, and one-hot vectors made from it.

A column may have more levels than a driver should hold. Its levels are counted, numbered by falling frequency (ties by
text) in ranges, and stored: one row (column, level, n, slot) each. Slots of all columns
follow one another, so a slot is the level's place in the assembled vector. Rows get their
slots by a join that splits off frequent levels; the driver learns only how many levels each column has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.operators.columns import quoted
from outcomelens.operators.joins import BROADCAST_ROWS, attach
from outcomelens.operators.ranks import number_rows

SLOT = "__slot_{}"


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored rows (column, level, n, slot); nulls are no level.

    ``column`` is the position in ``columns``. Slots count from 0 through all columns.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column int, level string, n long, slot long")
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), quoted(c).cast("string").alias("level")) for i, c in enumerate(columns)])
    counted = (
        df.select(F.inline(pairs))
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.col("column").asc(), F.col("n").desc(), F.col("level").asc()]
    return number_rows(counted, order, "slot").withColumn("slot", F.col("slot") - 1)


def attach_slots(
    df: DataFrame,
    levels: DataFrame,
    columns: Sequence[str],
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``__slot_<i>`` for the i-th column: the slot of the row's level, null if it has none."""
    for i, name in enumerate(columns):
        key = f"__level_{i}"
        own = levels.filter(F.col("column") == i).select(F.col("level").alias(key), F.col("slot").alias(SLOT.format(i)), "n")
        df = df.withColumn(key, quoted(name).cast("string"))
        df = attach(df, own, key, [SLOT.format(i)], "n", spread_by, broadcast_rows, stored=True).drop(key)
    return df


def add_one_hot(
    df: DataFrame,
    levels: DataFrame,
    width: int,
    columns: Sequence[str],
    numeric: Sequence[str] = (),
    out: str = "features",
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add a sparse vector: one 1.0 per known level, then the numbers as they are.

    ``width`` is the number of levels. A level outside the table has no slot. A row that lacks a
    number is left out.
    """
    for c in numeric:
        df = df.filter(quoted(c).isNotNull() & ~F.isnan(quoted(c).cast("double")))
    df = attach_slots(df, levels, columns, spread_by, broadcast_rows)
    slots = F.array(*[F.col(SLOT.format(i)).cast("int") for i in range(len(columns))]).cast("array<int>")
    hot = F.filter(slots, lambda s: s.isNotNull())  # ascending: columns follow one another
    numbers = F.array(*[quoted(c).cast("double") for c in numeric]).cast("array<double>")
    places = F.array(*[F.lit(width + j) for j in range(len(numeric))]).cast("array<int>")
    vector = sparse_vector(
        F.lit(width + len(numeric)),
        F.concat(hot, places),
        F.concat(F.transform(hot, lambda s: F.lit(1.0)), numbers),
    )
    return df.withColumn(out, vector).drop(*[SLOT.format(i) for i in range(len(columns))])


def sparse_vector(size, indices, values):
    """A vector column from ascending indices and their values, without a Python function.

    Spark has no cast to a vector, but reads one from the JSON of its fields.
    """
    fields = F.struct(
        F.lit(0).alias("type"), size.alias("size"), indices.alias("indices"), values.alias("values")
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]


def vector_entries(vector):
    """Array of (slot, value) of a vector column, sparse or dense, without a Python function."""
    kind = "v struct<type tinyint, size int, indices array<int>, values array<double>>"
    fields = F.from_json(F.to_json(F.struct(vector.alias("v"))), kind)["v"]
    slots = F.coalesce(fields["indices"], F.sequence(F.lit(0), F.size(fields["values"]) - 1))
    return F.arrays_zip(slots.alias("slot"), fields["values"].alias("value"))
