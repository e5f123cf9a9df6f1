"""Joining a per-key table back to the rows it came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.operators.columns import quoted
from outcomelens.session import materialise

BROADCAST_ROWS = 200_000
BROADCAST_KEY_BYTES = 32 << 20
HOT_KEYS = 1_000
SPREAD = 1_024


def attach_counts(
    df: DataFrame,
    table: DataFrame,
    key: str,
    count: str,
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of ``table`` (one row per ``key`` with its row ``count``) to ``df``; see :func:`attach`."""
    return attach(df, table, key, [count], count, spread_by, broadcast_rows)


def attach(
    df: DataFrame,
    table: DataFrame,
    key: str,
    values: Sequence[str],
    count: str,
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Left join of ``values`` from ``table`` (one row per ``key`` with its row ``count``) to ``df``.

    The table is written once, unless ``stored`` says that it is, and its size taken: up to ``broadcast_rows`` rows and
    ``BROADCAST_KEY_BYTES`` of key text it is broadcast and ``df`` is not shuffled at all. A larger one is joined by a
    shuffle in which no task gets a hot key whole: keys holding at least one in
    ``HOT_KEYS`` of all rows (so never more than ``HOT_KEYS`` of them) are
    broadcast, and their rows, like those with a null key, are spread by a hash of
    ``spread_by`` (default: all columns).
    """
    wanted = list(dict.fromkeys([*values, count]))
    table = table.select(quoted(key), *[quoted(c) for c in wanted])
    if not stored:
        table = materialise(table, "counts")
    size = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(quoted(key).cast("string"))), F.lit(0)).alias("key_bytes"),
    ).first()
    if size.rows <= broadcast_rows and size.key_bytes <= BROADCAST_KEY_BYTES:
        return df.join(F.broadcast(table.select(quoted(key), *[quoted(c) for c in values])), key, "left")

    total = table.agg(F.sum(quoted(count))).scalar()
    is_hot = quoted(count) * F.lit(HOT_KEYS) >= total
    held = {c: f"__hot_{i}" for i, c in enumerate(values)}
    hot = table.filter(is_hot).select(quoted(key), F.lit(True).alias("__hot"), *[quoted(c).alias(h) for c, h in held.items()])
    hot_bytes = hot.agg(F.coalesce(F.sum(F.octet_length(quoted(key).cast("string"))), F.lit(0)).alias("b")).first().b
    if hot_bytes <= BROADCAST_KEY_BYTES:
        hot = F.broadcast(hot)  # else Spark's own skew handling has to do
    cold = table.filter(~is_hot).select(quoted(key), *[quoted(c) for c in values], F.lit(0).alias("__spread"))

    by = [quoted(c) for c in (spread_by or df.columns)]
    scattered = F.lit(1) + F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int")
    marked = df.join(hot, key, "left").withColumn(
        "__spread",
        F.when(F.col("__hot").isNotNull() | quoted(key).isNull(), scattered).otherwise(0),
    )
    joined = marked.join(cold, [key, "__spread"], "left")
    return joined.withColumns({c: F.coalesce(F.col(h), quoted(c)) for c, h in held.items()}).drop(
        "__hot", "__spread", *held.values()
    )
