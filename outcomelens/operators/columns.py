"""Column selection and naming; nothing here touches the rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.functions.parsing import to_whole

_WHOLE = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def quoted(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_name(name: str) -> str:
    """Lower case, runs of other characters to one ``_``, none at the ends."""
    lowered = name.replace("\ufeff", "").strip().lower()
    return re.sub(r"[^0-9a-z]+", "_", lowered).strip("_")


def normalize_names(df: DataFrame) -> DataFrame:
    names = [normalize_name(c) for c in df.columns]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"columns share a normalised name: {sorted(twice)}")
    return df.toDF(*names)


def select_wanted(
    df: DataFrame,
    wanted: Sequence[str],
    on_none: str = "all",
    rename: bool = False,
    normalize: bool = False,
) -> DataFrame:
    """Keep the wanted columns, matched without regard to case and outer blanks.

    ``normalize`` also treats blanks and punctuation alike. ``on_none``: ``all``
    keeps every column when none match, ``error`` raises. ``rename`` gives the
    kept columns the wanted spelling.
    """
    key = normalize_name if normalize else (lambda c: c.strip().lower())
    actual = {key(c): c for c in df.columns}
    found = [(actual[key(w)], w) for w in wanted if key(w) in actual]
    if found:
        return df.select(*[quoted(c).alias(w if rename else c) for c, w in found])
    if on_none == "error":
        raise ValueError(f"none of the expected columns found; got {df.columns}")
    return df


def resolve_column(df: DataFrame, aliases: Iterable[str], required: bool = True) -> str | None:
    """The first alias that is a column."""
    names = tuple(aliases)
    for name in names:
        if name in df.columns:
            return name
    if required:
        raise ValueError(f"none of {names} among {df.columns[:20]}")
    return None


def select_aliased(
    df: DataFrame,
    aliases: Mapping[str, Iterable[str]],
    types: Mapping[str, str],
    required: Iterable[str] = (),
    absent: str = "null",
) -> DataFrame:
    """One column per logical name, from its first present alias.

    Values are cast leniently to ``types``. An absent optional column is a typed
    null (``absent='null'``) or left out (``absent='drop'``).
    """
    must = set(required)
    out = []
    for logical, names in aliases.items():
        actual = resolve_column(df, names, logical in must)
        kind = types[logical]
        if actual is not None:
            out.append(lenient(quoted(actual), kind).alias(logical))
        elif absent == "null":
            out.append(F.lit(None).cast(kind).alias(logical))
    return df.select(*out)


def lenient(col: Column, kind: str) -> Column:
    """Cast where bad values give null; a whole type takes whole numbers of any spelling."""
    return to_whole(col, kind) if kind in _WHOLE else col.try_cast(kind)


def keep_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, in the named order."""
    return df.select(*[quoted(c) for c in names if c in df.columns])


def drop_helpers(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def coerce_numeric(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Lenient numeric casts; text that is no number (for a whole type: no whole number) becomes null."""
    present = {c: lenient(quoted(c), k) for c, k in kinds.items() if c in df.columns}
    return df.withColumns(present)


def tag_rows(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))
