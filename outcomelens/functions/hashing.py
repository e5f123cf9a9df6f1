"""A stable hash of a row id: the same row gets the same number on every run and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 15
HASH_SIZE = 16**HASH_DIGITS


def stable_hash(*ids: Column, salt: str = "") -> Column:
    """Number in ``[0, 2**60)`` from the md5 of the id text.

    Choices that follow one another (thin, then split) need different salts, or
    the second would choose among the survivors of the first by the same number.
    """
    parts = [c.cast("string") for c in ids]
    if salt:
        parts.insert(0, F.lit(salt))
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def hash_below(hashed: Column, fraction: float) -> Column:
    """True for ``fraction`` of all hash values."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    return hashed < F.lit(int(fraction * HASH_SIZE))
