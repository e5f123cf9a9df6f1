"""Text to typed values; anything unreadable becomes null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from outcomelens.constants import FALSE_WORDS, TIMESTAMP_PATTERNS, TRUE_WORDS


_DIGITS = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"\d{2}",
    "dd": r"\d{2}",
    "HH": r"\d{2}",
    "hh": r"\d{2}",
    "mm": r"\d{2}",
    "ss": r"\d{2}",
    "a": r".+",
}


def _shape(pattern: str) -> str | None:
    """A regular expression every text readable by ``pattern`` matches, if one is known."""
    out = []
    for quote, letters, other in re.findall(r"'([^']*)'|([A-Za-z]+)|([^A-Za-z'])", pattern):
        if letters and letters not in _DIGITS:
            return None
        out.append(_DIGITS[letters] if letters else re.escape(quote or other))
    return f"^{''.join(out)}$"


def parse_timestamp(col: Column, patterns: tuple[str, ...] = TIMESTAMP_PATTERNS) -> Column:
    """ISO first, then each pattern; the first success wins.

    A pattern is only tried on text of its shape: a failed attempt costs an
    exception, and most rows fail most patterns.
    """
    tries = [F.try_to_timestamp(col)]
    for p in patterns:
        shape, attempt = _shape(p), F.try_to_timestamp(col, F.lit(p))
        tries.append(attempt if shape is None else F.when(col.rlike(shape), attempt))
    return F.coalesce(*tries)


def parse_flag(col: Column) -> Column:
    """Boolean words to 1 / 0, any other text to null."""
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(1)).when(word.isin(*FALSE_WORDS), F.lit(0))


def strict_flag(col: Column) -> Column:
    """0/1 integer; a value that is neither a number nor a boolean fails the job."""
    return col.cast("int")


def to_number(col: Column, kind: str = "double") -> Column:
    """Numeric cast where bad text gives null."""
    return col.try_cast(kind)


def to_whole(col: Column, kind: str = "int") -> Column:
    """Whole number from a number or its text: 12, ``12``, ``12.0`` and `` 12 `` are 12, 12.5 is null.

    Files that were written where a key was missing hold whole keys with a decimal point.
    """
    number = F.trim(col.cast("string")).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast(kind))


def numeric_then_text(col: Column) -> list[Column]:
    """Sort key: numbers in numeric order first, other text after them."""
    return [col.try_cast("int").asc_nulls_last(), col.asc()]
