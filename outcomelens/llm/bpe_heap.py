"""Token counts by byte-pair merging on a heap and a linked list.

A piece starts as its bytes, the last of which carries the end-of-word mark. All adjacent pairs
with a rank wait in a heap; the lowest rank (leftmost among equals) is merged, its neighbours
form new pairs, and pairs that a merge destroyed are skipped when they surface. The number
of tokens is the number of initial symbols less the number of merges: no identifier is looked up or
emitted.

Pieces never reach over white space, so a text is normalised, cut at white space, and a worker keeps the
counts of the units it met (bounded by ``CACHE_UNITS``). The strings of special tokens count as one token
each, as the library does by default.

Defined results
    Null or empty text: 0 bytes, 0 tokens. Texts of any length are read whole. Documents are never joined or
    grouped, so null ids and repeated rows keep their rows. Extra columns pass through whatever
    their name. Empty table: no rows.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import packed, prepare, query, table

CACHE_UNITS = 1_000_000
LONGEST_CACHED = 64
LIMIT = 2048

_NOT_SPACE_HERE = regex.compile("[\x1c-\x1f]")  # Python splits at these, the library does not
_SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class MergeCounter:
    """Counts for a lower-casing byte-pair vocabulary with end-of-word marks (tokenizers JSON)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        # Symbols are numbered; a merge of two numbered symbols has a rank and a result.
        number: dict[str, int] = {}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            made = [number.setdefault(s, len(number)) for s in (a, b, a + b)]
            self.rank.setdefault((made[0], made[1]), (r, made[2]))
        shown = _byte_characters()
        self.inner = [number.get(shown[b], -1 - b) for b in range(256)]
        self.last = [number.get(shown[b] + self.end, -257 - b) for b in range(256)]
        self.known: dict[str, int] = {}

    def piece(self, raw: bytes) -> int:
        """Number of tokens of one piece."""
        n = len(raw)
        if n < 2:
            return n
        symbol = [self.inner[b] for b in raw]
        symbol[-1] = self.last[raw[-1]]
        rank = self.rank
        heap = [(found[0], i, found[1]) for i in range(n - 1) if (found := rank.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        before, after, merges = list(range(-1, n - 1)), list(range(1, n + 1)), 0
        while heap:
            r, left, made = heapq.heappop(heap)
            right = after[left]
            if symbol[left] is None or right >= n:
                continue
            found = rank.get((symbol[left], symbol[right]))
            if found is None or found[0] != r:
                continue
            symbol[left], symbol[right] = made, None
            merges += 1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                if found := rank.get((made, symbol[after[left]])):
                    heapq.heappush(heap, (found[0], left, found[1]))
            if before[left] >= 0 and (found := rank.get((symbol[before[left]], made))):
                heapq.heappush(heap, (found[0], before[left], found[1]))
        return n - merges

    def unit(self, text: str) -> int:
        return sum(self.piece(p.encode()) for p in self.pattern.findall(text))

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii():
            # Letter by letter: Python alone would look at a sigma's neighbours.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        units = _SPACES.split(text) if _NOT_SPACE_HERE.search(text) else text.split()
        known, total = self.known, 0
        for unit in units:
            n = known.get(unit)
            if n is None:
                n = self.unit(unit)
                if len(unit) <= LONGEST_CACHED:
                    known[unit] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self.known) > CACHE_UNITS:
            for unit in list(self.known)[: CACHE_UNITS // 2]:
                del self.known[unit]
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


def _byte_characters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """One counter per worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def token_count(path: str) -> Callable[[Column], Column]:
    """A column function: number of tokens of a text."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merge = counter(path)
        for batch in texts:
            yield pd.Series([merge.count(t) for t in batch], dtype="int64")

    return count


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT, carry=None) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), n_bytes, n_tokens, over_limit."""
    prepare(docs.sparkSession)
    rows = packed(docs, carry, __text=text)
    counted = rows.select(
        "doc",
        F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(path)(F.col("__text")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return counted.select("doc.doc_id", "n_bytes", "n_tokens", "over_limit")
