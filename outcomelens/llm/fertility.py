"""Quality rules from a public tokenizer's fertility, beside fixed base rules.

Per document: characters per token, share of byte-fallback tokens, and entropy of its tokens in bits. The bands
are learned per language from the whole table: the middle and spread (a robust deviation from the
quartiles) of each measure. Documents of equal measures count once, so that copies do not narrow a band, and a band
has a least width. Text with fewer characters per token than its language gives (signs, capitals, broken words), far
more of them, many unknown characters, or little variety falls outside.

Languages are those of the ``lang`` column, null included; a language with fewer than ``LEAST_DOCS`` different measures
takes the widest limits of the others. There is one row of bands per language, so they are joined without moving
the documents when they are small, as Spark decides.

Defined results
    Null or blank text: no words, every base measure 0, base_failed, not kept; such texts and other base failures do not shape
    the bands. Documents are not joined or grouped by id: null ids and repeated rows keep their rows. Empty table: no rows. Extra
    columns pass through whatever their name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import packed, prepare, query, table
from outcomelens.session import materialise

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
#: Deviations allowed below and above the middle.
BELOW, ABOVE = 4.0, 8.0
#: Least deviation: characters per token (share of the middle), entropy (bits), byte share.
LEAST_CPT, LEAST_ENTROPY, LEAST_BYTES = 0.02, 0.25, 0.0125
LEAST_DOCS = 10
CACHE_WORDS = 600_000
LONGEST_CACHED = 64


def base_measures(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """Code points in words, symbols, repeated lines, words in repeated three-word windows."""
    chars = len(text) - sum(text.count(c) for c in _SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pair = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
        _, window, count = np.unique(pair * len(number) + ids[2:], return_inverse=True, return_counts=True)
        twice = np.concatenate((count[window] > 1, [False, False]))
        repeated = int((twice | np.roll(twice, 1) | np.roll(twice, 2)).sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


class Fertility:
    """Pieces of words of a sentencepiece vocabulary; pieces never reach over white space."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.is_byte = np.array([self.library.is_byte(i) for i in range(size)])
        self.known: dict[bytes, bytes] = {}

    def measures(self, texts: list[list[bytes]]) -> list[tuple[int, float, float]]:
        """Tokens, byte-fallback share and entropy of each text."""
        if len(self.known) > CACHE_WORDS:
            for w in list(self.known)[: CACHE_WORDS // 2]:
                del self.known[w]
        new = list({w for words in texts for w in words} - self.known.keys())
        for w, ids in zip(new, self.library.encode([w.decode() for w in new], num_threads=1)):
            self.known[w] = np.array(ids, "<u4").tobytes()
        out = []
        for words in texts:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")
            if not len(ids):
                out.append((0, 0.0, 0.0))
                continue
            share = np.unique(ids, return_counts=True)[1] / len(ids)
            out.append((len(ids), float(self.is_byte[ids].mean()), float(max(0.0, -(share * np.log2(share)).sum()))))
        for w in new:
            if len(w) > LONGEST_CACHED:
                del self.known[w]
        return out


_LIBRARIES: dict[str, Fertility] = {}

_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, byte_share double, entropy double"
)


def measured(path: str):
    """A column function: base measures and fertility of a text."""

    @F.pandas_udf(_MEASURES)
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if path not in _LIBRARIES:
            _LIBRARIES[path] = Fertility(path)
        own = _LIBRARIES[path]
        names = [c.strip().split(" ")[0] for c in _MEASURES.split(",")]
        for batch in texts:
            plain = [t or "" for t in batch]
            words = [t.encode().split() for t in plain]
            rows = [
                (len(w), *base_measures(t, w), *m) for t, w, m in zip(plain, words, own.measures(words))
            ]
            yield pd.DataFrame(rows, columns=names)

    return measure


def bands(rows: DataFrame, language: str) -> DataFrame:
    """Per language (and, marked ``whole``, for all): limits of the three measures.

    Exact quartiles of measures rounded to thousandths, from counts per value.
    """
    measures = ["cpt", "entropy", "byte_share"]
    different = rows.select(language, "n_tokens", *[F.round(m, 3).alias(m) for m in measures]).distinct()
    each = F.struct(F.lit(False).alias("whole"), F.col(language).alias("lang"))
    everything = F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("lang"))
    values = different.select(F.explode(F.array(each, everything)).alias("of"), *measures).select(
        "of", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])).alias("v")
    )
    counts = values.groupBy("of.whole", "of.lang", "v.measure", "v.value").agg(F.count("*").alias("n"))
    quartiles = counts.groupBy("whole", "lang", "measure").agg(
        F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"), F.sum("n").alias("docs")
    )
    spread = (F.col("q")[2] - F.col("q")[0]) / 1.349
    least = (
        F.when(F.col("measure") == "cpt", F.col("q")[1] * LEAST_CPT)
        .when(F.col("measure") == "entropy", F.lit(LEAST_ENTROPY))
        .otherwise(F.lit(LEAST_BYTES))
    )
    limits = quartiles.select(
        "whole",
        "lang",
        "measure",
        "docs",
        (F.col("q")[1] - BELOW * F.greatest(spread, least)).alias("low"),
        (F.col("q")[1] + ABOVE * F.greatest(spread, least)).alias("high"),
    )

    def pick(measure: str, limit: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(limit)))

    return limits.groupBy("whole", "lang").agg(
        F.max("docs").alias("docs"),
        pick("cpt", "low").alias("cpt_low"),
        pick("cpt", "high").alias("cpt_high"),
        pick("entropy", "low").alias("entropy_low"),
        # Bytes are judged above only, by the smaller number of deviations.
        (pick("byte_share", "high") - (ABOVE - BELOW) * LEAST_BYTES).alias("bytes_high"),
    )


def judge(docs: DataFrame, path: str, text: str = "text", language: str = "lang", carry=None) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), the base measures, fertility measures, base_failed, kept."""
    prepare(docs.sparkSession)
    rows = packed(docs, carry, __text=text, __lang=language).select(
        "doc", F.col("__lang").cast("string").alias("language"), measured(path)("__text").alias("m")
    )
    rows = rows.select("doc", "language", "m.*").withColumns(
        {
            "cpt": F.when(F.col("n_tokens") > 0, F.col("word_chars") / F.col("n_tokens")).otherwise(0.0),
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        }
    )
    stored = materialise(rows, "measures")
    found = materialise(bands(stored.filter(~F.col("base_failed")), "language"), "bands")
    own = found.filter(~F.col("whole") & (F.col("docs") >= LEAST_DOCS)).drop("whole", "docs").withColumnRenamed("lang", "of")
    # One row: the widest limits of any language, or those of the whole table if no language is common.
    widest = own.agg(F.min("cpt_low"), F.max("cpt_high"), F.min("entropy_low"), F.max("bytes_high")).first()
    limits = ("cpt_low", "cpt_high", "entropy_low", "bytes_high")
    rare = dict(zip(limits, widest))
    if rare["cpt_low"] is None:
        every = found.filter("whole").first()
        rare = {c: every[c] if every else None for c in limits}
    joined = stored.join(own, F.col("language").eqNullSafe(F.col("of")), "left")
    limit = {c: F.coalesce(F.col(c), F.lit(rare[c]).cast("double")) for c in limits}
    inside = (
        F.col("cpt").between(limit["cpt_low"], limit["cpt_high"])
        & (F.col("entropy") >= limit["entropy_low"])
        & (F.col("byte_share") <= limit["bytes_high"])
    )
    return joined.select(
        "doc",
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"],
        F.col("cpt").alias("chars_per_token"),
        "byte_share",
        "entropy",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


@query("op4_fertility_rules")
def op4_fertility_rules(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return judge(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"]).select("doc.doc_id", "*").drop("doc")
