"""From raw documents to token files, in five stages.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as
the next stage's documents; all but the last return the columns of their input, whatever others they have beside
those of ``documents``.

Defined results
    Null, empty and letterless texts have no language and go in the first stage. Null ids and sources pass: a null source is one of its own
    in the mix. Repeated rows are near-duplicates of one another, so one of them stays. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelens.llm import dac_tokens, es_mixing, simhash_ball, suffix_decontam, viterbi_langid
from outcomelens.llm.common import held_out, n_words, table
from outcomelens.session import materialise

#: A document whose language holds a smaller share of its words is rejected.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters and those of no clear language go."""
    model = viterbi_langid.learn(docs.filter(~held_out(F.col("doc_id"))))
    found = viterbi_langid.identify(docs, model)
    clear = (F.col("lang_pred") != viterbi_langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(clear).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest id."""
    return simhash_ball.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    return suffix_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def letter_share(text: Column) -> Column:
    """Quality weight of a document: share of letters and spaces in its text."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L} ]", "")) / F.length(text)
    return F.when(F.length(text) > 0, plain).otherwise(F.lit(0.0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Sizes and weights are taken from the texts once and stored; the mix reads them several times.
    """
    text = F.col("text")
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id",
        "source",
        n_words(text).alias("size"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"),
        letter_share(text).alias("weight"),
    )
    columns = {name: F.col(f"doc.{name}") for name in ("size", "tie", "weight")}
    mixed = es_mixing.mix(materialise(sized, "sized"), **columns)
    times = mixed.filter(F.col("times") > 0).select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return times.select("doc.row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold per document."""
    return dac_tokens.tokens_of(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

#: No SQL: language models, SimHash and byte-pair codes have no SQL form. Tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
