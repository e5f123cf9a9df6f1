"""Mix sources to target weights by weighted sampling without replacement.

Every source gets a target in words from its weight (see :func:`source_targets`). Whole
epochs of a source come first; the rest of its target is filled with a weighted sample
(Efraimidis and Spirakis): a document's key is ``-ln(u) / weight`` with ``u`` a hash of its
id, and documents are taken in ascending key order until their running size reaches the
rest. The last one is taken if at least half of it fits, so a source misses its target by at
most half of one document.

No source is sorted as a whole. Keys fall into ranges; the ranges' sums tell the one range
per source in which the budget ends, and only its rows are ordered. Rows of lower ranges are
all taken, rows of higher ranges are not.

Defined results
    null text: size 0. Null source: a source of its own, last in order. Weight null or NaN:
    1; weight zero or below: taken after all others. Null ids share one key. Repeated rows
    count one by one; rows equal in id, size and text are interchangeable. Empty table: no
    rows. A source of size 0 has target 0. Extra columns pass through whatever their name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelens.functions.hashing import HASH_SIZE, stable_hash
from outcomelens.llm.common import n_words, packed, query, table
from outcomelens.session import materialise

SALT = "mix"
#: Ranges of keys per source. Any number gives the same result.
RANGES = 65_536
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential variable of rate ``weight``, the same on every run."""
    u = (stable_hash(F.coalesce(doc_id.cast("string"), F.lit("")), salt=SALT) + 0.5) / F.lit(float(HASH_SIZE))
    w = F.when(weight.isNull() | F.isnan(weight), F.lit(1.0)).otherwise(weight)
    return F.when(w > 0, -F.ln(u) / w).otherwise(F.lit(float("inf")))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """Columns source, source_size, target from one row (source, source_size) per source.

    Sources in code point order, null last, take the weights in turn. They share ``share``
    times the whole size by weight; none gets more than ``most_epochs`` times its own size, and
    what is cut off is shared again by weight. In ascending order of cap per weight the first
    k sources are capped, so one running sum finds the level of the others. The windows run
    over one row per source, never over documents.
    """
    if share > most_epochs:
        raise ValueError("share must not exceed most_epochs")
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1
    )
    ranked = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * most_epochs)
    order = [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    levels = ranked.withColumn("level", left / rest)
    level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct(F.col("cap") / F.col("w"), "level")))
    return levels.withColumn("level", level.over(everything)["level"]).select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    tie: Column | None = None,
    weight: Column | None = None,
    weights: Sequence[int] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    ranges: int = RANGES,
) -> DataFrame:
    """One row per document: ``doc`` (the whole input row) with size, source_size, target, times, taken.

    ``docs`` is read twice, so it should be stored. ``weight`` is the quality weight of a
    document; ``tie`` orders documents of one id and size.
    """
    inner = packed(docs, source=source).select(
        "doc",
        "source",
        (size if size is not None else n_words(F.col("doc.text"))).alias("size"),
        (tie if tie is not None else F.xxhash64(F.coalesce(F.col("doc.text"), F.lit("")))).alias("tie"),
        sampling_key(F.col(f"doc.`{doc_id}`"), weight if weight is not None else F.lit(1.0)).alias("key"),
    )
    # Ranges of about equal probability for weights near 1; the last one also holds infinity.
    keyed = inner.withColumn(
        "range", F.least(F.floor((1.0 - F.exp(-F.col("key"))) * ranges), F.lit(ranges - 1)).cast("long")
    )
    cells = materialise(keyed.groupBy("source", "range").agg(F.sum("size").alias("cell")), "cells")
    totals = cells.groupBy("source").agg(F.sum("cell").alias("source_size"))
    targets = (
        source_targets(totals, weights, share, most_epochs)
        .withColumn(
            "epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        )
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    # The range in which a source's rest ends: one row per source.
    lower = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    below = cells.withColumn("below", F.coalesce(F.sum("cell").over(lower), F.lit(0)))
    same = F.col("t.source").eqNullSafe(F.col("c.source"))
    opened = (
        below.alias("c")
        .join(targets.alias("t"), same)
        .groupBy("t.source", "source_size", "target", "epochs", "rest")
        .agg(
            F.max(F.when(F.col("below") <= F.col("rest"), F.struct("range", "below"))).alias("open"),
        )
    )
    cuts = materialise(
        opened.select("source", "source_size", "target", "epochs", "rest", "open.range", "open.below"), "cuts"
    )
    rows = keyed.alias("k").join(
        cuts.withColumnsRenamed({"range": "open", "source": "cut_source"}),
        F.col("source").eqNullSafe(F.col("cut_source")),
    )
    out = ["doc", "size", "source_size", "target", "epochs"]
    clear = rows.filter(F.col("range") != F.col("open")).select(
        *out, (F.col("range") < F.col("open")).alias("chosen")
    )
    inside = W.partitionBy("cut_source").orderBy("key", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("below") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    last = rows.filter(F.col("range") == F.col("open")).select(
        *out, (2 * before + F.col("size") <= 2 * F.col("rest")).alias("chosen")
    )
    times = F.col("epochs") + F.col("chosen").cast("long")
    return (
        clear.unionByName(last)
        .withColumn("times", F.least(times, F.lit(most_epochs)))
        .select("doc", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """Columns doc_id, weight: good documents 2, bad ones 0.5, in between for repeated labels."""
    return (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg(F.col("quality").cast("double")) * 1.5 + 0.5).alias("weight"))
    )


_SQL = f"""
WITH q AS (
  SELECT doc_id, avg(quality::double) * 1.5 + 0.5 AS weight
  FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT documents.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint AS size,
         -ln((('0x' || substr(md5('{SALT}|' || coalesce(documents.doc_id::varchar, '')), 1, 15))::bigint + 0.5)
             / {HASH_SIZE}::double) / coalesce(weight, 1.0) AS key
  FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id
), s AS (
  SELECT source, sum(size)::bigint AS source_size, 2 * sum(size)::bigint AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM s WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         least(cap::double, coalesce((SELECT min_by(level, cap / w) FROM l WHERE level <= cap / w) * w, cap)) AS target
  FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t
), p AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       (size * least(epochs + (CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END), 2))::bigint AS taken
FROM p
"""


@query("op10_source_mix", _SQL)
def op10_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    weighted = materialise(sized.join(quality_weights(table(spark, sf_dir, "labels")), "doc_id", "left"), "sized")
    mixed = mix(weighted, size=F.col("doc.size"), tie=F.col("doc.tie"), weight=F.col("doc.weight"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")
