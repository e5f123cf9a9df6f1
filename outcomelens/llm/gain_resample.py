"""Importance resampling towards a target distribution.

Words come from an untrained pre-tokeniser: a Regex split over the ASCII-lowered text, which gives the
offsets of every word. A window of consecutive offset pairs is a feature, and its CRC-32 picks one of
``BUCKETS`` buckets. Two bucket histograms, of all raw documents and of all target texts, give each
bucket a gain (a thousandth of a log ratio); a document's weight is the floored mean of its features' gains.
Adding Gumbel noise that depends on the id only and keeping the highest scores draws without
replacement with probabilities proportional to ``exp(weight / 1000)``.

Texts are tokenised once: the documents' bucket codes (two bytes a feature) are stored beside them, and the
histogram and the weights are read from there. Histograms are summed in each task before anything is shuffled.
The draw is a cut in the histogram of scores, which are whole numbers in a range that does not grow with the
table (:func:`noise` and the logarithms bound it to some 120,000 values); only rows at or above the cut are
ordered, in ranges of (score, id) that are spread over tasks, so no task holds all drawn rows.

Defined results
    Null, empty and wordless texts: no features, weight 0; they are drawn only where ``least_words`` is 0. Null ids:
    kept; their noise is that of the empty id and they rank last among ties. Repeated rows have a rank each; rows equal in score
    and id are ranked in the order of the stored table. Texts are cut into pieces at delimiters while they are tokenised,
    so long texts need no more memory than their codes. Empty documents: no rows. Empty target: its histogram is zero.
    Extra columns pass through whatever their name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.llm.common import packed, prepare, query, table, texts_of
from outcomelens.session import materialise

BUCKETS = 10_000
LONGEST_RUN = 1
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: Characters tokenised at once; pieces end at delimiters.
PIECE = 1 << 16
#: Words a worker remembers the bucket of.
CACHED_WORDS = 200_000
#: Rows of one range of the draw.
RANGE_ROWS = 1_000_000

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DELIMITER = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


# ---- features --------------------------------------------------------------------------


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts that end at a delimiter, so that no word is cut."""
    at = 0
    while len(text) - at > size:
        found = _DELIMITER.search(text, at + size)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class Featurizer:
    """Bucket codes of a text's word runs; made once per task."""

    def __init__(self, shortest: int, longest: int, buckets: int) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.split = pre_tokenizers.Split(Regex(_WORD), behavior="removed", invert=True).pre_tokenize_str
        self.known: dict[str, int] = {}

    def _code(self, feature: str) -> int:
        code = self.known.get(feature)
        if code is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            code = self.known[feature] = zlib.crc32(feature.encode()) % self.buckets
        return code

    def codes(self, raw: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every run of consecutive words."""
        code, n_words, found = self._code, 0, []
        last: list[str] = []  # words that runs over the next piece begin with
        for piece in pieces(raw.lower().decode("utf-8", "replace")):  # bytes.lower() changes A-Z only
            pairs = [offsets for _, offsets in self.split(piece)]
            n_words += len(pairs)
            if self.longest == 1:
                found.extend([code(piece[a:b]) for a, b in pairs])
                continue
            words = [*last, *(piece[a:b] for a, b in pairs)]
            for n in range(self.shortest, self.longest + 1):
                first = max(0, len(last) - n + 1)  # runs inside the last piece are counted already
                found.extend([code(" ".join(words[i : i + n])) for i in range(first, len(words) - n + 1)])
            last = words[-(self.longest - 1) :]
        return n_words, np.array(found, np.int64)


def _code_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def features(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] | None = None,
    shortest: int = 1,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc``, n_words, n_features and ``codes``, the packed bucket numbers of all features."""
    prepare(docs.sparkSession)
    rows = packed(docs, carry, __text=text)
    kind = _code_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer(shortest, longest, buckets)
        for batch in batches:
            found = [made.codes(t) for t in texts_of(batch.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(c) for _, c in found], pa.int64()),
                    pa.array([c.astype(kind).tobytes() for _, c in found], pa.binary()),
                ],
                ["doc", "n_words", "n_features", "codes"],
            )

    schema = T.StructType(
        [
            rows.schema["doc"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("codes", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: one number per bucket, whatever the table."""
    kind = _code_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for codes in texts_of(batch.column("codes")):
                counts += np.bincount(np.frombuffer(codes, kind), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    summed = featured.select("codes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most ``buckets`` rows
        counts[row.bucket] = row.n
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored, per bucket."""
    s_all, t_all, n = float(raw.sum()), float(target.sum()), float(len(raw))
    ratios = (target + 1.0) * (s_all + n) / ((raw + 1.0) * (t_all + n))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def weights(featured: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc``, n_words, n_features and the floored mean gain."""
    kind = _code_type(len(gain))
    shared = featured.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [np.frombuffer(c, kind) for c in texts_of(batch.column("codes"))]
            weight = [int(own[c].sum()) // len(c) if len(c) else 0 for c in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "n_words", "n_features")), pa.array(weight, pa.int64())],
                ["doc", "n_words", "n_features", "weight"],
            )

    schema = T.StructType([f for f in featured.schema if f.name != "codes"] + [T.StructField("weight", T.LongType())])
    return featured.mapInArrow(run, schema)


# ---- draw ------------------------------------------------------------------------------


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, between -3,200 and 23,000, from the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000) * F.ln(-F.ln(u))).cast("long")


def highest(scored: DataFrame, wanted: Column, percent: int, doc_id: Column) -> DataFrame:
    """Add ``rank``: 1, 2, 3... for the highest ``percent`` of the wanted rows by score, null for all others.

    ``scored`` is a stored table with a whole-numbered ``score``.
    """
    spark = scored.sparkSession
    levels = scored.filter(wanted).groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    quota = percent * sum(r.n for r in levels) // 100
    above, cut = 0, None
    for row in levels:
        if above >= quota:
            break
        above, cut = above + row.n, row.score
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))

    inside = F.coalesce(wanted, F.lit(False)) & (F.col("score") >= cut)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-above // RANGE_ROWS))
    order = [F.desc("score"), doc_id.asc_nulls_last(), F.col("__row")]
    # The low bits of a generated id count the rows of a partition.
    placed = (
        scored.withColumn("__row", F.monotonically_increasing_id())
        .filter(inside)
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = materialise(placed, "drawn")
    sizes = {r["__part"]: r.n for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # one per range
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    heads = F.array(*[F.lit(before.get(p, 0)).cast("long") for p in range(max(sizes) + 1)])
    rank = F.get(heads, F.col("__part")) + F.col("__place") + 1
    drawn = placed.withColumn("rank", F.when(rank <= quota, rank)).select(*scored.columns, "rank")
    return drawn.unionByName(scored.filter(~inside).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    carry: Sequence[str] | None = None,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), n_words, n_features, weight, score and rank."""
    kept = list(carry or docs.columns)
    if doc_id not in kept:
        raise ValueError(f"{doc_id} must be among the carried columns")
    raw = materialise(features(docs, text, kept, 1, longest, buckets), "features")
    wanted = target.select(F.col(f"`{target_text}`").alias("text"), F.lit(0).alias("one"))
    gain = gains(histogram(raw, buckets), histogram(features(wanted, "text", ["one"], 1, longest, buckets), buckets))
    own = F.col(f"doc.`{doc_id}`")
    scored = materialise(weights(raw, gain).withColumn("score", F.col("weight") + noise(own, seed)), "scored")
    return highest(scored, F.col("n_words") >= least_words, percent, own)


# ---- the query -------------------------------------------------------------------------

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of a text's UTF-8 bytes from its table of 256 entries, which is itself derived here.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""


def crc_sql(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(0, length(hex(encode({text}))), 2),
    lambda i: ('0x' || substr(hex(encode({text})), i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295)"""


_SQL = f"""WITH tabs AS ({CRC_TABLE}),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD}') AS ws FROM documents),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all({_LOWER.format("text")}, '{_WORD}')) AS w FROM benchmark),
v AS (SELECT w, {crc_sql("w")} % {BUCKETS} AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw), tabs),
s AS (SELECT b, count(*) AS n FROM dw JOIN v USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN v USING (w) GROUP BY b),
g AS (SELECT s.b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((SELECT sum(n) FROM s) + {BUCKETS})::double
    / ((s.n + 1)::double * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::double)))::bigint AS gain
    FROM s LEFT JOIN t USING (b)),
m AS (SELECT doc_id, floor(sum(gain)::double / count(*))::bigint AS weight
    FROM dw JOIN v USING (w) JOIN g USING (b) GROUP BY doc_id),
x AS (SELECT doc_id, len(coalesce(ws, []))::bigint AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint AS h FROM d LEFT JOIN m USING (doc_id)),
y AS (SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
    FROM y WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * n // 100 THEN rank END AS rank
FROM y LEFT JOIN r USING (doc_id)"""


@query("op11_target_resampling", _SQL)
def op11_target_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc.doc_id", "n_features", "weight", "score", "rank")
