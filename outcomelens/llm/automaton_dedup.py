"""Remove passages that a document with a smaller id holds too, with suffix automata.

The documents are their own reference, so whole automata of all shards cannot be sent to all
documents: both sides grow. The work is routed instead, and an automaton is built where the passages
that can match it meet.

1. Each run of ``window`` words has an anchor: the word group of ``GROUP`` words in it whose hash is least. Equal
   runs have equal anchors, and neighbouring runs mostly share one, so about a fifth of the words are anchors.
2. An anchor seen in one document only leads nowhere. Runs whose anchor stands in several documents are candidates;
   neighbouring candidates form segments, cut anew at about every fourth anchor (by its hash, so equal text is cut at equal
   places). Segments of equal content become one, so copies and shared passages cost nothing from here on.
3. Of each different candidate run the smallest document that holds it (its home) and its place there name a reference
   shard: ``SLICE`` runs of the home. A run seen in one document only leads nowhere.
4. Neighbouring runs of a segment that belong to one shard form a passage, of at most ``SLICE`` runs. Passages of equal
   content become one again before they meet.
5. A shard takes its passages in ascending order of document. Each is first streamed through the automaton of the
   smaller documents, for the longest match that ends at every word (matching statistics), and then added to it.
   Matches of at least ``window`` words are maximal repeated spans. A later document with the same passage
   repeats all of it.
6. Spans go back to the segments, the documents, and their words are removed. Matches are judged on the input.

All of this is done alike for every shard. A frequent line that stands in different surroundings makes candidates of the runs around
it, but these differ and end in step 3. What meets in a shard are pieces of ``SLICE`` runs of one home, so its different
passages are few, however many documents hold them, and no task holds a group that grows with the corpus.

Hashes only decide where rows meet: the automaton compares words, so two runs of equal hash share a shard and do
not match. Equal segments and passages are known by digest and content. The hot steps are plain joins on stored tables,
whose large keys Spark splits, and sums before a shuffle.

Defined results
    Null and blank texts: no words. Texts shorter than the window: unchanged. Documents without an id come after all
    others and not after each other; rows of one id do not repeat each other. Empty table: no rows. Extra columns pass
    through :func:`remove_repeats` whatever their name. The input must give the same rows in the same order when it
    is read twice (a stored table does).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import WORD, prepare, query, table, texts_of
from outcomelens.session import materialise, scratch_path

WINDOW = 13
GROUP = 6
SLICE = 64
#: A segment begins at one in so many anchors.
CUT = 4
#: Word hashes that a worker keeps.
_HASHES_KEPT = 500_000
_LAST = 2**63 - 1
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

# ---- anchors ---------------------------------------------------------------------------


class _Hashes(dict):
    """Hashes of the words met; long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_HASHES = _Hashes()


def rolled(words: list[bytes], size: int) -> np.ndarray:
    """Hash of every group of ``size`` neighbouring words."""
    if len(_HASHES) > _HASHES_KEPT:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for j in range(size):
        out = out * np.uint64(_BASE) + h[j : j + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(_MIX)
    out ^= out >> np.uint64(32)
    return out


def anchors(texts: list[list[bytes]], window: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the runs of ``window`` words in every text.

    Returns the text, the hash of the anchor, the first run that has it and how many neighbours have it too.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    words = [w for t in texts for w in t]
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    key = rolled(words, group)
    runs = np.lib.stride_tricks.sliding_window_view(key, window - group + 1)
    least = runs.argmin(1) + np.arange(len(runs))
    inside = of[: len(runs)] == of[window - 1 :]
    # The place of the leftmost least group never moves back, so the runs of one anchor are neighbours.
    head = np.ones(len(runs), bool)
    head[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (of[1 : len(runs)] != of[: len(runs) - 1])
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(runs)))
    first, count = first[inside[first]], count[inside[first]]
    starts = np.cumsum(sizes) - sizes
    return of[first], key[least[first]], first - starts[of[first]], count


def _emit_anchors(window: int, group: int):
    """One row per anchor and place; ``runs`` holds the first run, whether a segment begins there, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, key, first, count = anchors([t.split() for t in texts_of(batch.column("text"))], window, group)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("row").to_numpy()[of]),
                    pa.array(key.view(np.int64)),
                    pa.array((first * 2 + (key % np.uint64(CUT) == 0)) * _RUNS + count, pa.int64()),
                ],
                ["row", "anchor", "runs"],
            )

    return run


#: More than the runs that can share an anchor.
_RUNS = 1 << 8

# ---- segments and passages -------------------------------------------------------------


def _table_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)


def _digest(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def _segments(window: int):
    """Stretches of each document whose runs are all candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            lists = batch.column("candidates").to_pylist()
            for row, doc, text, packed_runs in zip(
                batch.column("row").to_pylist(), batch.column("doc").to_pylist(), texts_of(batch.column("text")), lists
            ):
                words = text.split()
                low = high = -1
                for packed_run in [*sorted(packed_runs), None]:
                    head, count = divmod(packed_run, _RUNS) if packed_run is not None else (-1, 0)
                    first, begins = head >> 1, head & 1
                    if first == high and not begins:
                        high = first + count
                        continue
                    if high > low:
                        content = b" ".join(words[low : high + window - 1])
                        out.append((row, doc, low, high - low + window - 1, _digest(content), content))
                    low, high = first, first + count
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield _table_of(out, ["row", "doc", "start", "n", "digest", "content"], kinds)

    return run


def _windows(window: int):
    """Hash and place of every run of ``window`` words in each different segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy().astype(np.int64)
            words = b" ".join(batch.column("content").to_pylist()).split(b" ")
            key = rolled(words, window)
            of = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            inside = np.flatnonzero(at + window <= sizes[of])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("segment").to_numpy()[of[inside]]),
                    pa.array(batch.column("first_doc").to_numpy()[of[inside]]),
                    pa.array(key[inside].view(np.int64)),
                    pa.array(at[inside], pa.int32()),
                ],
                ["segment", "doc", "key", "at"],
            )

    return run


def _cut(window: int, most_runs: int):
    """Passages of each segment: neighbouring runs of one shard, at most ``most_runs`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            lists = batch.column("known").to_pylist()
            for segment, doc, content, known in zip(
                batch.column("segment").to_pylist(), batch.column("first_doc").to_pylist(), batch.column("content").to_pylist(), lists
            ):
                words = content.split(b" ")
                known.sort(key=lambda k: k["at"])
                i = 0
                while i < len(known):
                    low, shard = known[i]["at"], known[i]["shard"]
                    j = i + 1
                    while j < len(known) and j - i < most_runs and known[j]["at"] == low + j - i and known[j]["shard"] == shard:
                        j += 1
                    n = j - i + window - 1
                    passage = b" ".join(words[low : low + n])
                    out.append((segment, doc, shard, low, n, _digest(passage), passage))
                    i = j
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield _table_of(out, ["segment", "doc", "shard", "start", "n", "digest", "content"], kinds)

    return run


_SEGMENT = "row long, doc long, start int, n int, digest binary, content binary"
_PASSAGE = "segment long, doc long, shard long, start int, n int, digest binary, content binary"
_MATCHED = "shard long, digest binary, first_doc long, spans array<array<int>>"


# ---- automata --------------------------------------------------------------------------


class Automaton:
    """Suffix automaton over the words of all texts added so far."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[bytes]) -> None:
        last, nxt, link, length = 0, self.next, self.link, self.length
        for word in words:
            to = nxt[last].get(word)
            if to is not None and length[to] == length[last] + 1:
                last = to
                continue
            if to is not None:
                last = self._split(last, word, to)
                continue
            made = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and word not in nxt[at]:
                nxt[at][word] = made
                at = link[at]
            if at >= 0:
                to = nxt[at][word]
                link[made] = to if length[to] == length[at] + 1 else self._split(at, word, to)
            last = made

    def _split(self, at: int, word: bytes, to: int) -> int:
        """A state of its own for the shorter texts of ``to``, which now end in more places."""
        made = len(self.next)
        self.next.append(dict(self.next[to]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        self.link[to] = made
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = made
            at = self.link[at]
        return made

    def repeated(self, words: list[bytes], least: int) -> list[list[int]]:
        """Maximal spans [from, to) covered by matches of at least ``least`` words."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, spans = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                matched += 1
            if matched >= least:
                if spans and i + 1 - matched <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], i + 1 - matched)
                    spans[-1][1] = i + 1
                else:
                    spans.append([i + 1 - matched, i + 1])
        return spans


def _match(window: int):
    """Rows come sorted by shard and document; shards follow one another, so one automaton lives at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.list_(pa.int32()))]
        names = ["shard", "digest", "first_doc", "spans"]
        out: list[tuple] = []
        for shard, passages in groupby(rows(batches), key=lambda r: r["shard"]):
            automaton = Automaton()
            for doc, same in groupby(passages, key=lambda r: r["first_doc"]):
                added = []
                for r in same:
                    words = r["content"].split(b" ")
                    out.append((shard, r["digest"], doc, automaton.repeated(words, window)))
                    added.append(words)
                for words in added:
                    automaton.add(words)
                if len(out) >= 2_000:
                    yield _table_of(out, names, kinds)
                    out = []
        if out:
            yield _table_of(out, names, kinds)

    return run


# ---- the operator ----------------------------------------------------------------------


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("doc"),
        F.col(f"`{text}`").alias("text"),
    )


def _tidy(spark) -> None:
    """Let Spark drop the shuffle files of steps whose result is stored."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _drop(spark, path: str) -> None:
    """Delete a scratch table of this module."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _united(df: DataFrame, key: str, start: str, spans) -> DataFrame:
    """Rows (key, spans): spans [from, to) moved by ``start``, in order and disjoint."""
    moved = F.struct((F.col(start) + F.col("s")[0]).alias("from"), (F.col(start) + F.col("s")[1]).alias("to"))
    parts = df.select(key, start, F.explode(spans).alias("s")).groupBy(key).agg(F.array_sort(F.collect_set(moved)).alias("parts"))
    # Neighbouring and overlapping spans become one.
    last = lambda done: F.try_element_at(done, F.lit(-1))
    merged = F.aggregate(
        "parts",
        F.array().cast("array<struct<from:int,to:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["from"] <= last(done)["to"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(last(done)["from"].alias("from"), F.greatest(last(done)["to"], s["to"]).alias("to"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return parts.select(key, merged.alias("spans"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Stored rows (row, spans): per document with repeats, spans [from, to) in words, in order and disjoint."""
    spark = docs.sparkSession
    prepare(spark)

    paths: dict[str, str] = {}

    def stored(df: DataFrame, name: str, *done: str) -> DataFrame:
        """Store a step; the tables of the steps in ``done`` are read by nothing after it."""
        paths[name] = scratch_path(spark, name)
        out = materialise(df, name, paths[name])
        for old in done:
            _drop(spark, paths.pop(old))
        _tidy(spark)
        return out

    rows = _rows(docs, doc_id, text)
    found = rows.select("row", "text").mapInArrow(_emit_anchors(window, group), "row long, anchor long, runs long")
    found = stored(found, "anchors")
    several = F.col("least") < F.col("most")
    shared = found.groupBy("anchor").agg(F.min("row").alias("least"), F.max("row").alias("most")).filter(several)
    shared = stored(shared.select(F.col("anchor").alias("known")), "shared_anchors")
    candidates = (
        found.select("row", "anchor", "runs")
        .join(shared, F.col("anchor") == F.col("known"))
        .groupBy(F.col("row").alias("of"))
        .agg(F.collect_list("runs").alias("candidates"))
    )
    candidates = stored(candidates, "candidates", "anchors", "shared_anchors")
    meeting = rows.join(candidates, F.col("row") == F.col("of")).select("row", "doc", "text", "candidates")
    segments = stored(meeting.mapInArrow(_segments(window), _SEGMENT), "segments", "candidates")

    unlike = segments.groupBy("digest", "content", "n").agg(F.min("doc").alias("first_doc"))
    unlike = stored(unlike.withColumn("segment", F.monotonically_increasing_id()), "different_segments")
    runs = unlike.select("segment", "first_doc", "content", "n").mapInArrow(_windows(window), "segment long, doc long, key long, at int")
    runs = stored(runs, "runs")
    shard = F.xxhash64("segment", F.floor(F.col("at") / SLICE))
    homes = runs.withColumn("shard", shard).groupBy("key")
    homes = homes.agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.min_by("shard", "doc").alias("shard")).filter(several)
    homes = stored(homes.select(F.col("key").alias("home"), "shard"), "homes")
    known = (
        runs.select("segment", "key", "at")
        .join(homes, F.col("key") == F.col("home"))
        .groupBy(F.col("segment").alias("of"))
        .agg(F.collect_list(F.struct("at", "shard")).alias("known"))
    )
    cut = unlike.join(known, F.col("segment") == F.col("of")).select("segment", "first_doc", "content", "known")
    passages = stored(cut.mapInArrow(_cut(window, SLICE), _PASSAGE), "passages", "runs", "homes")

    routed = passages.groupBy("shard", "digest", "content").agg(F.min("doc").alias("first_doc")).repartition("shard")
    matched = stored(routed.sortWithinPartitions("shard", "first_doc").mapInArrow(_match(window), _MATCHED), "matched")

    def own(kind: str) -> object:
        """What the document itself repeats; a later one with the same content repeats all of it."""
        return F.when(F.col("doc") == F.col("first_doc"), F.col("spans")).otherwise(F.array(F.expr(f"{kind}")))

    both = (F.col("shard") == F.col("of_shard")) & (F.col("digest") == F.col("of_digest"))
    found_in = passages.select("segment", "doc", "shard", "start", "n", "digest").join(
        matched.withColumnsRenamed({"shard": "of_shard", "digest": "of_digest"}), both
    )
    by_segment = _united(found_in, "segment", "start", own("array(0, n)")).withColumnRenamed("segment", "of")
    judged = unlike.select("segment", F.col("digest").alias("of_digest"), "first_doc").join(by_segment, F.col("segment") == F.col("of"), "left")
    by_row = segments.select("row", "doc", "start", "n", "digest").join(
        judged.select("of_digest", "first_doc", "spans"), F.col("digest") == F.col("of_digest")
    )
    whole = own("named_struct('from', 0, 'to', n)")
    spans = F.transform(F.coalesce(whole, F.expr("cast(array() as array<struct<from:int,to:int>>)")), lambda s: F.array(s["from"], s["to"]))
    return stored(_united(by_row, "row", "start", spans), "spans")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, removed, kept = [], [], []
        for text, spans in zip(texts_of(batch.column("text")), batch.column("spans").to_pylist()):
            words = text.split()
            left, at, gone = [], 0, 0
            for s in spans or []:
                left += words[at : s["from"]]
                gone += s["to"] - s["from"]
                at = s["to"]
            left += words[at:]
            n.append(len(words))
            removed.append(gone)
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), batch.column("spans"), pa.array(kept, pa.string())],
            ["doc", "n_words", "n_removed", "spans", "kept_text"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", carry=None, **options) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), n_words, n_removed, spans, kept_text (words joined by one space)."""
    spans = repeated_spans(docs, text=text, **options).withColumnRenamed("row", "of")
    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"),
        F.col(f"`{text}`").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    joined = inner.join(spans, F.col("row") == F.col("of"), "left").select("doc", "text", "spans")
    kind = joined.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(
        _apply, f"doc {kind}, n_words long, n_removed long, spans array<struct<from:int,to:int>>, kept_text string"
    )


_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_LAST}) AS id,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
), x AS (
  SELECT r, id, p, array_to_string(w[p + 1 : p + 13], ' ') AS k
  FROM (SELECT r, id, w, unnest(range(len(w) - 12)) AS p FROM d WHERE len(w) >= 13)
), m AS (
  SELECT k, min(id) AS first FROM x GROUP BY k
), c AS (
  SELECT DISTINCT r, unnest(range(p, p + 13)) AS q FROM x JOIN m USING (k) WHERE first < id
), v AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS q FROM d
), t AS (
  SELECT v.r, count(*) AS n, string_agg(word, ' ' ORDER BY v.q) AS kept
  FROM v ANTI JOIN c ON v.r = c.r AND v.q = c.q GROUP BY v.r
)
SELECT doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n, 0))::bigint AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON d.r = t.r
"""


@query("op9_repeated_passages", _SQL)
def op9_repeated_passages(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return kept.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
