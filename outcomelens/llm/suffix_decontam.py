"""Benchmark decontamination with suffix arrays over the training documents.

Documents stay where they are. Every Arrow batch is one shard: its words become numbers (the
benchmark's vocabulary; any other word is 0), and the shard's suffixes are sorted to the depth
of a window. A suffix that meets a word outside the vocabulary before a window ends cannot
begin a match, so it is left out before sorting. Every suffix of a benchmark item is then
binary-searched in the shard. A match of more than one window shows as neighbouring windows on
one diagonal, which gives the longest verbatim match of each pair of document and item and where
it starts in both.

The benchmark is the stated query set. It is read in blocks of at most ``BLOCK_WORDS`` words, in
order of item id; one block at a time is broadcast, and each further block is a further pass over
the documents. Blocks are cut between items.

Defined results
    Null or empty text: no words, so a clean document and an item without windows. An item of fewer
    than ``WINDOW`` words is one window. An item with a null id counts under the empty string;
    repeated ids count once. Documents are never joined, so null and repeated doc_ids keep
    their own rows. Empty benchmark: every document is clean. Extra columns pass through
    :func:`decontaminate` whatever their name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import packed, prepare, query, table, texts_of

WINDOW = 10
#: Words of the benchmark that are broadcast at once.
BLOCK_WORDS = 2_000_000

#: A-Z to a-z; every ASCII character that is no letter or digit to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_FOLD).split()


class Benchmark:
    """Vocabulary and sorted distinct windows of one block of items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        grams: dict[bytes, list[tuple[int, int]]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        for name, words in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], ">u4")
            for at in range(max(1, len(ids) - window + 1) if len(ids) else 0):
                grams.setdefault(ids[at : at + window].tobytes(), []).append((number[name], at))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({len(g) // 4 for g in grams}):
            keys = sorted(g for g in grams if len(g) == 4 * length)
            owners = [sorted(grams[k]) for k in keys]
            first = np.cumsum([0] + [len(o) for o in owners])
            flat = np.array([x for o in owners for x in o], np.int64).reshape(-1, 2)
            self.by_length[length] = (np.array(keys, f"S{4 * length}"), first, flat[:, 0], flat[:, 1])


def _windows(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffix array, to this depth, of the places where ``length`` known words follow, and its keys."""
    known = np.concatenate(([0], np.cumsum(ids != 0)))
    at = np.flatnonzero(known[length:] - known[:-length] == length) if len(ids) >= length else np.zeros(0, np.int64)
    keys = np.ascontiguousarray(ids[at[:, None] + np.arange(length)].astype(">u4")).view(f"S{4 * length}").ravel()
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def match_shard(bench: Benchmark, docs: list[list[bytes]]) -> dict[str, np.ndarray]:
    """Search all test suffixes in a shard.

    Returns per document the hit words (``n_hit``), the items (``pair_doc``, ``pair_item``) and, for each
    of these pairs, the longest match (``words``, ``doc_start``, ``item_start``).
    """
    get = bench.vocabulary.get
    lengths = np.array([len(d) for d in docs], np.int64)
    # One number 0 after each document keeps matches inside it.
    ids = np.fromiter(
        itertools.chain.from_iterable(itertools.chain(map(get, d, itertools.repeat(0)), (0,)) for d in docs),
        np.uint32,
        int(lengths.sum()) + len(docs),
    )
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    cover = np.zeros(len(ids) + 1, np.int64)
    found: list[np.ndarray] = []
    for length, (tests, first, items, offsets) in bench.by_length.items():
        places, keys = _windows(ids, length)
        low, high = np.searchsorted(keys, tests, "left"), np.searchsorted(keys, tests, "right")
        test = np.repeat(np.arange(len(tests)), high - low)
        place = places[np.concatenate([np.arange(a, b) for a, b in zip(low, high) if b > a] or [np.zeros(0, np.int64)])]
        np.add.at(cover, place, 1)
        np.add.at(cover, place + length, -1)
        # Each place once for every item position that holds the window.
        many = first[test + 1] - first[test]
        row = np.repeat(np.arange(len(test)), many)
        slot = first[test][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        found.append(np.stack([place[row], items[slot], offsets[slot], np.full(len(row), length)], 1))
    hits = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    hit = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    doc = np.searchsorted(starts, hits[:, 0], "right") - 1
    place, item, offset, length = hits.T
    # Neighbouring windows on one diagonal are one longer match.
    order = np.lexsort((offset, place - offset, item, doc))
    doc, place, item, offset, length = doc[order], place[order], item[order], offset[order], length[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(place) != 1) | (np.diff(offset) != 1)
    head = np.flatnonzero(new)
    words = np.diff(np.append(head, len(doc))) - 1 + length[head] if len(head) else np.zeros(0, np.int64)
    place, offset, doc, item = place[head], offset[head], doc[head], item[head]
    best = np.lexsort((place, -words, item, doc))
    keep = np.ones(len(best), bool)
    keep[1:] = (np.diff(doc[best]) != 0) | (np.diff(item[best]) != 0)
    best = best[keep]
    return {
        "n_words": lengths,
        "n_hit": hit[starts[1:]] - hit[starts[:-1]],
        "pair_doc": doc[best],
        "pair_item": item[best],
        "words": words[best],
        "doc_start": place[best] - starts[doc[best]],
        "item_start": offset[best],
        "cover": cover,
        "starts": starts,
    }


_MATCH = "struct<item_id:string,words:long,doc_start:long,item_start:long>"


def _search(bench, text_column: str, keep_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value: Benchmark = bench.value
        for batch in batches:
            texts = texts_of(batch.column(text_column))
            got = match_shard(value, [words_of(t) for t in texts])
            matches: list[list[dict]] = [[] for _ in texts]
            for d, i, w, a, b in zip(*(got[k].tolist() for k in ("pair_doc", "pair_item", "words", "doc_start", "item_start"))):
                matches[d].append({"item_id": value.names[i], "words": w, "doc_start": a, "item_start": b})
            columns = [batch.column(n) for n in batch.schema.names if n != text_column]
            names = [n for n in batch.schema.names if n != text_column]
            fields = pa.struct([("item_id", pa.string()), *[(n, pa.int64()) for n in ("words", "doc_start", "item_start")]])
            columns += [pa.array(got["n_words"]), pa.array(got["n_hit"]), pa.array(matches, pa.list_(fields))]
            names += ["n_words", "n_hit", "matches"]
            if keep_hits:  # the hit words themselves, to be united with those of other blocks
                mask = np.cumsum(got["cover"][:-1]) > 0
                spans = [np.flatnonzero(mask[a : b - 1]).tolist() for a, b in itertools.pairwise(got["starts"].tolist())]
                columns.append(pa.array(spans, pa.list_(pa.int32())))
                names.append("hits")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int, window: int) -> Iterator[Benchmark]:
    """The benchmark in blocks of bounded size; at least one, which may be empty."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").alias("t"))
    items: list[tuple[str, list[bytes]]] = []
    held, sent = 0, False
    for row in rows.orderBy("i").toLocalIterator():
        words = words_of((row["t"] or "").encode())
        if items and held + len(words) > block_words:
            yield Benchmark(items, window)
            items, held, sent = [], 0, True
        items.append((row["i"], words))
        held += len(words)
    if items or not sent:
        yield Benchmark(items, window)


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document: ``doc`` (the input row, or its ``carry`` columns), n_words, n_hit, matches.

    ``matches`` lists, in order of item, the longest verbatim match with each item that has an occurring
    window: its length in words and where it starts in the document and in the item.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts = blocks(benchmark, item_id, item_text, block_words, window)
    first, second = next(parts), next(parts, None)
    rows = packed(docs, carry, __text=text)
    if second is None:
        schema = f"{_column(rows, 'doc')}, n_words long, n_hit long, matches array<{_MATCH}>"
        return rows.mapInArrow(_search(spark.sparkContext.broadcast(first), "__text", False), schema)
    # Further blocks: each pass adds its matches and hit words to the row of the document.
    out = rows.withColumns(
        {"n_words": F.lit(0).cast("long"), "all_hits": F.array().cast("array<int>"), "all": F.array().cast(f"array<{_MATCH}>")}
    )
    for part in itertools.chain((first, second), parts):
        text_beside = out.drop("n_words").withColumn("copy", F.col("__text"))
        done = text_beside.mapInArrow(
            _search(spark.sparkContext.broadcast(part), "__text", True),
            ", ".join(_column(text_beside, c) for c in text_beside.columns if c != "__text")
            + f", n_words long, n_hit long, matches array<{_MATCH}>, hits array<int>",
        )
        out = done.select(
            "doc",
            F.col("copy").alias("__text"),
            "n_words",
            F.array_union("all_hits", "hits").alias("all_hits"),
            F.concat("all", "matches").alias("all"),
        )
    return out.select("doc", "n_words", F.size("all_hits").cast("long").alias("n_hit"), _one_per_item("all").alias("matches"))


def _one_per_item(matches: str) -> Column:
    """The longest match per item, the first of equally long ones; rows of one item may be in several blocks."""
    items = F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item_id"])))

    def longest(item: Column) -> Column:
        own = F.filter(matches, lambda m: m["item_id"] == item)
        ranked = F.transform(
            own, lambda m: F.struct(m["words"].alias("a"), (-m["doc_start"]).alias("b"), (-m["item_start"]).alias("c"), m.alias("match"))
        )
        return F.array_max(ranked)["match"]

    return F.transform(items, longest)


def _column(df: DataFrame, name: str) -> str:
    return f"`{name}` {df.schema[name].dataType.simpleString()}"


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    clean = search(docs, benchmark, **options).filter(F.col("n_hit") == 0)
    return clean.select("doc.*")


_SQL = r"""
WITH i AS (
  SELECT coalesce(item_id::varchar, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p + 1 : p + 10], ' ') AS k
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), x AS (
  SELECT r, p, n, array_to_string(w[p + 1 : p + n], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p
        FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
), h AS (
  SELECT x.r, x.p, x.n, g.item FROM x JOIN g ON x.k = g.k AND x.n = g.n
), c AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r
), m AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r
)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN m ON d.r = m.r
"""


@query("op3_decontaminate", _SQL)
def op3_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    items = F.array_join(F.array_sort(F.transform("matches", lambda m: m["item_id"])), ",")
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("matches").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
