"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

A document's fingerprint has a bit where over half of its shingles' hashes have one. Equal
fingerprints are first merged into one node. Two nodes at up to three bits meet half way: those with an odd number
of set bits emit every variant at one bit, those with an even number themselves and every variant at two
bits. All variants are even, and for each pair that should link some variant comes from both:

    0 or 1 bit apart from an even node: the node itself;   2 bits, both even: either node;
    2 bits, both odd: a point between;                     3 bits: a point one bit from the odd node.

The shuffle does not carry 64 or 2,017 rows per node. A variant's key is the parity of its sixteen
four-bit groups, so the variants of one node share at most 16 or 121 keys; a node is sent once per key, and the
variants of that key are made behind the shuffle, where those of one key are together. Parities of groups
are spread evenly even where fingerprints are alike.

Behind the shuffle equal variants are found by sorting. All who meet at a variant are tied to one of them: to the node
that is the variant, else to an odd one. Either is within three bits of all the others, which is verified, so
no group is expanded into pairs, and each group has at most 2,081 nodes. Components of these ties
are components of all links.

Defined results
    Null, empty and blank texts: fingerprint zero, linked like any other. Null ids: kept, and ignored when the smallest id
    of a component is chosen; a component of null ids only has a null id. Repeated rows: each has its row, and
    :func:`keep_one` keeps one row per component. Empty table: no rows. Extra columns pass through
    :func:`keep_one` whatever their name. The input must give the same rows in the same order when it is read twice (a
    stored table does).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import prepare, query, table, texts_of
from outcomelens.llm.components import components
from outcomelens.session import materialise

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Rows (node, key) whose variants are made at once.
CHUNK = 1 << 14
_NIBBLES = 0x1111111111111111

#: Distances of the variants that even and odd nodes emit, and which meeting nodes may hold a star:
#: 0 the variant itself, 1 also odd nodes, 2 also even ones.
_PLANS = {1: ((0,), (1,), 0), 2: ((0, 1), (0, 1), 2), 3: ((0, 2), (1,), 1)}


# ---- fingerprints ----------------------------------------------------------------------


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, A-Z lower-cased."""
    import xxhash

    words = raw.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    text, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        return hash64(text, SEED)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, counts = len(words) - shingle + 1, np.zeros(64, np.int64)
    low, high = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        pairs = zip(low[at : at + (1 << 16)], high[at : at + (1 << 16)])
        hashes = np.array([hash64(text[a:b], SEED) for a, b in pairs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(found.view(np.int64))], ["row", "doc_id", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (row, doc_id, fp): the fingerprint as a signed 64-bit number, and the row's number."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
    )
    return rows.mapInArrow(_fingerprints(shingle), "row long, doc_id long, fp long")


# ---- links -----------------------------------------------------------------------------


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _masks(distances: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Flip masks of these distances by what they change in the key."""
    found: dict[int, list[int]] = {}
    for d in distances:
        for bits in combinations(range(64), d):
            delta = 0
            for b in bits:
                delta ^= 1 << (b // 4 * 4)
            found.setdefault(delta, []).append(sum(1 << b for b in bits))
    return {k: np.array(v, np.uint64) for k, v in sorted(found.items())}


def _key(fp: Column) -> Column:
    """Parity of each four-bit group, in the group's lowest bit."""
    once = fp.bitwiseXOR(F.shiftrightunsigned(fp, 1))
    return once.bitwiseXOR(F.shiftrightunsigned(once, 2)).bitwiseAND(F.lit(_NIBBLES))


def _ties(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ties among nodes that meet at a variant; all rows of a key are present."""
    even_at, odd_at, rank_limit = _PLANS[max_bits]
    odd = (np.bitwise_count(fps) & 1).astype(bool)
    once = fps ^ (fps >> np.uint64(1))
    delta = keys ^ ((once ^ (once >> np.uint64(2))) & np.uint64(_NIBBLES))
    variants, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for is_odd, masks in ((False, _masks_of(even_at)), (True, _masks_of(odd_at))):
        own = np.flatnonzero(odd == is_odd)
        own = own[np.argsort(delta[own], kind="stable")]
        kinds, first = np.unique(delta[own], return_index=True)
        for kind, a, b in zip(kinds.tolist(), first, [*first[1:], len(own)]):
            flips = masks[kind]
            variants.append((fps[own[a:b], None] ^ flips).ravel())
            owners.append(np.repeat(own[a:b], len(flips)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    same = np.zeros(len(variant) + 1, bool)
    same[1:-1] = variant[1:] == variant[:-1]
    met = same[:-1] | same[1:]
    group = np.cumsum(~same[:-1])[met]
    variant, node = variant[met], fps[owner[met]]
    rank = np.where(node == variant, 0, np.where(np.bitwise_count(node) & 1, 1, 2))
    order = np.lexsort((node, rank, group))
    group, node, rank = group[order], node[order], rank[order]
    head = np.ones(len(group), bool)
    head[1:] = group[1:] != group[:-1]
    centre = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else np.zeros(0, np.int64)
    keep = (rank[centre] <= rank_limit) & (node != node[centre])
    a, b = node[centre][keep], node[keep]
    near = np.bitwise_count(a ^ b) <= max_bits
    a, b = a[near], b[near]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_KEPT_MASKS: dict[tuple[int, ...], dict[int, np.ndarray]] = {}


def _masks_of(distances: tuple[int, ...]) -> dict[int, np.ndarray]:
    if distances not in _KEPT_MASKS:
        _KEPT_MASKS[distances] = _masks(distances)
    return _KEPT_MASKS[distances]


def _meet(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a chunk ends where a key does."""
        keys, fps, held = [], [], 0

        def out(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = _ties(k, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys.append(batch.column("key").to_numpy().view(np.uint64))
            fps.append(batch.column("fp").to_numpy().view(np.uint64))
            held += len(batch)
            if held < CHUNK:
                continue
            k, f = np.concatenate(keys), np.concatenate(fps)
            cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
            if cut:
                yield out(k[:cut], f[:cut])
            keys, fps, held = [k[cut:]], [f[cut:]], len(k) - cut
        if held:
            yield out(np.concatenate(keys), np.concatenate(fps))

    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified ties (a, b) between different fingerprints of ``nodes`` (column fp, distinct).

    Their components are those of all pairs within ``max_bits`` (0 to 3).
    """
    if max_bits == 0:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    even_at, odd_at, _ = _PLANS[max_bits]
    deltas = [F.array(*[F.lit(_signed(d)) for d in _masks_of(x)]) for x in (even_at, odd_at)]
    even = F.bit_count("fp") % 2 == 0
    sent = nodes.select("fp", F.explode(F.when(even, deltas[0]).otherwise(deltas[1])).alias("delta")).select(
        _key(F.col("fp")).bitwiseXOR(F.col("delta")).alias("key"), "fp"
    )
    spark = nodes.sparkSession
    together = sent.repartition("key").sortWithinPartitions("key")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(CHUNK))
    try:
        return materialise(together.mapInArrow(_meet(max_bits), "a long, b long"), "ties")
    finally:
        prepare(spark)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Rows (row, doc_id, fp, component_id, kept): one per document, ``kept`` true once per component."""
    found = materialise(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    # Copies become one node before anything else; its head is the row with the smallest id.
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head")
    nodes = materialise(found.groupBy("fp").agg(head), "nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "head", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "rooted")
    heads = materialise(rooted.groupBy("root").agg(F.min("head").alias("first")).withColumnRenamed("root", "of"), "heads")
    classes = materialise(
        rooted.join(heads, F.col("root") == F.col("of")).select(F.col("fp").alias("same"), "first"), "classes"
    )
    return found.join(classes, F.col("fp") == F.col("same")).select(
        "row", "doc_id", "fp", F.col("first.doc_id").alias("component_id"), (F.col("row") == F.col("first.row")).alias("kept")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that another of their component stands for.

    What goes is less than what stays, so the rows that go are joined; the documents move only where those are
    too many for a broadcast.
    """
    gone = near_duplicates(docs, **options).filter(~F.col("kept")).select(F.col("row").alias("gone"))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    )
    return numbered.join(materialise(gone, "gone"), F.col("row") == F.col("gone"), "left_anti").select("doc.*")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@query("op2_simhash_groups")
def op2_simhash_groups(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
