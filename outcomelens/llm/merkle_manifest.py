"""A Merkle manifest of a table, with a witness per row.

Every row is a leaf: a SHA-256 of its fields. Leaves of a source, in order of their id, are the lowest
level of a tree in which every ``ARITY`` consecutive nodes become one; the roots of the sources are in turn the lowest
level of the tree above. A row's witness is what its siblings are on the way to the root.

Witnesses grow by appending. :class:`Appender` takes nodes in order; a node starts with an empty
witness, and whenever its subtree's run of siblings completes, the run is attached once to the
subtree and thereby to every witness below. A task appends an aligned block of ``BLOCK`` nodes, which is a whole
subtree. The roots of the blocks are few and are appended the same way by the next round, until one node of each
source is left; the witnesses of a round's blocks are then the upper part of their nodes' witnesses. They reach the tasks
as a head row before the block's rows, so no row is joined to anything.

Places in a source come from a range partition by (source, id): tasks count the rows of their own range
source by source, and only a source that goes on from one range to the next needs a number from outside, one per range.
So a source of any size is spread over tasks, and nothing but digests is shuffled.

Defined results
    Null fields count as ``-``; an empty text is ``0:``. A null source is a source of its own, the first. Null ids come
    first in their source and are never tampered with. Rows equal in source and id are ordered by their leaf; equal rows have equal leaves
    and differ only in their witness. Texts of any length are hashed whole. One row: it is leaf, subroot and root, and
    its proof is the digest of nothing. Empty table: no rows. Extra columns are neither hashed nor returned by the query;
    :func:`manifest` hashes exactly the columns it is given and passes those to carry, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelens.llm.common import prepare, query, table
from outcomelens.llm.gain_resample import CRC_TABLE, crc_sql
from outcomelens.session import materialise

ARITY = 16
#: Levels of one block; a block has ``ARITY ** BLOCK_LEVELS`` nodes.
BLOCK_LEVELS = 3
BLOCK = ARITY**BLOCK_LEVELS
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
#: Rows of one range and of one task of blocks.
TASK_ROWS = 2_000_000


# ---- the tree in one task --------------------------------------------------------------


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appender:
    """Takes the nodes of one aligned block in order and keeps their witnesses.

    ``runs[k]`` holds the completed runs of level k, as joined digests. A witness is never copied: that of node i
    is its place in run ``i // ARITY`` of level 0, in run ``i // ARITY**2`` of level 1, and so on, so completing
    a run extends the witnesses of all nodes below it.
    """

    def __init__(self) -> None:
        self.open: list[list[str]] = [[]]
        self.runs: list[list[str]] = [[]]
        self.size = 0

    def append(self, node: str) -> None:
        self.size += 1
        self._add(0, node)

    def _add(self, level: int, node: str) -> None:
        if level == len(self.open):
            self.open.append([])
            self.runs.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY and level < BLOCK_LEVELS:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run = "".join(self.open[level])
        self.open[level] = []
        self.runs[level].append(run)
        self._add(level + 1, digest(run))

    def finish(self, whole: bool) -> str:
        """Close the open runs and return the block's root.

        ``whole``: no other block follows or precedes, so the tree ends where one node is left. Otherwise every
        block has all its levels, the last one too, however few its nodes.
        """
        wanted = BLOCK_LEVELS
        if whole:
            wanted, left = 0, self.size
            while left > 1:
                wanted, left = wanted + 1, -(-left // ARITY)
        for level in range(wanted):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        self.levels = wanted
        return self.open[wanted][0]

    def witness(self, i: int) -> Iterator[tuple[str, str]]:
        """Per level: what stands before node i's ancestor in its run, and what stands after it."""
        for level in range(self.levels):
            run, at = self.runs[level][i // ARITY ** (level + 1)], i // ARITY**level % ARITY * DIGEST
            yield run[:at], run[at + DIGEST :]


def fold(node: str, witness: Sequence[tuple[str, str]]) -> str:
    """The root that follows from a node and its witness."""
    for left, right in witness:
        node = digest(left + node + right)
    return node


def proof(witness: Sequence[tuple[str, str]]) -> str:
    """One digest of all siblings, level by level, left to right."""
    found = hashlib.sha256()
    for left, right in witness:
        found.update(left.encode())
        found.update(right.encode())
    return found.hexdigest()


# A witness travels as text: "left,right" per level, joined by ";".


def packed_witness(witness: Sequence[tuple[str, str]]) -> str:
    return ";".join(f"{left},{right}" for left, right in witness)


def unpacked_witness(text: str) -> list[tuple[str, str]]:
    return [tuple(level.split(",")) for level in text.split(";")] if text else []


# ---- places ----------------------------------------------------------------------------


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``place``: 0, 1, 2... within ``tree`` by the ``order`` columns, nulls first.

    ``rows`` is a stored table with a string column ``tree`` and no other rows than are to be counted.
    """
    spark = rows.sparkSession
    keys = ["tree", *order, "row"]
    ranges = _tasks(rows)
    names = rows.columns
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # equal rows need not share a range

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = (), 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                if (tree,) != last:
                    last, seen = (tree,), 0
                places.append(seen)
                seen += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "nth"])

    sorted_rows = (
        rows.repartitionByRange(ranges, *[F.col(f"`{c}`").asc_nulls_first() for c in keys])
        .sortWithinPartitions(*[F.col(f"`{c}`").asc_nulls_first() for c in keys])
        .withColumn("part", F.spark_partition_id())
    )
    schema = T.StructType([*sorted_rows.schema.fields, T.StructField("nth", T.LongType())])
    numbered = materialise(sorted_rows.mapInArrow(number, schema), "numbered")
    # A tree that goes on in a range is that range's first, so there is at most one such row per range.
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    going_on = (
        numbered.groupBy("tree", "part")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(earlier))
        .filter(F.col("before").isNotNull())
        .select("tree", "part", "before")
    )
    carried_rows = [(r.part, r.tree, r.before) for r in going_on.collect()]
    if not carried_rows:
        return numbered.select(*names, F.col("nth").alias("place"))
    carried = spark.createDataFrame(carried_rows, "part int, first string, before long")
    joined = numbered.join(F.broadcast(carried), "part", "left")  # one row per range
    goes_on = F.col("before").isNotNull() & F.col("tree").eqNullSafe(F.col("first"))
    place = F.col("nth") + F.when(goes_on, F.col("before")).otherwise(F.lit(0))
    return joined.select(*names, place.alias("place"))


def _tasks(rows: DataFrame) -> int:
    """Tasks for a stored table: the session's number, more where the rows need more."""
    wanted = -(-rows.count() // TASK_ROWS)
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


# ---- the tree over tasks ---------------------------------------------------------------


def _in_blocks(rows: DataFrame, tasks: int, *order: str) -> DataFrame:
    """Blocks whole in one task, their rows in order."""
    keys = ["tree", "block"]
    return rows.repartition(tasks, *keys).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in [*keys, *order]])


def _blocks(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each block, which are at most ``BLOCK`` (and a head); batches need not end with a block."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


def block_roots(nodes: DataFrame) -> DataFrame:
    """One row (tree, place, node, whole) per block of ``nodes`` (tree, place, node).

    ``whole`` is set for a block that is all of its tree. A full first block may have others after it; it has
    all its levels either way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in _blocks(batches, ["tree", "block", "node"]):
            block_tree = Appender()
            for row in rows:
                block_tree.append(row[2])
            out.append((tree, block, block_tree.finish(block == 0 and len(rows) < BLOCK)))
            if len(out) == 4_096:
                yield _batch(out, ["tree", "place", "node"])
                out = []
        if out:
            yield _batch(out, ["tree", "place", "node"])

    cut = nodes.select("tree", F.expr(f"place div {BLOCK}").alias("block"), "place", "node")
    return _in_blocks(cut, _tasks(nodes), "place").mapInArrow(run, "tree string, place long, node string")


def _batch(rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    kinds = {"place": pa.int64(), "block": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for c, n in zip(zip(*rows), names)], list(names))


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the stored block roots above them, up to one node per tree."""
    found = [nodes]
    while True:
        up = materialise(block_roots(found[-1]), f"roots{len(found)}")
        found.append(up)
        if up.filter(F.col("place") > 0).isEmpty():
            return found


def witnesses(levels: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """Rows (tree, place, upper) for the blocks of ``levels[0]``: what is above them, down from ``above``
    (tree, upper), which has one row per tree.
    """
    heads = levels[-1].join(above, levels[-1]["tree"].eqNullSafe(above["tree"])).select(
        levels[-1]["tree"], "place", "upper"
    )
    for nodes in reversed(levels[1:-1]):
        heads = materialise(extend(nodes.withColumn("other", F.lit(None).cast("string")), heads, _descend, "tree string, place long, upper string"), "upper")
    return heads


def _descend(tree: str, rows: list[tuple], found: Appender, upper: str) -> Iterator[tuple]:
    for i, row in enumerate(rows):
        own = packed_witness(list(found.witness(i)))
        yield tree, row[3], ";".join(filter(None, (own, upper)))


def extend(nodes: DataFrame, heads: DataFrame, result, schema: str) -> DataFrame:
    """Append the nodes of each block again and hand them on with the witness above their block.

    ``nodes`` has tree, place, node, other; ``heads`` has tree, place (of the block), upper. ``result`` gets the tree, the
    rows, their :class:`Appender` and the head's witness, and yields result rows.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in _blocks(batches, ["tree", "block", "upper", "place", "node", "other"]):
            head, *rows = rows
            found = Appender()
            for row in rows:
                found.append(row[4])
            found.finish(block == 0 and len(rows) < BLOCK)
            for row in result(tree, rows, found, head[2]):
                out.append(row)
                if len(out) == 4_096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    none = F.lit(None).cast("string")
    first = heads.select("tree", F.col("place").alias("block"), "upper", F.lit(-1).cast("long").alias("place"), none.alias("node"), none.alias("other"))
    rest = nodes.select("tree", F.expr(f"place div {BLOCK}").alias("block"), none.alias("upper"), "place", "node", "other")
    return _in_blocks(first.unionByName(rest), _tasks(nodes), "place").mapInArrow(run, schema)


# ---- manifest --------------------------------------------------------------------------


def leaf(*fields: Column) -> Column:
    """SHA-256 of the fields: ``-`` for null, else byte count, colon, value."""
    parts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*framed), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    fields: Sequence[str] = FIELDS,
    tampered: Column | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    ``fields`` are hashed in their order. ``tampered`` is the leaf to fold in place of a row's own (null: its own).
    """
    prepare(docs.sparkSession)
    own = leaf(*[F.col(f"`{c}`") for c in fields])
    rows = docs.select(
        F.col(f"`{source}`").cast("string").alias("tree"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        own.alias("node"),
        (F.lit(None).cast("string") if tampered is None else tampered).alias("folded"),
    )
    rows = materialise(rows, "leaves")
    rows = materialise(placed(rows, ["doc_id", "node"]), "placed")
    levels = rounds(rows.select("tree", "place", "node"))

    # The tree of sources, whose nodes are the one node left of each.
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    subroots = materialise(placed(materialise(subroots, "subroots"), ["source"]), "sources")
    top = rounds(subroots.select("tree", "place", "node"))
    root = top[-1].select("node").first()  # one row, or none for an empty table
    root = root.node if root else ""
    spark = docs.sparkSession
    heads = witnesses(top, spark.createDataFrame([("", "")], "tree string, upper string"))

    def at_source(tree: str, rows: list[tuple], found: Appender, upper: str) -> Iterator[tuple]:
        for (_, place, above), row in zip(_descend(tree, rows, found, upper), rows):
            yield row[5], f"{row[4]}|{above}"

    # The subroot goes before the witness, since every row reports it.
    above = extend(
        subroots.select("tree", "place", "node", F.col("source").alias("other")), heads, at_source, "tree string, upper string"
    )
    above = materialise(above, "above")
    subs = above.select("tree", F.substring_index("upper", "|", 1).alias("subroot"))
    below = above.select("tree", F.expr("substring(upper, instr(upper, '|') + 1)").alias("upper"))
    heads = witnesses(levels, below)
    named = heads.join(subs, heads["tree"].eqNullSafe(subs["tree"])).select(
        heads["tree"], "place", F.concat_ws("|", "subroot", "upper").alias("upper")
    )

    def at_leaf(tree: str, rows: list[tuple], found: Appender, upper: str) -> Iterator[tuple]:
        subroot, _, text = upper.partition("|")
        rest = unpacked_witness(text)
        for i, row in enumerate(rows):
            doc, _, changed = row[5].partition("|")
            path = [*found.witness(i), *rest]
            folded = fold(changed or row[4], path)
            yield int(doc) if doc else None, row[4], subroot, root, proof(path), folded, folded == root

    leaves = rows.select(
        "tree",
        "place",
        "node",
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("folded", F.lit(""))).alias("other"),
    )
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return extend(leaves, named, at_leaf, schema)


# ---- the query -------------------------------------------------------------------------


def _tree_sql(name: str, nodes: str, leaves: str, levels: int) -> str:
    """CTEs that fold ``leaves`` (with key, place, folded, siblings) up a tree of ``nodes`` (key, place, node)."""
    out = f"{name}s0 AS (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM {nodes}),\n{name}l0 AS (SELECT * FROM {leaves})"
    for k in range(levels):
        at = f"64 * (place // {ARITY**k} % {ARITY})"
        out += f""",
{name}r{k} AS (SELECT key, place // {ARITY} AS slot, string_agg(node, '' ORDER BY place) AS run, max(n) AS n
    FROM {name}s{k} GROUP BY key, place // {ARITY}),
{name}s{k + 1} AS (SELECT key, slot AS place, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS node,
    (n + {ARITY - 1}) // {ARITY} AS n FROM {name}r{k}),
{name}l{k + 1} AS (SELECT l.* EXCLUDE (folded, siblings),
    CASE WHEN n > 1 THEN sha256(substr(run, 1, {at}) || folded || substr(run, {at} + 65)) ELSE folded END AS folded,
    CASE WHEN n > 1 THEN siblings || substr(run, 1, {at}) || substr(run, {at} + 65) ELSE siblings END AS siblings
    FROM {name}l{k} l JOIN {name}r{k} r ON l.key IS NOT DISTINCT FROM r.key AND l.place // {ARITY ** (k + 1)} = r.slot)"""
    return out


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL = f"""WITH tabs AS ({CRC_TABLE}),
d AS (SELECT doc_id, source AS key, {_leaf_sql("text")} AS node,
    CASE WHEN {crc_sql("doc_id::varchar")} % {TAMPER_EVERY} = 0 THEN {_leaf_sql(_LOWERED)} END AS tampered
    FROM documents, tabs),
a AS (SELECT doc_id, key, node AS leaf, coalesce(tampered, node) AS folded, '' AS siblings,
    row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS place FROM d),
an AS (SELECT key, place, leaf AS node FROM a),
{_tree_sql("a", "an", "a", 6)},
b AS (SELECT 0 AS key, key AS source, node, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS place FROM as6),
bl AS (SELECT doc_id, leaf, b.node AS subroot, b.key, b.place, folded, siblings
    FROM al6 JOIN b ON al6.key IS NOT DISTINCT FROM b.source),
bn AS (SELECT key, place, node FROM b),
{_tree_sql("b", "bn", "bl", 4)}
SELECT doc_id, leaf, subroot, (SELECT node FROM bs4) AS root, sha256(siblings) AS proof_sha256,
    folded AS folded_root, folded = (SELECT node FROM bs4) AS verified FROM bl4"""


@query("op13_merkle_manifest", _SQL)
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    fields = [lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return manifest(docs, tampered=F.when(chosen, leaf(*fields)))
