"""Token ids in directly addressable codes.

File format (all integers little-endian)
    One file holds a run of documents in ascending order. An id is cut into chunks of
    ``CHUNK_BITS`` bits, lowest first. Level 0 stores the first chunk of every id. A bit per
    stored chunk tells whether the id goes on; level k + 1 stores the next chunk of those that
    do. A rank directory per level counts the set bits before every 512-bit block, so the
    position of an id on the next level is one directory entry plus at most eight words of bits. Any
    token is found in one step per level; nothing is decoded around it.

    ``DACT1`` + 3 zero bytes | u32 header length | header (JSON: number of ids, of documents, bytes per
    section) | document ids (i64) | null flags (u8) | ends of documents (u64, counted in ids) | per level: chunks (u8),
    continuation bits (packed, low bit first), rank directory (u64).

Writing
    Documents are range-partitioned by id (ties by a hash of the text) and encoded after that, so the order
    of files is the order of documents. A task starts a new file after ``FILE_IDS`` ids. Each attempt
    writes names of its own; only the names that a finished task returned are in the manifest, so
    a lost executor leaves orphans but no doubt. The manifest (one row per file) gives every file the
    number of ids before it.

Defined results
    Null or empty text: the end id only. Null doc_id: before all others. Repeated rows: each is written;
    their order among themselves is that of the text hash. Empty table: no file, no rows. A document
    longer than a file has a file of its own. Extra columns are not written.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelens.llm.common import open_store, prepare, query, table
from outcomelens.session import materialise, scratch_path

CHUNK_BITS = 8
BLOCK = 512
FILE_IDS = 2_000_000
END_ID = 2
MAGIC = b"DACT1\0\0\0"
#: Entries of each of a worker's two generations of encoded units.
CACHE_UNITS = 250_000
LONGEST_CACHED = 64
#: Characters encoded at once; the more, the fewer different units per unit.
CHUNK_CHARS = 4 << 20


# ---- codes -----------------------------------------------------------------------------


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, continuation bits and rank directory of each level."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        chunk = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK), dtype=np.uint64) if len(rest) else np.zeros(0, np.uint64)
        ranks = np.concatenate((np.zeros(1, np.uint64), np.cumsum(blocks, dtype=np.uint64)))
        levels.append((chunk, bits, ranks))
        rest = more[goes_on]
        if not len(rest):
            return levels


def dump(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    sections = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.asarray(ends, "<u8").tobytes(),
    ]
    for chunk, bits, ranks in encode_levels(ids):
        sections += [chunk.tobytes(), bits.tobytes(), ranks.astype("<u8").tobytes()]
    header = json.dumps({"ids": len(ids), "docs": len(doc_ids), "bytes": [len(s) for s in sections]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *sections])


class DacFile:
    """Random access to one file by byte ranges; ``source`` has ``seek`` and ``read``."""

    def __init__(self, source) -> None:
        self.source = source
        start = self._read(0, len(MAGIC) + 4)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(start[len(MAGIC) :], "little")
        header = json.loads(self._read(len(start), size))
        self.n_ids, self.n_docs = header["ids"], header["docs"]
        self.at = len(start) + size + np.concatenate(([0], np.cumsum(header["bytes"])))
        self.sizes = header["bytes"]

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(int(at))
        return self.source.read(int(n))

    def _section(self, k: int, dtype: str) -> np.ndarray:
        return np.frombuffer(self._read(self.at[k], self.sizes[k]), dtype)

    def doc_ids(self) -> list[int | None]:
        return [None if null else int(d) for d, null in zip(self._section(0, "<i8"), self._section(1, "u1"))]

    def ends(self) -> np.ndarray:
        return self._section(2, "<u8")

    def access(self, i: int) -> int:
        """The id at place ``i``: per level one chunk, and one directory entry with part of a block."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift, section = 0, 0, 3
        while True:
            value |= self._read(self.at[section] + i, 1)[0] << shift
            block = i // BLOCK
            first = block * BLOCK // 8
            bits = int.from_bytes(self._read(self.at[section + 1] + first, i // 8 - first + 1), "little")
            if not bits >> (i % BLOCK) & 1:
                return value
            rank = int.from_bytes(self._read(self.at[section + 2] + 8 * block, 8), "little")
            i = rank + (bits & ((1 << (i % BLOCK)) - 1)).bit_count()
            shift, section = shift + CHUNK_BITS, section + 3

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids of places a to b; reads only the ranges that hold them."""
        out = np.zeros(max(0, b - a), np.uint32)
        where, shift, section = np.arange(len(out)), 0, 3
        while len(where):
            chunk = np.frombuffer(self._read(self.at[section] + a, b - a), np.uint8)
            out[where] |= chunk.astype(np.uint32) << np.uint32(shift)
            block = a // BLOCK
            first = block * BLOCK // 8
            raw = np.frombuffer(self._read(self.at[section + 1] + first, (b - 1) // 8 - first + 1), np.uint8)
            bits = np.unpackbits(raw, bitorder="little").astype(bool)
            low = a - block * BLOCK
            goes_on = bits[low : low + b - a]
            rank = int.from_bytes(self._read(self.at[section + 2] + 8 * block, 8), "little")
            a = rank + int(bits[:low].sum())
            b = a + int(goes_on.sum())
            where, shift, section = where[goes_on], shift + CHUNK_BITS, section + 3
        return out


# ---- encoding --------------------------------------------------------------------------

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: A text with one of these takes the slower way, which cuts at every kind of white space.
_UNUSUAL = ("\0", "\t", "\x0b", "\x0c", "\r", "  ", "\n ", " \n", "\n\n\n")
_UNUSUAL_WIDE = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Signs at the end of a unit are a piece of their own, and so a unit of their own.
_TAIL = r"([\p{L}\p{N}])([!-/:-@\[-`{-~]+)( |$)"
#: Marks a unit that stands in the cache as it is; others stand there without their space.
_AS_IS = "\0"


class UnitEncoder:
    """Encodes a byte-level vocabulary unit by unit.

    The vocabulary's pattern lets no piece reach from a letter, digit or sign into the white space
    behind it, so white space and the run after it (a unit) encode alike wherever they stand. The
    library encodes every unit that the worker has not met lately; the units of many texts are told apart and
    their ids put together as arrays. Many are joined into one text, which
    is cut again by the byte lengths of the pieces. A text that holds a special token's string goes to
    the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.bytes_of[i] = len(piece)  # one character of a piece stands for one byte
        self.known: dict[str, bytes] = {}  # met lately
        self.older: dict[str, bytes] = {}  # and before; goes when the first is full

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """Units that are a space and a run without white space: one text, cut again by byte lengths."""
        raw = self._library([" " + " ".join(units)])[0]
        ends = np.cumsum(self.bytes_of[np.frombuffer(raw, "<u4")])
        cuts = np.searchsorted(ends, np.cumsum([len(u.encode()) + 1 for u in units])) + 1
        edges = [0, *(cuts * 4).tolist()]
        return {u: raw[a:b] for u, a, b in zip(units, edges, edges[1:])}

    def _usual(self, text: str) -> bool:
        """Whether the text's units are what stands between its spaces."""
        return not (
            not text
            or text[0] in " \n"
            or text[-1] in " \n"
            or any(c in text for c in _UNUSUAL)
            or not (text.isascii() or not any(c in text for c in _UNUSUAL_WIDE))
        )

    def _new(self, new: list[str]) -> dict[str, bytes]:
        found, spaced, as_is = {}, [], []
        for unit in new:
            (as_is if unit[:1] in (_AS_IS, "\n", "") else spaced).append(unit)
        for at in range(0, len(spaced), 2000):
            found.update(self._learn(spaced[at : at + 2000]))
        # An empty unit is a lone space.
        found.update(zip(as_is, self._library([u.removeprefix(_AS_IS) if u else " " for u in as_is])))
        return found

    def _lookup(self, units: list[str]) -> list[bytes]:
        """Codes of different units; those met again move to the younger generation."""
        found = list(map(self.known.get, units))
        lacking = [i for i, code in enumerate(found) if code is None]
        names = [units[i] for i in lacking]
        codes = list(map(self.older.get, names))
        new = self._new([u for u, code in zip(names, codes) if code is None])
        codes = [new[u] if code is None else code for u, code in zip(names, codes)]
        for i, code in zip(lacking, codes):
            found[i] = code
        if len(self.known) + len(names) > CACHE_UNITS:
            self.older, self.known = self.known, {}
        self.known.update((u, code) for u, code in zip(names, codes) if len(u) <= LONGEST_CACHED)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special = [any(s in t for s in self.special) for t in texts]
        usual = [not s and self._usual(t) for s, t in zip(special, texts)]
        # Units of the usual texts are cut, and all units told apart, without a Python object for each.
        marked = pa.array([_AS_IS + t for t, u in zip(texts, usual) if u], pa.large_string())
        cut = pc.replace_substring(marked, "\n", " \n")
        cut = pc.split_pattern(pc.replace_substring_regex(cut, _TAIL, "\\1 \0\\2\\3"), " ")
        odd = [[] if s else [_AS_IS + u for u in _UNIT.findall(t)] for s, u, t in zip(special, usual, texts) if not u]
        sizes = np.zeros(len(texts), np.int64)
        is_usual = np.array(usual, bool)
        sizes[is_usual] = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        sizes[~is_usual] = [len(u) for u in odd]
        order = np.concatenate((np.flatnonzero(is_usual), np.flatnonzero(~is_usual)))
        others = pa.array([u for own in odd for u in own], pa.large_string())
        told = pa.concat_arrays([cut.flatten(), others]).dictionary_encode()
        codes = told.indices.to_numpy()
        pieces = self._lookup(told.dictionary.to_pylist())
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(pieces), "<u4")
        taken = lengths[codes]
        ends = np.cumsum(taken)
        places = np.repeat(starts[codes] - (ends - taken), taken)
        places += np.arange(len(places))
        ids = ids[places]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes[order])))]
        out: list[bytes] = [b""] * len(texts)
        for i, a, b in zip(order.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = self._library([texts[i]])[0] if special[i] else ids[a:b].tobytes()
        return out


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


# ---- writing and reading ---------------------------------------------------------------

_MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of consecutive documents, ``CHUNK_CHARS`` characters or one document at least."""
    names, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            names.append(doc)
            texts.append(text or "")
            size += len(text or "")
            if size >= CHUNK_CHARS:
                yield names, texts
                names, texts, size = [], [], 0
    if names:
        yield names, texts


def _write(folder: str, vocabulary: str, end_id: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = open_store(folder)
        codec, part, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        docs: list[int | None] = []
        ends: list[int] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, docs, ends, held
            ids = np.frombuffer(b"".join(held), "<u4")
            path = f"{root}/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.dact"
            with store.open_output_stream(path) as out:
                out.write(dump(ids, docs, np.array(ends)))
            row = {"part": [part], "seq": [seq], "path": [path], "n_docs": [len(docs)], "n_ids": [len(ids)]}
            seq, docs, ends, held = seq + 1, [], [], []
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), kinds)], list(row))

        for names, texts in _chunks(batches):
            for doc, raw in zip(names, codec.encode(texts)):
                if docs and ends[-1] + len(raw) // 4 + 1 > file_ids:
                    yield close()
                docs.append(doc)
                held += [raw, end]
                ends.append((ends[-1] if ends else 0) + len(raw) // 4 + 1)
        if docs:
            yield close()

    return run


def write_tokens(
    docs: DataFrame,
    vocabulary: str,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the token files; returns the stored manifest (path, n_docs, n_ids, base), one row per file.

    ``folder`` must be reachable by all executors; by default it is a fresh one in the shared folder.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "tokens")
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie, "text")
    written = materialise(ordered.mapInArrow(_write(folder, vocabulary, end_id, file_ids), _MANIFEST), "manifest")
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    return materialise(
        written.select(
            F.lit(folder).alias("folder"),
            "path",
            "n_docs",
            "n_ids",
            F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"),
        ),
        "bases",
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, _ = open_store(row["folder"])
            with store.open_input_file(row["path"]) as source:
                file = DacFile(source)
                names, ends = file.doc_ids(), file.ends().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                at = 0
                while at < len(names):  # documents in ranges of bounded size
                    to = max(at + 1, int(np.searchsorted(ends, starts[at] + 500_000, "right")))
                    ids = file.slice(int(starts[at]), int(ends[to - 1])).astype("<u4")
                    lows = (starts[at:to] - starts[at]).tolist()
                    highs = (ends[at:to] - starts[at]).tolist()
                    crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(lows, highs)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[at:to], pa.int64()),
                            pa.array(starts[at:to] + row["base"]),
                            pa.array(ends[at:to] - starts[at:to]),
                            pa.array(crcs, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    at = to


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, one task per file."""
    files = manifest.select("folder", "path", "base")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def tokens_of(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return read_tokens(write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("op5_token_files")
def op5_token_files(spark, sf_dir):
    return tokens_of(table(spark, sf_dir, "documents"))
