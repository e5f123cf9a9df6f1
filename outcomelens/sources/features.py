"""Features of FeatureCollection files of any size, one file read by many tasks.

Spark's text reader cuts a file into byte ranges and, with ``}`` as its line end, hands each task the segments between closing
braces of its ranges. Where a range begins inside the JSON is unknown, so a first pass follows every range from both
possible beginnings, outside and inside of a string, and notes what it does to the nesting depth. Put together
in file order these notes give each range its true beginning; a second pass then cuts out the features. A feature that goes on over
the end of a range is handed over in parts and joined by the range it began in.

The notes are one short row per range (some hundred bytes for each ``maxPartitionBytes`` of input), which the driver
puts together. A feature is a record and must fit in memory; a file need not.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelens.session import share_package

#: Nesting: the collection is 1 deep, its list of features 2, a feature 3.
LIST_DEPTH = 2
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}\[\]]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


class Walker:
    """Follows JSON over segments that each end with a closing brace."""

    def __init__(self, in_string: bool, depth: int = 0) -> None:
        self.in_string, self.depth, self.least = in_string, depth, depth
        #: Depth of a container's holder -> whether the container last opened there is a list named ``features``.
        self.lists: dict[int, bool] = {}

    def steps(self, segment: str) -> Iterator[tuple[int, int, int]]:
        """Place, depth before and depth after of every bracket outside of strings."""
        text, at = segment + "}", 0
        if self.in_string:
            end = _STRING_END.match(text)
            if not end:
                return
            at, self.in_string = end.end(), False
        name = (0, 0)
        for token in _TOKEN.finditer(text, at):
            start, end = token.span()
            mark = text[start]
            if mark == '"':
                self.in_string = end - start < 2 or text[end - 1] != '"' or not _STRING_END.match(text, start + 1)
                name = (start, end)
                continue
            before = self.depth
            if mark in "{[":
                self.depth += 1
                named = text[name[0] : name[1]] == '"features"' and text[name[1] : start].strip() == ":"
                self.lists[before] = mark == "[" and named
            else:
                self.depth -= 1
                self.least = min(self.least, self.depth)
                self.lists[self.depth] = False
            yield start, before, self.depth


def _note(walker: Walker) -> str:
    return json.dumps([walker.in_string, walker.depth, walker.least, list(walker.lists.items())])


def _notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: what it does from either beginning."""
    found: dict[tuple[str, int], tuple[Walker, Walker]] = {}
    for batch in batches:
        for file, start, segment in zip(*(c.to_pylist() for c in batch.columns)):
            for walker in found.setdefault((file, start), (Walker(False), Walker(True))):
                for _ in walker.steps(segment):
                    pass
    keys = list(found)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.int64()),
            pa.array([_note(found[k][0]) for k in keys], pa.string()),
            pa.array([_note(found[k][1]) for k in keys], pa.string()),
        ],
        ["file", "start", "outside", "inside"],
    )


def beginnings(notes: list) -> dict[tuple[str, int], tuple[bool, int, bool, int]]:
    """Per (file, start): in a string, depth, in the list of features, and the range in which the open feature began."""
    out, last = {}, None
    for row in sorted(notes, key=lambda r: (r.file, r.start)):
        if row.file != last:
            state, last = (False, 0, False, -1), row.file
        out[row.file, row.start] = state
        in_string, depth, listed, since = state
        in_string, delta, least, lists = json.loads(row.inside if in_string else row.outside)
        # What was last opened or closed one deep decides which list the range ends in.
        listed = dict(map(tuple, lists)).get(1 - depth, listed)
        if depth + least <= LIST_DEPTH or since < 0:
            since = row.start  # a feature open at the end began here
        depth += delta
        state = (in_string, depth, listed, since if listed and depth > LIST_DEPTH else -1)
    return out


def _cutter(begin: dict):
    """Rows (file, since, start, text, whole): features, and parts of those that cross a range's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple[str, int], list] = {}
        names = ["file", "since", "start", "text", "whole"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            out = []
            for file, start, segment in zip(*(c.to_pylist() for c in batch.columns)):
                key = (file, start)
                if key not in states:
                    in_string, depth, listed, since = begin[key]
                    walker = Walker(in_string, depth)
                    walker.lists[1] = listed
                    states[key] = [walker, since, []]
                walker, since, held = states[key]
                text, opened = segment + "}", 0 if since >= 0 else None
                for place, before, after in walker.steps(segment):
                    if not walker.lists.get(1):
                        continue
                    if before == LIST_DEPTH and after > before and text[place] == "{":
                        opened, since = place, start
                    elif after == LIST_DEPTH and opened is not None:
                        held.append(text[opened : place + 1])
                        out.append((file, since, start, "".join(held), since == start))
                        held.clear()
                        opened, since = None, -1
                if opened is not None:
                    held.append(text[opened:])
                states[key][1] = since
            if out:
                yield batch_of(out)
        rest = [(file, since, start, "".join(held), False) for (file, start), (_, since, held) in states.items() if held]
        if rest:
            yield batch_of(rest)

    return run


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (text): the JSON text of every feature in the collections at ``path``."""
    share_package(spark)
    segments = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    notes = segments.mapInArrow(_notes, "file string, start long, outside string, inside string").collect()  # one row per range
    schema = "file string, since long, start long, text string, whole boolean"
    cut = segments.mapInArrow(_cutter(beginnings(notes)), schema)
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))  # one feature
    joined = cut.filter(~F.col("whole")).groupBy("file", "since").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    return cut.filter("whole").select("text").unionByName(joined.select("text"))
