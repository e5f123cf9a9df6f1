"""Every pipeline stage against a brute-force version on its own input, and the whole run against the stages."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

from outcomelens.llm.common import table  # noqa: E402
from tests.llm.test_against_brute_force import WORD, classes, fingerprint  # noqa: E402

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Input and output rows of each stage."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf, "documents"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        found = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, found, docs.collect(), found.collect()
        docs = found
    return out


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def item_windows(text):
    words = ITEM_WORD.findall(lower(text))
    return {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()


def test_columns_stay(stages):
    for name, (docs, found, _, _) in stages.items():
        assert name == "token_files" or found.columns == docs.columns


def test_language_id(stages):
    _, _, before, after = stages["language_id"]
    kept = {r.doc_id for r in after}
    assert len(kept) == len(after)
    assert not any(r.doc_id in kept for r in before if not any(c.isalpha() for c in r.text or ""))
    labelled = [r for r in before if r.lang is not None and any(c.isalpha() for c in r.text or "")]
    assert sum(r.doc_id in kept for r in labelled) >= 0.98 * len(labelled)


def test_near_dedup(stages):
    _, _, before, after = stages["near_dedup"]
    ids = sorted(r.doc_id for r in before)
    by = {r.doc_id: r for r in before}
    assert sorted(r.doc_id for r in after) == sorted(set(classes(ids, [fingerprint(by[i].text) for i in ids], 3).values()))


def test_decontaminate(spark, sf, stages):
    _, _, before, after = stages["decontaminate"]
    windows = set().union(*[item_windows(r.text) for r in table(spark, sf, "benchmark").collect()])
    lengths = {len(w) for w in windows}

    def hit(text):
        words = ITEM_WORD.findall(lower(text))
        return any(tuple(words[i : i + n]) in windows for n in lengths for i in range(len(words) - n + 1))

    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not hit(r.text))


def test_mix_sources(stages):
    _, _, before, after = stages["mix_sources"]
    times, size = Counter(r.doc_id for r in after), {r.doc_id: len(WORD.findall(r.text or "")) for r in before}
    assert set(times) <= set(size) and max(times.values()) <= 2
    sources = sorted({r.source for r in before}, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    whole = {s: sum(size[r.doc_id] for r in before if r.source == s) for s in sources}
    target, free, left = {}, set(sources), 1.5 * sum(whole.values())
    while True:  # sources above twice their size leave, and the rest is shared again
        share = {s: left * weights[s] / sum(weights[t] for t in free) for s in free}
        above = {s for s in free if share[s] > 2 * whole[s]}
        target |= {s: 2.0 * whole[s] for s in above} if above else share
        left, free = left - sum(2 * whole[s] for s in above), free - above
        if not above or not free:
            break
    for s in sources:
        own = [r.doc_id for r in before if r.source == s]
        assert abs(sum(times[i] * size[i] for i in own) - target[s]) <= max(size[i] for i in own) / 2 + 1


def test_token_files_and_run(spark, sf, stages):
    from tokenizers import Tokenizer

    _, _, before, after = stages["token_files"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r[c] for c in names) for r in after) == want
    assert sorted(tuple(r[c] for c in names) for r in pipeline.run(spark, sf).collect()) == want


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, weight string, doc string"
ENGLISH = "the quick brown fox jumps over the lazy dog and runs far away from here again"
FRENCH = "le petit chat est dans la maison et il dort sur le lit avec une souris"


def awkward():
    rows = [(i, f"{ENGLISH} number {i} of many others we have seen", "en", "a", i) for i in range(40)]
    rows += [(100 + i, f"{FRENCH} numéro {i} parmi les autres que nous avons", "fr", None, i) for i in range(40)]
    rows += [(1, rows[1][1], "en", "a", 1), (1, rows[1][1], "en", "a", 1), (None, rows[5][1], "en", "b", None)]
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \n ", "fr", "b", 3), (203, "12 34 %%", None, "a", 8)]
    rows += [(204, "word " * 60_000, "en", "b", 9)]
    return [(*r, "own", 7, None, "d") for r in rows]


@pytest.mark.parametrize("rows", [awkward(), []], ids=["awkward", "empty"])
def test_stages_take_awkward_rows(spark, sf, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "docs"))
    docs, seen = spark.read.parquet(str(tmp_path / "docs")), {}
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "token_files" or docs.columns == columns
        seen[name] = docs.collect()
    assert all(r.doc_id not in (200, 201, 202, 203) for r in seen["language_id"])
    assert Counter(r.doc_id for r in seen["near_dedup"]).get(1, 0) <= 1
    if rows:
        assert len(seen["language_id"]) >= 80 and seen["token_files"]
        assert {(r.row, r.size, r.weight, r.doc) for r in seen["mix_sources"]} == {("own", 7, None, "d")}
    else:
        assert not any(seen.values())


def test_keep_one_keeps_columns_of_any_name(spark, tmp_path):
    from outcomelens.llm import simhash_ball

    rows = [(1, ENGLISH, "mine0", 5, "x"), (2, ENGLISH, "mine1", 6, "y"), (3, FRENCH, "mine2", 7, None)]
    spark.createDataFrame(rows, "doc_id long, text string, __row string, row int, gone string").write.parquet(str(tmp_path / "d"))
    kept = simhash_ball.keep_one(spark.read.parquet(str(tmp_path / "d")))
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
