"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

pytest.importorskip("outcomelens.llm.common")

from outcomelens.llm import (  # noqa: E402
    automaton_dedup,
    bpe_heap,
    dac_tokens,
    es_mixing,
    fertility,
    simhash_ball,
    suffix_decontam,
    viterbi_langid,
    warc_zip,
    zstd_quality,
)

public_tokenizers = pytest.importorskip("public_tokenizers")

LONG = " ".join(f"word{i % 977} filler{i % 31}" for i in range(40_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from here again"
#: doc_id, text, lang, source, n_chars, and columns named like the operators' own.
ROWS = [
    (1, PLAIN, "en", "a", 1, "x", 1),
    (2, PLAIN, "en", "a", 1, None, 2),
    (2, PLAIN, "en", "a", 1, None, 2),
    (3, "", "en", None, 0, "y", 3),
    (4, None, None, None, None, None, None),
    (5, " \n\t ", "fr", "b", 3, "z", 4),
    (6, LONG, "en", "b", len(LONG), "z", 5),
    (7, "été où ça là ère " * 20, "fr", "c", 9, "z", 6),
    (None, PLAIN, "en", "c", 9, "z", 7),
    (None, None, None, None, None, None, None),
    (8, "1234 5678 %%% !!!", None, "c", 9, "z", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, taken long"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "docs")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1 ----------------------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    page = "<p>" + "x" * 200
    rows = [(1, "http://a/ b\r\n", page, 1), (2, None, page, 1), (2, None, page, 1), (3, "u", None, 1), (4, "u", "", 1)]
    rows += [(5, "u", "short", 1), (6, "u", "short", 1), (None, "u", page, 1), (7, "é", "y" * 3_000_000, 1), (8, "é", "y" * 3_000_000, 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes long").write.parquet(str(tmp_path / "p"))
    read = warc_zip.read_archives(warc_zip.write_archives(spark.read.parquet(str(tmp_path / "p")), package_bytes=1000))
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in read.collect()), key=repr)
    want = [(1, "response", None, 203), (2, "revisit", 1, 203), (2, "revisit", 1, 203), (3, "response", None, 0), (4, "response", None, 0)]
    want += [(5, "response", None, 5), (6, "response", None, 5), (None, "revisit", 1, 203), (7, "response", None, 3_000_000), (8, "revisit", 7, 3_000_000)]
    assert got == sorted(want, key=repr)
    assert {r.payload_digest for r in read.filter("page_id < 3").collect()} == {hashlib.sha256(page.encode()).hexdigest()}
    assert bytes(read.filter("page_id = 1").first().payload) == page.encode()


def test_repeated_pages_have_one_response(spark, tmp_path):
    rows = [(3, "u", "z" * 100)] * 3
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    read = warc_zip.read_archives(warc_zip.write_archives(spark.read.parquet(str(tmp_path / "p"))))
    assert sorted((r.record_type, r.refers_to) for r in read.collect() if r.refers_to) == [("revisit", 3)] * 2
    assert read.filter("record_type = 'response'").count() == 1


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.read_archives(warc_zip.write_archives(empty)).count() == 0


# 2 ----------------------------------------------------------------------------------------


def test_near_duplicates(docs, none):
    found = simhash_ball.near_duplicates(docs)
    rows = found.collect()
    assert len(rows) == len(ROWS)
    component = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert component[2] == component[1] == 1 and component[6] == 6 and component[7] == 7
    assert component[4] == component[5] == component[3] == 3  # no words: fingerprint zero
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 3}
    kept = simhash_ball.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in rows})
    assert simhash_ball.near_duplicates(none).count() == 0 and simhash_ball.keep_one(none).count() == 0


# 3 ----------------------------------------------------------------------------------------


def test_decontaminate(spark, docs, none):
    items = [("i1", "The quick, brown FOX jumps over the lazy dog and runs far."), ("i2", None), ("i3", ""), ("i1", "lazy dog"), (None, "été où")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for words in (2_000_000, 3):  # one block, and one per item
        found = suffix_decontam.search(docs, bench, block_words=words)
        rows = [(r.doc.doc_id, r.n_hit, sorted(m.item_id for m in r.matches)) for r in found.collect()]
        assert len(rows) == len(ROWS)
        by = {k: (n, m) for k, n, m in rows if k is not None}
        assert by[1] == by[2] == (12, ["i1"])
        assert by[7] == (40, [""]) and by[3] == by[4] == by[5] == by[6] == (0, [])
    longest = {m.item_id: m for m in suffix_decontam.search(docs, bench).filter("doc.doc_id = 1").first().matches}
    assert (longest["i1"].words, longest["i1"].doc_start, longest["i1"].item_start) == (12, 0, 0)
    clean = suffix_decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {3, 4, 5, 6, 8, None}
    assert suffix_decontam.decontaminate(docs, bench.limit(0)).count() == len(ROWS)
    assert suffix_decontam.search(none, bench).count() == 0


# 4 ----------------------------------------------------------------------------------------


def test_fertility(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = fertility.judge(docs, path).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc.doc_id: r for r in rows if r.doc.doc_id is not None}
    for k in (3, 4, 5):
        assert (by[k].n_words, by[k].word_chars, by[k].base_failed, by[k].kept) == (0, 0, True, False)
    assert by[6].n_words == 80_000 and by[7].n_repeat_words == 100 and by[7].base_failed
    assert by[8].n_symbols == 3 and by[8].doc.score == "z"
    assert fertility.judge(none, path).count() == 0


def test_base_measures():
    text = "a b\nc d\na b\n \n \na b c"
    words = text.encode().split()
    assert fertility.base_measures(text, words) == (9, 0, 1, 6)
    assert fertility.base_measures("x\n\nx\nx ", [b"x"] * 3)[2] == 1


# 5 ----------------------------------------------------------------------------------------


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = dac_tokens.read_tokens(dac_tokens.write_tokens(docs, path, file_ids=500)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    texts = {r[0]: r[1] for r in ROWS if r[0] is not None}
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id is not None:
            ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
            raw = b"".join(i.to_bytes(4, "little") for i in ids)
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(raw))
    assert dac_tokens.read_tokens(dac_tokens.write_tokens(none, path)).count() == 0


# 6 ----------------------------------------------------------------------------------------


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (6, 1), (6, None), (7, 0), (None, 1), (9, 1)], "doc_id long, quality int")
    model = zstd_quality.learn(docs, labels)
    rows = zstd_quality.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert len({r.score for r in rows if not r.doc.text}) == 1
    assert zstd_quality.learn(docs, labels.limit(0)) is None
    assert {r.score for r in zstd_quality.score(docs, None).collect()} == {0.5}
    assert zstd_quality.score(none, model).count() == 0 and zstd_quality.learn(none, labels) is None


# 7 ----------------------------------------------------------------------------------------


def test_token_counts(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = bpe_heap.count_tokens(docs, path).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = r.doc.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 2048)
    assert bpe_heap.count_tokens(none, path).count() == 0


# 8 ----------------------------------------------------------------------------------------


def test_language(docs, none):
    model = viterbi_langid.learn(docs)
    rows = viterbi_langid.identify(docs, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if not r.doc.text or not any(c.isalpha() for c in r.doc.text):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
        else:
            assert r.lang_pred == r.doc.lang and 0 < r.score <= 1
    assert viterbi_langid.identify(none, model).count() == 0
    untaught = viterbi_langid.learn(none)
    assert {r.lang_pred for r in viterbi_langid.identify(docs, untaught).collect()} == {"und"}


# 9 ----------------------------------------------------------------------------------------


def test_repeats(docs, none):
    rows = automaton_dedup.remove_repeats(docs).collect()
    assert len(rows) == len(ROWS)
    words = len(PLAIN.split())
    for r in rows:
        copies = r.doc.text == PLAIN and r.doc.doc_id != 1
        own = len((r.doc.text or "").encode().split())
        assert (r.n_words, r.n_removed) == (own, words if copies else 0)
        assert r.kept_text == ("" if copies else " ".join((r.doc.text or "").split()))
    assert automaton_dedup.remove_repeats(none).count() == 0


def test_frequent_line_fills_no_shard(spark, tmp_path, monkeypatch):
    """A 9-word line in different surroundings, and true repeats around it in every third document."""
    rng = random.Random(9)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, around = [f"line{i}" for i in range(9)], some(12)
    texts = [some(15) + line + (around[: 2 + i % 9] if i % 3 == 0 else some(9)) + some(15) for i in range(300)]
    texts += [texts[7], texts[0] + ["end"]]
    seen: dict[tuple, int] = {}
    for i, words in enumerate(texts):
        for j in range(len(words) - 12):
            seen.setdefault(tuple(words[j : j + 13]), i)
    runs = [{j + k for j in range(len(w) - 12) if seen[tuple(w[j : j + 13])] < i for k in range(13)} for i, w in enumerate(texts)]
    path = str(tmp_path / "d")
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").write.parquet(path)
    stored, store = {}, automaton_dedup.materialise
    monkeypatch.setattr(automaton_dedup, "materialise", lambda df, name, *path: stored.setdefault(name, store(df, name, *path)))
    got = {r.doc.doc_id: r for r in automaton_dedup.remove_repeats(spark.read.parquet(path)).collect()}
    for i, words in enumerate(texts):
        assert (got[i].n_removed, got[i].kept_text) == (len(runs[i]), " ".join(w for k, w in enumerate(words) if k not in runs[i]))
    # The line makes candidates of runs in most documents; surroundings of their own never reach a shard.
    assert stored["segments"].count() >= 200
    assert stored["matched"].groupBy("shard").count().agg({"count": "max"}).first()[0] <= 39


def test_periodic_texts_fill_no_shard(spark, tmp_path, monkeypatch):
    """One word repeated, in many lengths: passages are cut to pieces of few kinds, and the longest earlier text decides."""
    path = str(tmp_path / "d")
    lengths = [20, 150, 13, 12, 700, 90] + list(range(100, 400, 3))
    spark.createDataFrame([(i, "x " * n) for i, n in enumerate(lengths)], "doc_id long, text string").write.parquet(path)
    stored, store = {}, automaton_dedup.materialise
    monkeypatch.setattr(automaton_dedup, "materialise", lambda df, name, *path: stored.setdefault(name, store(df, name, *path)))
    got = {r.doc.doc_id: r.n_removed for r in automaton_dedup.remove_repeats(spark.read.parquet(path)).collect()}
    assert got == {i: n if i and n >= 13 else 0 for i, n in enumerate(lengths)}
    assert stored["matched"].groupBy("shard").count().agg({"count": "max"}).first()[0] <= automaton_dedup.SLICE


# 10 ---------------------------------------------------------------------------------------


def test_mix(docs, none):
    first, again = (plain(es_mixing.mix(docs).select("doc.doc_id", "size", "source_size", "target", "times", "taken")) for _ in range(2))
    assert first == again and len(first) == len(ROWS)
    assert all(taken == size * times and 0 <= times <= 2 for _, size, _, _, times, taken in first)
    by_source: dict = {}
    for (_, size, source_size, target, _, taken), _row in zip(first, first):
        by_source.setdefault((source_size, target), []).append((size, taken))
    for (source_size, target), parts in by_source.items():
        assert sum(s for s, _ in parts) % max(source_size, 1) == 0
        assert target <= 2 * source_size
    assert es_mixing.mix(none).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5}, {"a": 0}, {"a": 7, "b": 0, "c": 90, "d": 3}])
def test_targets_reshare_what_is_cut_off(spark, sizes):
    got = {r.source: r.target for r in es_mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:  # share, cut off, share the excess again
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= over
    assert got == pytest.approx(want)
