"""Corpus queries against SQL, brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import itertools
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("outcomelens.llm.common")
public_tokenizers = pytest.importorskip("public_tokenizers")

from outcomelens.llm import automaton_dedup, bpe_heap, dac_tokens, es_mixing, simhash_ball, viterbi_langid, warc_zip  # noqa: E402
from outcomelens.llm.queries import QUERIES, SQL  # noqa: E402
from tests.check_oracle import connect, differences  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), SQL[name]) is None


# 1 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("wide", [False, True])
def test_zip_members_are_found(wide):
    raw = io.BytesIO()
    package = warc_zip.StoredZip(raw, wide)
    members = {f"archive/é{i}.warc.gz": bytes([i % 256]) * i for i in range(300)}
    for name, data in members.items():
        package.add(name, data)
    package.close()
    assert {n: zipfile.ZipFile(raw).read(n) for n in members} == members  # another reader agrees
    found = warc_zip.ZipReader(raw, len(raw.getvalue()))
    assert {n: found.read(found.first_byte(n), m["size"]) for n, m in found.members.items()} == members


def test_foreign_packages_are_read():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        with z.open("big.bin", "w", force_zip64=True) as f:
            f.write(b"stored")
        z.writestr("deflated.txt", b"d" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"a note"
    found = warc_zip.ZipReader(raw, len(raw.getvalue()))
    assert found.read(found.first_byte("big.bin"), 6) == b"stored"
    with pytest.raises(ValueError, match="compressed"):
        found.first_byte("deflated.txt")
    assert list(warc_zip.records_of(raw, len(raw.getvalue()))) == []
    with pytest.raises(ValueError, match="central directory"):
        warc_zip.ZipReader(io.BytesIO(b"x" * 100), 100)


def test_records_survive(tmp_path):
    raw = warc_zip.record("response", "urn:page:1:0", "http://a/\nb", "00", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n\r\n\r\n", "x")
    fields, block = warc_zip.parse_record(raw)
    assert fields["warc-target-uri"] == "http://a/%0Ab" and warc_zip.http_parts(block)[1] == b"\r\n\r\n"


def foreign_record(kind, block, **fields):
    """A record as other writers make it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:0b8c>", "Content-Type": "application/http; msgtype=response"}
    head |= {k.replace("_", "-"): v for k, v in fields.items()} | {"Content-Length": str(len(block))}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def foreign_archive(n=40):
    """Places of the records, the archive's bytes in gzip members and plain, and the payloads."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    records, payloads = [foreign_record("warcinfo", b"software: x\r\n")], []
    for i in range(n):
        payload = f"page {i} ".encode() * (1 + 997 * (i % 5))
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        stated = [{}, {"WARC_Payload_Digest": f"sha1:{sha1}"}, {"WARC_Payload_Digest": "blake9:00"}][i % 3]
        records.append(foreign_record("response", http + payload, WARC_Target_URI=f"http://a/{i}", **stated))
        payloads.append(payload)
    records.append(foreign_record("revisit", http, WARC_Target_URI="http://a/again", WARC_Payload_Digest=f"sha1:{sha1}"))
    packed = [gzip.compress(r) for r in records]
    places, at = [], 0
    for r in packed:
        places.append((at, len(r)))
        at += len(r)
    return places, b"".join(packed), b"".join(records), payloads


def foreign_indexes(places):
    """Fields of index lines by the usual formats; the first record is no page."""
    pages = list(enumerate(places))[1:]
    cdxj = "".join(f'a,{i} 2024 {{"offset": "{o}", "length": "{n}", "filename": "x.warc.gz"}}\n' for i, (o, n) in pages).encode()
    eleven = "".join(f"a,{i} 2024 http://a/{i} text/html 200 AAAA - - {n} {o} x.warc.gz\n" for i, (o, n) in pages).encode()
    nine = "".join(f"a,{i} 2024 http://a/{i} text/html 200 AAAA - {o} x.warc.gz\n" for i, (o, n) in pages).encode()
    return {
        "cdxj": {"indexes/index.cdxj": cdxj},
        "cdx_gz": {"indexes/index.cdx.gz": gzip.compress(cdxj[:999]) + gzip.compress(cdxj[999:]), "indexes/index.idx": b"a 2024 x 0 99\n"},
        "cdx_11": {"indexes/all.cdx": b" CDX N b a m s k r M S V g\n" + eleven},
        "cdx_11_no_header": {"indexes/all.cdx": eleven},
        "cdx_9": {"indexes/all.cdx": nine},
        "two": {"indexes/a.cdx": nine, "indexes/b.cdxj": cdxj},
        "none": {},
    }


@pytest.mark.parametrize("kind", ["cdxj", "cdx_gz", "cdx_11", "cdx_11_no_header", "cdx_9", "two", "none", "plain"])
def test_archives_of_other_writers_are_read(spark, tmp_path, monkeypatch, kind):
    places, packed, plain_bytes, payloads = foreign_archive()
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("archive/x.warc" if kind == "plain" else "archive/x.warc.gz", plain_bytes if kind == "plain" else packed)
        for name, data in foreign_indexes(places).get(kind, {}).items():
            z.writestr(name, data, zipfile.ZIP_DEFLATED if kind == "cdx_11" else zipfile.ZIP_STORED)
    raw = (tmp_path / "p.zip").read_bytes()
    monkeypatch.setattr(warc_zip, "RANGE_BYTES", 777)  # records lie across ranges
    source = io.BytesIO(raw)
    got = [(f.get("warc-target-uri"), *warc_zip.payload_of(f, b)) for _, _, _, f, b in warc_zip.records_of(source, len(raw)) if f["warc-type"] != "warcinfo"]
    want = [(f"http://a/{i}", len(p), hashlib.sha256(p).hexdigest(), p) for i, p in enumerate(payloads)]
    assert sorted(g for g in got if g[3] is not None) == sorted(want)
    assert [g[:2] for g in got if g[3] is None] == [("http://a/again", None)]
    manifest = spark.createDataFrame([(str(tmp_path), str(tmp_path / "p.zip"))], "folder string, path string")
    rows = warc_zip.read_archives(manifest).collect()
    assert sorted((r.url, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in rows if r.record_type == "response") == sorted(want)
    assert len(rows) == len(want) + 1 and {r.page_id for r in rows} == {None} and {r.refers_to for r in rows} == {None}


def test_wrong_digests_and_cut_archives_are_errors():
    for stated in ("sha1:" + "0" * 40, "sha256:" + "0" * 64, "md5:" + "0" * 32):
        raw = foreign_record("response", b"HTTP/1.1 200 OK\r\n\r\nx", WARC_Payload_Digest=stated)
        with pytest.raises(ValueError, match="another digest"):
            warc_zip.payload_of(*warc_zip.parse_record(raw))
    _, packed, plain_bytes, _ = foreign_archive(3)
    for name, data in (("archive/x.warc.gz", packed), ("archive/x.warc", plain_bytes)):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, data[:-40])
        with pytest.raises(ValueError, match="ends"):
            list(warc_zip.records_of(out, len(out.getvalue())))
    with pytest.raises(ValueError, match="index line"):
        list(warc_zip.index_places(b"one two three\n"))


# 2 ----------------------------------------------------------------------------------------


def fingerprint(text):
    import xxhash

    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps, bits):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return dict(zip(ids, label.tolist()))
        label = new


def test_simhash_groups(spark, sf, texts):
    got = {r.doc_id: r for r in QUERIES["op2_simhash_groups"](spark, sf).collect()}
    ids = sorted(texts)
    fps = [fingerprint(texts[i].text) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert {i: got[i].component_id for i in ids} == classes(ids, fps, 3)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_ball_finds_every_component(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):  # chains and clusters at distances around the limit
        for _ in range(rng.randint(0, 6)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    ties = simhash_ball.links(nodes, bits)
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= bits for r in ties.collect())
    root = {r.node: r.root for r in simhash_ball.components(ties).collect()}
    got = {f: root.get(f, f) for f in signed}
    assert got == classes(signed, fps, bits)


# 4 ----------------------------------------------------------------------------------------


def test_fertility_base(spark, sf, texts):
    for r in QUERIES["op4_fertility_rules"](spark, sf).collect():
        text = texts[r.doc_id].text
        words, lines = WORD.findall(text), text.split("\n")
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        again = sum(1 for i, line in enumerate(lines) if WORD.search(line) and line in lines[:i])
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_good_documents_pass_the_bands(spark, sf):
    kept = {r.doc_id: (r.kept, r.base_failed) for r in QUERIES["op4_fertility_rules"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [kept[i][0] for i, q in labels.items() if q == 1 and not kept[i][1]]
    bad = [kept[i][0] for i, q in labels.items() if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5


# 5 and 7 ----------------------------------------------------------------------------------


def odd_texts(n=4_000):
    rng = random.Random(1)
    parts = list("abAB'stmre1 9.,\n\t\r\x0b\x1c\x85\xa0 　é漢<|Σσς²Ⅷ\0") + ["<|endoftext|>", "'s ", "  ", " \n", "THE!!", "İ", "é"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


def test_encoder_equals_library(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = dac_tokens.UnitEncoder(path)
    every = [r.text for r in texts.values()] + odd_texts()
    want = [np.array(e.ids, "<u4").tobytes() for e in codec.library.encode_batch(every, add_special_tokens=False)]
    assert codec.encode(every) == want


def test_counter_equals_library(texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    every = [r.text for r in texts.values()] + odd_texts()
    counter = bpe_heap.MergeCounter(path)
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(every, add_special_tokens=False)]
    assert [counter.count(t) for t in every] == want


def test_token_queries(spark, sf, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for r in QUERIES["op5_token_files"](spark, sf).orderBy("doc_id").collect():
        ids = [*library.encode(texts[r.doc_id].text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    counts = {r.doc_id: r for r in QUERIES["op7_token_counts"](spark, sf).collect()}
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert all(counts[i].n_tokens == len(words.encode(r.text, add_special_tokens=False).ids) for i, r in texts.items())


def test_any_token_is_addressed():
    rng = random.Random(2)
    ids = np.array([rng.choice([0, 3, 255, 256, 70_000, 2**31, 2**32 - 1]) for _ in range(5_000)], np.uint32)
    file = dac_tokens.DacFile(io.BytesIO(dac_tokens.dump(ids, [7, None], np.array([1_000, 5_000]))))
    assert [file.access(i) for i in range(len(ids))] == ids.tolist()
    for _ in range(200):
        a, b = sorted(rng.choices(range(5_001), k=2))
        assert (file.slice(a, b) == ids[a:b]).all()
    assert file.doc_ids() == [7, None] and file.ends().tolist() == [1_000, 5_000]
    with pytest.raises(IndexError):
        file.access(5_000)


# 6 and 8 ----------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.score, labels[r.doc_id]) for r in QUERIES["op6_compression_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, q in rows if q == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([(s >= 0.5) == q for s, q in rows]) > 0.93


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op8_language_id"](spark, sf).collect() if r.held_out]
    assert len(rows) > 300 and np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_viterbi_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, k = rng.integers(1, 7), rng.integers(1, 4)
        scores = -rng.random((n, k)) * 8
        value = lambda p: sum(scores[i, j] for i, j in enumerate(p)) - 5.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(map(value, itertools.product(range(k), repeat=int(n))))
        assert value(viterbi_langid.viterbi(scores, 5.0).tolist()) == pytest.approx(best)


def test_mixed_text_has_spans(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = viterbi_langid.learn(docs)
    one = {r.lang: r.text for r in docs.filter("n_chars between 1000 and 3000").collect()}
    text = " ".join(one["en"].split()[:100] + one["de"].split()[:60])
    spans = viterbi_langid.Labeller(model).label_all([text])[0][2]
    words = {s["lang"]: s["n_words"] for s in spans}
    assert abs(words["en"] - 100) < 12 and abs(words["de"] - 60) < 12


def test_copies_do_not_crowd_out_a_language(spark, tmp_path):
    """One text in 20,000 rows counts once; the other texts of its language are learned from."""
    rng = random.Random(8)
    rows = [("xx", "copied words of one text")] * 20_000
    rows += [("xx", " ".join(rng.choices(["wir", "haben", "nicht", "gesehen", "dass"], k=20)) + f" n{i}") for i in range(129)]
    rows += [("yy", " ".join(rng.choices(["we", "have", "never", "seen", "that"], k=20)) + f" n{i}") for i in range(129)]
    rows += [(None, "no label"), ("yy", None)]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "lang string, text string").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    counted = docs.dropna().withColumn("same", F.xxhash64("lang", "text"))
    for wanted, least in ((1_000, 129), (60, 30)):
        sample = viterbi_langid.sample_of(counted, {"xx": 130, "yy": 129}, wanted).groupBy("lang").count().collect()
        assert all(least <= r["count"] <= 130 for r in sample) and len(sample) == 2
    model = viterbi_langid.learn(docs)
    assert [viterbi_langid.Labeller(model).label_all([t])[0][0] for t in ("wir haben nicht", "we have never")] == ["xx", "yy"]


def test_language_counts_equal_plain_counts(spark, tmp_path):
    """The model against counts made word by word."""
    rows = [("a", "Über den Fluß, über!"), ("a", "über den"), ("b", "привет мир 42"), ("b", "hello")]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows * 3, "lang string, text string").write.parquet(path)
    model = viterbi_langid.learn(spark.read.parquet(path))
    for j, lang in enumerate(("a", "b")):
        counts, scripts = np.zeros(viterbi_langid.BUCKETS), Counter()
        for text in (t for name, t in rows if name == lang):
            for word in filter(None, map(viterbi_langid.letters_of, text.split())):
                scripts[viterbi_langid.script_of(word)] += 1
                for bucket, _ in viterbi_langid.grams_of([word]):
                    np.add.at(counts, bucket, 1)
        want = np.log((1 - viterbi_langid.UNSEEN) * counts / counts.sum() + viterbi_langid.UNSEEN / viterbi_langid.BUCKETS)
        assert np.allclose(model.logp[:, j], want, atol=1e-5)
        assert set(np.flatnonzero(model.scripts[:, j])) == set(scripts)


def test_every_label_is_learned_or_an_error(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(f"l{i:03}", f"word{chr(97 + i % 26)} {i}") for i in range(450)], "lang string, text string").coalesce(2).write.parquet(path)
    docs = spark.read.parquet(path)
    assert len(viterbi_langid.learn(docs).languages) == 450
    with pytest.raises(ValueError, match="more than 449 languages"):
        viterbi_langid.learn(docs, most_languages=449)


def test_scores_kept_by_a_task_are_bounded(monkeypatch):
    rng = np.random.default_rng(8)
    model = viterbi_langid.LanguageModel(["a", "b"], rng.normal(size=(viterbi_langid.BUCKETS, 2)).astype(np.float32), np.ones((len(viterbi_langid.SCRIPT_NAMES), 2), bool), 0)
    texts = [" ".join(f"w{chr(97 + rng.integers(26))}{chr(97 + rng.integers(26))}" + "x" * int(rng.integers(0, 90)) for _ in range(30)) for _ in range(200)]
    want = [viterbi_langid.Labeller(model).label_all([t])[0] for t in texts]
    monkeypatch.setattr(viterbi_langid, "CACHE_UNITS", 100)
    labeller = viterbi_langid.Labeller(model)
    for text, one in zip(texts, want):
        assert labeller.label_all([text])[0] == one
        assert labeller.used <= 100


# 9 ----------------------------------------------------------------------------------------


def test_automaton_gives_matching_statistics():
    rng = random.Random(4)
    for _ in range(200):
        known = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 20))] for _ in range(4)]
        query = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        automaton = automaton_dedup.Automaton()
        for k in known:
            automaton.add(k)
        runs = {tuple(k[i : i + 4]) for k in known for i in range(len(k) - 3)}
        want = {i + j for i in range(len(query) - 3) if tuple(query[i : i + 4]) in runs for j in range(4)}
        spans = automaton.repeated(query, 4)
        assert {i for a, b in spans for i in range(a, b)} == want
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


# 10 ---------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    rows = QUERIES["op10_source_mix"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.taken % max(r["size"], 1) == 0 and r.taken <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own) / 2 + 1
