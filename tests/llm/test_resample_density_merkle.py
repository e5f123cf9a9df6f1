"""Resampling, main text and manifest against plain-Python versions and on awkward rows."""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("outcomelens.llm.common")

from pyspark.sql import functions as F  # noqa: E402

from outcomelens.llm import gain_resample, merkle_manifest, text_density  # noqa: E402
from tests.llm.test_edge_cases import ROWS, SCHEMA  # noqa: E402

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


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


# resampling -------------------------------------------------------------------------------


def runs(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, targets, longest=1, buckets=10_000, percent=10, least=20):
    """{(doc_id, text): (n_features, weight, score)} and the drawn (score, id) pairs in order."""
    code = lambda f: zlib.crc32(f.encode()) % buckets
    raw, target = Counter(), Counter()
    for _, text in rows:
        raw.update(map(code, runs(text, longest)[1]))
    for text in targets:
        target.update(map(code, runs(text, longest)[1]))
    s_all, t_all = sum(raw.values()), sum(target.values())
    gain = {
        b: math.floor(1000 * math.log((target[b] + 1.0) * (s_all + float(buckets)) / ((raw[b] + 1.0) * (t_all + float(buckets)))))
        for b in set(raw) | set(target)
    }
    found, eligible = {}, []
    for doc_id, text in rows:
        n_words, features = runs(text, longest)
        weight = sum(gain[code(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found[doc_id, text] = len(features), weight, score
        if n_words >= least:
            eligible.append((-score, doc_id is None, doc_id or 0))
    return found, sorted(eligible)[: percent * len(eligible) // 100]


@pytest.mark.parametrize("longest,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 50, 0), (2, 70_000, 100, 5)])
def test_resample_is_plain_resample(docs, spark, longest, buckets, percent, least):
    targets = [r[1] for r in ROWS[:3]] + [None, "", "Other WORDS here 42"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = gain_resample.resample(docs, target, longest=longest, buckets=buckets, percent=percent, least_words=least).collect()
    found, drawn = plain_resample([(r[0], r[1]) for r in ROWS], targets, longest, buckets, percent, least)
    assert len(got) == len(ROWS)
    assert all((r.n_features, r.weight, r.score) == found[r.doc.doc_id, r.doc.text] for r in got)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r.score, r.doc.doc_id is None, r.doc.doc_id or 0) for r in ranked] == drawn
    assert {r.doc.score for r in got} == {r[5] for r in ROWS}  # the input's own column


def test_resample_of_nothing(docs, none):
    assert gain_resample.resample(none, docs).count() == 0
    got = gain_resample.resample(docs, none, least_words=10**9).collect()
    assert len(got) == len(ROWS) and all(r["rank"] is None for r in got)


def test_equal_scores_rank_by_id_over_many_ranges(spark, tmp_path):
    rows = [(i * 7919 % 5_000, "few same words", i % 3) for i in range(5_000)]
    spark.createDataFrame(rows, "doc_id long, text string, score long").write.parquet(str(tmp_path / "t"))
    got = gain_resample.highest(spark.read.parquet(str(tmp_path / "t")), F.lit(True), 50, F.col("doc_id")).collect()
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, 2_501))
    wanted = sorted((-s, i) for i, _, s in rows)[:2_500]
    assert [(-r.score, r.doc_id) for r in ranked] == wanted


@pytest.mark.parametrize("size", [1, 2, 7, 1 << 16])
def test_pieces_cut_no_word(size):
    text = "ab c " * 50 + "x" * 300 + " é日本 \x00 end" + "-" * 20
    parts = list(gain_resample.pieces(text, size))
    assert "".join(parts) == text
    assert [w for p in parts for w in WORD.findall(p)] == WORD.findall(text)


def test_runs_go_on_over_pieces(monkeypatch):
    text = " ".join(f"w{i % 5}" for i in range(200))
    whole = gain_resample.Featurizer(1, 3, 997).codes(text.encode())
    monkeypatch.setattr(gain_resample.pieces, "__defaults__", (10,))
    cut = gain_resample.Featurizer(1, 3, 997).codes(text.encode())
    assert whole[0] == cut[0] and Counter(whole[1].tolist()) == Counter(cut[1].tolist())


# main text --------------------------------------------------------------------------------

SAID = "The quick brown fox jumps over the lazy dog and runs on through the wide dark forest. "
ARTICLE = f"<h1>A title</h1><p>{SAID}</p><p>{SAID} <a href=x>more</a>.</p><ul><li>one<li>two</ul>"
PLAIN = f"A title {SAID}{SAID}more. one two".replace(".  more", ". more")
AROUND = {
    "article": "<nav><a href=/>Home</a></nav><article>{}</article><footer>&copy; us</footer>",
    "main": "<header>Site</header><main>{}</main><aside>side</aside>",
    "classes": "<div class='top-nav'>Home</div><div class='content with-sidebar'>{}</div><div id=sidebar><p>side</p></div>",
    "comments": "<div class=post>{}</div><section id='comments'><p>" + SAID * 9 + "</p></section>",
    "nested comments": "<article>{}<div class='comment-list'><article class=comment><p>" + SAID * 9 + "</p></article></div></article>",
    "advert": "<div class=ad>BUY</div><article>{}<div class='ad-box'>BUY</div><script>var t='</p>'</script></article>",
    "form": "<form action=/><input><article>{}<form>Your name <input></form></article></form>",
    "notice": "<div class='cookie-notice'>" + SAID * 3 + "</div><article>{}</article><div role=alert>" + SAID * 3 + "</div>",
    "no names": "<div><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div><div>{}</div><div><a href=4>Next</a></div>",
    "no body": "{}",
    "cut off": "<nav><ul><li><a href=1>x</a></ul></nav><article>{}",
}


@pytest.mark.parametrize("name", AROUND)
def test_article_is_found(name):
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{AROUND[name].format(ARTICLE)}"
    assert text_density.main_text(page) == " ".join(PLAIN.split())


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("only &amp; text &amp;amp; &lt;b&gt; &nbsp; &eacute", "only & text &amp; <b> é"),
        ("<p>a<b>b</b>c<p>d<br>e\n\t f", "abc d e f"),
        ("<article><p>x<table><tr><td>1<td>2<tr><td>3</table>y</article>", "x 1 2 3 y"),
        ("<article><b><p>one</p>two</article> <footer>three", "one two"),
        ("<article>a < b and c > d <![if x]>e<!-- no --></article>", "a < b and c > d e"),
        ("<div>" * 3_000 + "deep", "deep"),
        ("<script>x</script><!-- y -->", ""),
    ],
)
def test_text_of_odd_markup(page, text):
    assert text_density.main_text(page) == text


def test_broken_markup_ends():
    random.seed(3)
    parts = "< > / </ <! <![ [ ] -- <p> </p> <script> </script> <table> <td> <li> <a> & &# x41 ; = class ad ' \" a".split()
    for _ in range(3_000):
        text_density.main_text("".join(random.choice(parts) for _ in range(40)))


def test_pages_of_the_table(spark, sf):
    """Of the given pages, whose markup is known, a plain version gives the same text."""
    for row in text_density.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        inner = re.search(r"(?s)<article>(.*)</article>", row.doc.html or "")
        spaced = re.sub(r"</?(p|h1|br)[^>]*>", " ", inner.group(1)) if inner else ""
        text = " ".join(html_lib.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", spaced)).split())
        assert (row.text, row.n_chars) == (text, len(text))


def test_extract_passes_rows_on(spark):
    rows = [(None, None, None, 5), (1, "u", "", 6), (1, "u", "<p>x", 7), (1, "u", "<p>x", 7), (2, None, "<p>" + SAID * 9_000, 8)]
    got = text_density.extract(spark.createDataFrame(rows, "page_id long, text string, html string, n_chars long")).collect()
    found = sorted(((r.doc.page_id, r.doc.n_chars, r.text) for r in got), key=str)
    wanted = [(None, 5, ""), (1, 6, ""), (1, 7, "x"), (1, 7, "x"), (2, 8, (SAID * 9_000).strip())]
    assert found == sorted(wanted, key=str)
    assert text_density.extract(spark.createDataFrame([], "html string")).count() == 0


# manifest ---------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """Root, and per node its siblings (level by level) and its places."""
    siblings, places = [[] for _ in nodes], [[] for _ in nodes]
    level, members = list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        up, owners = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for j, own in enumerate(members[at : at + 16]):
                for i in own:
                    siblings[i].append(run[:j] + run[j + 1 :])
                    places[i].append(j)
            up.append(sha("".join(run)))
            owners.append([i for own in members[at : at + 16] for i in own])
        level, members = up, owners
    return level[0], siblings, places


def plain_leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_manifest(rows):
    trees: dict = {}
    for row in rows:  # doc_id, text, lang, source, n_chars
        doc_id, text, lang, source, n_chars = row[:5]
        own = plain_leaf(doc_id, source, lang, n_chars, text)
        changed = own
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            changed = plain_leaf(doc_id, source, lang, n_chars, text if text is None else text.translate(LOWER))
        trees.setdefault(source, []).append((doc_id is not None, doc_id or 0, own, changed, doc_id))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in sources:
        trees[s].sort()
        built[s] = plain_tree([leaf[2] for leaf in trees[s]])
    root, upper, upper_places = plain_tree([built[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, own, changed, doc_id) in enumerate(trees[s]):
            path = built[s][1][i] + upper[k]
            folded = changed
            for run, at in zip(path, built[s][2][i] + upper_places[k]):
                folded = sha("".join(run[:at]) + folded + "".join(run[at:]))
            out.append((doc_id, own, built[s][0], root, sha("".join(x for run in path for x in run)), folded, folded == root))
    return out


def manifest_of(table):
    fields = [merkle_manifest.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle_manifest.FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle_manifest.manifest(table, tampered=F.when(chosen, merkle_manifest.leaf(*fields)))


def test_manifest_of_awkward_rows(docs, none):
    assert sorted(map(tuple, manifest_of(docs).collect()), key=str) == sorted(plain_manifest(ROWS), key=str)
    assert manifest_of(none).count() == 0


def test_manifest_over_several_rounds(spark, tmp_path):
    """One source of three blocks, sources at the sizes where levels change, and many of one row."""
    sizes = {"big": 9_001, "block": 4_096, "over": 4_097, "s17": 17, "s16": 16, "s256": 256, "s257": 257, None: 33}
    sizes |= {f"one{i:03d}": 1 for i in range(300)}
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at * 7919 % 50_021, f"Text {at}", None if at % 3 else "en", source, at % 11))
            at += 1
    random.seed(5)
    random.shuffle(rows)
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    got = manifest_of(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows))
    assert 0.7 < sum(r.verified for r in got) / len(got) < 0.9


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4_095, 4_096])
def test_appended_witnesses_fold_to_the_root(n):
    nodes = [sha(str(i)) for i in range(n)]
    tree = merkle_manifest.Appender()
    for node in nodes:
        tree.append(node)
    root = tree.finish(n < merkle_manifest.BLOCK)
    wanted, siblings, _ = plain_tree(nodes)
    assert root == wanted
    for i in {0, n // 2, n - 1}:
        path = list(tree.witness(i))
        assert merkle_manifest.fold(nodes[i], path) == root
        assert merkle_manifest.unpacked_witness(merkle_manifest.packed_witness(path)) == path
        assert merkle_manifest.proof(path) == sha("".join(x for run in siblings[i] for x in run))
