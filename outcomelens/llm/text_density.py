"""Main text of web pages by composite text density.

A page becomes a tree of elements. What is never part of an article goes first: scripts, styles, menus,
headers, footers, sidebars, forms, and elements whose class, id or role names one of them, an advert, a notice or reader
comments. Every element of the rest has a composite density: characters per tag, raised where few of
its characters and tags are links. An element's density sum is that of its children and own text. The
element of the greatest sum is the core of the article, and the least density on its path from the body is
the threshold that other subtrees have to reach to be content as well.

Two rules keep an article whole. A core inside ``<article>`` (or else ``<main>``) stands for that element with all it holds. On other
pages the headings that lead in to the content and the short blocks between its parts belong to it.

Each page is handled on its own in its task; nothing is shuffled.

Defined results
    Null and empty html, and pages without text: empty text. Pages without tags: their text. Markup may be cut off or nested wrongly:
    open elements end with the page. Character references are decoded once. Any Unicode white space counts as white space.
    Null ids and urls, repeated rows and extra columns of any name pass through; every row is extracted by itself. Pages of any length
    are parsed whole; nesting depth is not limited. Empty table: no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from outcomelens.llm.common import packed, prepare, query, table, texts_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body br button canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object "
    "ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul video".split()
)
#: Tags that are no part of an article.
UNWANTED_TAGS = frozenset(
    "script style noscript template title nav menu header footer aside form button input select option textarea dialog "
    "search iframe object embed applet svg math canvas audio video map".split()
)
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: A class or id is unwanted if one of these begins or ends it.
UNWANTED_NAMES = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising adbox adbanner sponsor sponsored sponsors promo promos promotion banner "
    "nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs pagination pager toc sidebar sidebars rail aside "
    "header masthead topbar footer bottombar colophon copyright legal disclaimer "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall "
    "newsletter subscribe subscription signup login share sharing social follow related recommended recommendations trending widget widgets "
    "form search searchbox searchform skip".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist commentary-list disqus respond replies reply responses discussion".split())
#: Beside these a name speaks of the layout around the article ("with-sidebar").
LAYOUT = frozenset("with has no without main page site layout wrapper wrap container body content article post entry".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: Start tags that end an open element, which is looked for up to the tags that enclose it.
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def unwanted_name(names: str, wanted: frozenset[str] = UNWANTED_NAMES) -> bool:
    """Whether a class or id names something that is no part of an article."""
    for name in names.split():
        parts = _PARTS.findall(_CAMEL.sub("-", name).lower())
        if not parts:
            continue
        if parts[-1] in wanted and not (len(parts) > 1 and parts[0] in ("with", "has", "no", "without")):
            return True
        if parts[0] in wanted and not (len(parts) > 1 and parts[-1] in LAYOUT - {"container", "wrapper", "wrap"}):
            return True
    return False


class Page(HTMLParser):
    """Elements in page order (parents before children) and the text they hold."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.names, self.ends = ["html"], [-1], [("", "")], [0]
        self.texts: list[tuple[int, str]] = []  # (element, text), or (-1, " ") where a block begins or ends
        self.stack = [0]
        self.held = Counter({"html": 1})

    # -- tree

    def _pop(self) -> None:
        i = self.stack.pop()
        tag = self.tags[i]
        self.held[tag] -= 1
        self.ends[i] = len(self.tags)
        if tag in BLOCK:
            self.texts.append((-1, " "))

    def _close(self, tags: Sequence[str], limits: Sequence[str] | frozenset[str]) -> None:
        """End the innermost of ``tags`` and all inside it, unless one of ``limits`` is met before."""
        if not any(self.held[t] for t in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[depth]]
            if tag in tags:
                while len(self.stack) > depth:
                    self._pop()
                return
            if tag in limits:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in _CLOSES_P:
            self._close(("p",), ("td", "th", "caption", "button", "object", "template"))
            if tag in HEADINGS and self.tags[self.stack[-1]] in HEADINGS:
                self._pop()
        elif tag in _SIBLINGS:
            self._close(*_SIBLINGS[tag])
        elif tag == "a":
            self._close(("a",), BLOCK)
        if tag in BLOCK:
            self.texts.append((-1, " "))
        given = dict(attrs)
        i = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.names.append((f"{given.get('class') or ''} {given.get('id') or ''}", (given.get("role") or "").strip().lower()))
        self.ends.append(i + 1)
        if tag not in VOID:
            self.stack.append(i)
            self.held[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends void elements only

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return  # what follows still belongs to the page
        if tag in HEADINGS:
            self._close(tuple(HEADINGS), ("article", "section", "div", "body"))
        else:
            # An inline end tag does not reach over a block.
            self._close((tag,), ("table", "body") if tag in BLOCK else BLOCK)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # "<![" before something unknown is a comment in HTML
            return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        self.texts.append((self.stack[-1], data))

    @classmethod
    def of(cls, html: str) -> Page:
        page = cls()
        page.feed(html)
        page.close()
        while page.stack:
            page._pop()
        return page

    # -- what belongs to an article

    def kept(self) -> list[bool]:
        """Per element, whether it can be part of an article."""
        n = len(self.tags)
        frames = [tag in ("article", "main") for tag in self.tags]  # holds an article or is one
        for i in range(n - 1, 0, -1):
            frames[self.parents[i]] |= frames[i]
        kept = [True] * n
        for i in range(1, n):
            tag, (names, role) = self.tags[i], self.names[i]
            if not kept[self.parents[i]]:
                kept[i] = False
            elif unwanted_name(names, COMMENT_NAMES) and tag not in ("body", "main") and not (frames[i] and tag != "article"):
                kept[i] = False
            elif not frames[i] and tag != "body":
                kept[i] = not (tag in UNWANTED_TAGS or role in UNWANTED_ROLES or (tag not in HEADINGS and unwanted_name(names)))
        return kept

    def main_text(self) -> str:
        kept = self.kept()
        chosen = choose(self, kept)
        parts = [text for i, text in self.texts if i < 0 or chosen[i]]
        return " ".join("".join(parts).split())


# ---- density ---------------------------------------------------------------------------


def densities(page: Page, kept: Sequence[bool]) -> tuple[list[float], list[float], list[int], list[int]]:
    """Composite density, density sum, characters and link characters of every element."""
    n = len(page.tags)
    linked = [False] * n
    for i in range(1, n):
        linked[i] = page.tags[i] == "a" or linked[page.parents[i]]
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    all_chars = all_links = 0
    own: list[list[int]] = [[] for _ in range(n)]
    for i, text in page.texts:
        size = len(" ".join(text.split())) if i >= 0 else 0
        if not size or page.tags[i] in ("script", "style", "title"):
            continue
        all_chars += size
        all_links += size * linked[i]
        if kept[i]:
            chars[i] += size
            links[i] += size * linked[i]
            own[i].append(size)
    for i in range(n - 1, 0, -1):
        if kept[i]:
            up = page.parents[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tags[i] == "a")
    share = all_links / max(all_chars, 1)

    def composite(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        t = max(t, 1)
        if not all_links:
            return c / t  # a page without links
        inside = c / max(lc, 1) * (t / max(lt, 1))
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        # Below e a base would blow up the logarithm; above it links push the density down.
        return c / t * math.log(max(inside, 1.0)) / math.log(max(base, math.e))

    density = [composite(*x) for x in zip(chars, tags, links, link_tags)]
    sums = [sum(composite(c, 1, c * linked[i], int(linked[i])) for c in own[i]) for i in range(n)]
    for i in range(n - 1, 0, -1):
        if kept[i]:
            sums[page.parents[i]] += density[i]
    return density, sums, chars, links


def choose(page: Page, kept: Sequence[bool]) -> list[bool]:
    """Per element, whether its own text is part of the main text."""
    n, tags, parents = len(page.tags), page.tags, page.parents
    density, sums, chars, links = densities(page, kept)
    root = next((i for i in range(n) if tags[i] == "body" and kept[i]), 0)
    if not chars[root]:
        root = 0
    inside = range(root, page.ends[root])
    core = max((i for i in inside if kept[i] and chars[i]), key=lambda i: sums[i], default=root)

    path = [core]
    while path[-1] != root:
        path.append(parents[path[-1]])
    for tag in ("article", "main"):
        whole = [i for i in path if tags[i] == tag]
        if whole:
            return _subtrees(page, kept, [whole[-1]])

    threshold = min(density[i] for i in path)
    best = list(range(n))  # element of the greatest sum in each subtree
    for i in range(page.ends[root] - 1, root, -1):
        if kept[i] and chars[i] and sums[best[i]] >= sums[best[parents[i]]]:
            best[parents[i]] = best[i]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in inside:
        if i != root and kept[i] and chars[i]:
            children[parents[i]].append(i)
    marked = [False] * n
    content, todo = [], [root]
    while todo:
        i = todo.pop()
        if marked[i] or density[i] < threshold:
            continue
        found = best[i]
        if not marked[found]:
            content.append(found)
            for j in range(found, page.ends[found]):
                marked[j] = True
        todo.extend(children[i])
    return _subtrees(page, kept, _joined(page, kept, sorted(content), root, children, chars, links))


def _joined(page, kept, content, root, children, chars, links) -> list[int]:
    """Subtrees of the content, the heading before it and the blocks between its parts, but no lists of links.

    A negative entry -i - 1 stands for the text of element i without its children.
    """
    first, last = content[0], max(page.ends[i] for i in content) - 1
    top = first
    while page.ends[top] <= last:
        top = page.parents[top]  # holds all content
    found, todo, known = [], [top], set(content)
    while todo:
        i = todo.pop()
        if i in known and i != root:
            found.append(i)
        elif i in known or bisect_left(content, i) < bisect_left(content, page.ends[i]):
            found.append(-i - 1)
            todo.extend(children[i])
        elif first <= i <= last and links[i] * 2 <= chars[i]:
            found.append(i)
    heads = [i for i in range(root, first) if page.tags[i] == "h1" and kept[i] and chars[i]]
    return found + heads[-1:]


def _subtrees(page: Page, kept: Sequence[bool], roots: Sequence[int]) -> list[bool]:
    chosen = [False] * len(page.tags)
    for i in roots:
        if i < 0:
            chosen[-i - 1] = True  # its own text only
            continue
        for j in range(i, page.ends[i]):
            chosen[j] = kept[j]
    return chosen


def main_text(html: str) -> str:
    """Main text of a page, its white space turned into single spaces."""
    return Page.of(html).main_text()


# ---- Spark -----------------------------------------------------------------------------


def extract(pages: DataFrame, html: str = "html", carry: Sequence[str] | None = None) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), text and n_chars."""
    prepare(pages.sparkSession)
    rows = packed(pages, carry, __html=html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(raw.decode("utf-8", "replace")) for raw in texts_of(batch.column("__html"))]
            sizes = pa.array([len(t) for t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, pa.string()), sizes], ["doc", "text", "n_chars"])

    schema = T.StructType(
        [rows.schema["doc"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return rows.mapInArrow(run, schema)


@query("op12_main_text")
def op12_main_text(spark, sf_dir):
    found = extract(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return found.select("doc.page_id", "doc.url", "text", "n_chars")
