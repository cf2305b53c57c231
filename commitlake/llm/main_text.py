"""Main text of web pages: site templates removed by counting subtrees per host.

Method. Every page becomes a tree of elements, and every subtree gets hashes: one of
its content (tag, class, id, all text) and, where its text may vary, one of its
shape (tag, class, id, the distinct shapes below, texts masked), so that a menu
with other links on each page is still the same menu. Spark counts, for each host,
on how many different pages each subtree stands. Subtrees that recur on many pages
of the host are its template and are deleted from each page.

What guards the article. Copies of one article, and passages that articles share,
recur as well. So the article (``<article>``, else ``<main>`` or the marked body of
an article) is never deleted as a whole, nor are its paragraphs, headings, tables
and quotes; a box inside it, or on a page without an article, must have the same
content on more than half of the host's different articles. Outside the article a
subtree goes when its content or shape is on a fifth of the host's different pages;
either way on ``LEAST_PAGES`` pages at least.

A host with few pages shows no template. So what the markup itself names as no
part of the article goes as well: scripts, styles, forms, menus, footers, asides, and
elements whose class, id or role says navigation, advert, notice, sidebar, sharing
or comments. Where a page has an article, only text in it is kept.

Text: character references are decoded, white space inside a block is one space,
blocks are joined by one space in the order of the page.

Defined results: a null or empty page, or one without text, has an empty text; a page
whose url is null or has no host has no template; pages of one host with the same html count
as one; rows that repeat get equal results; an empty table gives no rows; broken markup is read as
browsers do in the main: unknown end tags are skipped, elements that are left open end with what holds
them, unclosed comments, scripts and tags reach to the end of the page.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name, struct_array

#: A template subtree stands on so many different pages of its host at least, on so
#: large a share outside articles, and inside articles or on pages without one.
LEAST_PAGES, SHARE, SHARE_INSIDE = 3, 0.2, 0.5
#: Hosts whose templates are broadcast at most; more are joined by a shuffle.
BROADCAST_HOSTS = 20_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math select".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
#: Elements that are no part of an article, and those that are none outside of it.
_NO_TEXT = frozenset("head nav footer aside form button dialog menu datalist object canvas audio video map".split()) | _RAW
_OUTSIDE = frozenset(["header"])
#: Words in class, id or role that say the same.
_NAMED = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead "
    "banner topbar ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion "
    "promoted cookie cookies consent gdpr notice notices alert alerts alertdialog dialog popup modal overlay newsletter "
    "subscribe subscription signup login search share sharing social related recommended recommendations comment comments "
    "disqus respond reply replies discussion pagination pager skip form widget widgets toolbar hidden".split()
)
_NAMED_OUTSIDE = frozenset(["header"])
#: Elements whose copies inside an article are never a template.
_PROSE = frozenset("html body article main p h1 h2 h3 h4 h5 h6 blockquote pre table thead tbody tfoot tr td th dl dt dd li caption figcaption".split())
_BLOCK_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li".split()
)
#: A start tag closes an open element of these, up to the nearest of the second.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "body": (("head",), ()),
}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMING = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")
_KINDS = "hash long, inside boolean, print long"


class Page:
    """Elements and texts of a page in its order. For element i: ``tag[i]`` (a text has
    none), ``names[i]``, ``end[i]`` (first number after what it holds), ``text[i]``."""

    def __init__(self, source: str):
        self.tag: list[str | None] = ["#page"]
        self.names: list[tuple[str, ...]] = [()]
        self.parent: list[int] = [-1]
        self.text: list[str] = [""]
        self.end: list[int] = [0]
        self._read(source)
        self.zone = self._zone()

    def _add(self, tag: str | None, names: tuple[str, ...], parent: int, text: str) -> int:
        self.tag.append(tag)
        self.names.append(names)
        self.parent.append(parent)
        self.text.append(text)
        self.end.append(len(self.tag))
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        open_, count = [0], {"#page": 1}
        at, n = 0, len(source)

        def close(upto: int) -> None:
            """Ends the open elements from number ``upto`` of the list on."""
            for i in open_[upto:]:
                self.end[i] = len(self.tag)
                count[self.tag[i]] -= 1
            del open_[upto:]

        def find(tags: tuple[str, ...], border: tuple[str, ...]) -> int:
            if not any(count.get(t) for t in tags):
                return 0
            for k in range(len(open_) - 1, 0, -1):
                t = self.tag[open_[k]]
                if t in tags:
                    return k
                if t in border:
                    return 0
            return 0

        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self._add(None, (), open_[-1], source[at : m.start()])
            at = m.end()
            ending, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if ending:
                k = find((tag,), ())
                if k:
                    close(k)
                elif tag == "br":
                    self._add("br", (), open_[-1], "")
                continue
            if tag in _BLOCK_CLOSES_P and (k := find(("p",), ("td", "th", "table", "button", "caption", "object"))):
                close(k)
            if tag in _CLOSES and (k := find(*_CLOSES[tag])):
                close(k)
            i = self._add(tag, _names(rest) if rest else (), open_[-1], "")
            if tag in _VOID:
                continue
            if tag in _RAW:
                if rest.endswith("/") and tag in ("svg", "math"):
                    continue
                ends = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = ends.end() if ends else n
                continue
            open_.append(i)
            count[tag] = count.get(tag, 0) + 1
        if at < n:
            self._add(None, (), open_[-1], source[at:])
        close(0)

    def _zone(self) -> int:
        """The article's number, 0 where the page has none: of the elements that are
        marked as one, not in a part that is no article's, the one with most text."""
        kinds: dict[str, list[int]] = {"article": [], "main": []}
        skipped = 0
        for i, tag in enumerate(self.tag):
            if tag is None or i == 0:
                continue
            body = "itemprop:articlebody" in self.names[i]
            kind = "article" if tag == "article" or body else "main" if tag == "main" or "role:main" in self.names[i] else None
            if i < skipped:
                continue
            if kind and not (tag == "article" and _named(self.names[i], False)):
                if not any(i < self.end[z] for z in kinds[kind]):
                    kinds[kind].append(i)
            elif tag in ("aside", "footer", "form", "dialog") or (not kind and tag not in ("html", "body") and {"comment", "comments", "sidebar", "related"} & set(self.names[i])):
                if not self._holds(i):
                    skipped = self.end[i]
        for found in kinds.values():
            if found:
                return max(found, key=lambda i: (self._size(i), -i))
        return 0

    def _holds(self, i: int) -> bool:
        """Whether the page's only marked article is below i."""
        inside = sum(t == "article" or t == "main" for t in self.tag[i : self.end[i]])
        return inside > 0 and inside == sum(t == "article" or t == "main" for t in self.tag)

    def _size(self, i: int) -> int:
        """Characters of text below i that are in no link."""
        size, k = 0, i
        while k < self.end[i]:
            if self.tag[k] == "a":
                k = self.end[k]
                continue
            size += len(self.text[k].strip())
            k += 1
        return size

    def hashes(self) -> tuple[list[int], list[int], list[bool]]:
        """Content and shape hash of each element (0: without text), and whether all of
        its text is in links."""
        n = len(self.tag)
        content: list[list[str]] = [[] for _ in range(n)]
        shapes: list[set[str]] = [set() for _ in range(n)]
        whole, shape, linked = [0] * n, [0] * n, [True] * n
        for i in range(n - 1, 0, -1):
            up, tag = self.parent[i], self.tag[i]
            if tag is None:
                words = references.unescape(self.text[i]).split()
                if words:
                    content[up].append(" ".join(words))
                    shapes[up].add("#")
                    linked[up] &= self.tag[up] == "a"
                continue
            if not content[i]:
                continue
            if tag == "a":
                linked[i] = True
            head = "\0".join((tag, *self.names[i]))
            whole[i] = _hash("\1".join([head, *reversed(content[i])]))
            shape[i] = _hash("\2".join([head, *sorted(shapes[i])]))
            content[up].append(f"{whole[i]}")
            shapes[up].add("#" if tag in _INLINE and tag != "a" else f"{shape[i]}")
            linked[up] &= linked[i]
        return whole, shape, linked

    def counted(self) -> list[tuple[int, int, bool]]:
        """Number, hash and whether it stands inside the article (or the page has none)
        of each subtree that may be a template."""
        whole, shape, linked = self.hashes()
        first, last = self.zone, self.end[self.zone]
        out = []
        for i in range(1, len(self.tag)):
            tag = self.tag[i]
            if not whole[i] or tag in _INLINE or tag in ("html", "body", "head"):
                continue
            inside = not first or first <= i < last
            if inside:
                if i != first and tag not in _PROSE:
                    out.append((i, whole[i], True))
                if not first and linked[i] and tag not in _PROSE:
                    out.append((i, shape[i], False))
            elif self.end[i] <= first or i >= last:  # does not hold the article
                out += [(i, whole[i], False), (i, shape[i], False)]
        return out

    def article(self) -> int:
        """A fingerprint of the article's text (or the page's)."""
        z = self.zone
        return _hash(" ".join(" ".join(self.text[z : self.end[z]]).split()))

    def main_text(self, template: set[int]) -> tuple[str, int]:
        """The text, and the number of subtrees deleted as template."""
        found = {i for i, h, inside in self.counted() if (h if inside else ~h) in template} if template else set()
        first, last = self.zone, self.end[self.zone]
        # what holds the article stays, whatever it is called
        holds = set()
        z = first
        while z > 0:
            holds.add(z)
            z = self.parent[z]
        pieces: list[str] = []
        ends: list[int] = []
        deleted, i, n = 0, 1, len(self.tag)
        while i < n:
            while ends and ends[-1] <= i:
                ends.pop()
                pieces.append(" ")
            tag = self.tag[i]
            if tag is None:
                if first <= i < last:
                    pieces.append(references.unescape(self.text[i]))
            elif i in found:
                deleted += 1
                pieces.append(" ")
                i = self.end[i]
                continue
            elif i not in holds and tag not in ("html", "body"):
                inside = bool(first) and first <= i < last
                if tag in _NO_TEXT or (not inside and tag in _OUTSIDE) or (tag != "article" and _named(self.names[i], inside)):
                    if tag not in _INLINE:
                        pieces.append(" ")
                    i = self.end[i]
                    continue
            if tag is not None and tag not in _INLINE:
                pieces.append(" ")
                if self.end[i] > i + 1:
                    ends.append(self.end[i])
            i += 1
        return " ".join("".join(pieces).split()), deleted


def _names(rest: str) -> tuple[str, ...]:
    """The words of class, id and role, and marks of a role or an item's property."""
    out = []
    for m in _NAMING.finditer(rest):
        value = (m[2] or m[3] or m[4] or "").lower()
        kind = m[1].lower()
        if kind in ("role", "itemprop"):
            out.append(f"{kind}:{value.strip()}")
        if kind != "itemprop":
            out += [x for x in _SPLIT.split(value) if x]
    return tuple(out)


def _named(names: tuple[str, ...], inside: bool) -> bool:
    return any(x in _NAMED or (not inside and x in _NAMED_OUTSIDE) for x in names)


def _hash(text: str) -> int:
    """Unsigned, below 2 ** 62, so that its complement tells a second kind of it."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 2 or 1


def _subtrees(source: Column) -> Column:
    """An array of (hash, inside, print) for each page: the subtrees that may be a
    template, each once; hash 0: the page itself. ``print`` tells pages apart (inside
    an article: articles)."""

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            hashes, inside, prints, ends = [], [], [], [0]
            for body in pages.to_pylist():
                if body:
                    page = Page(body)
                    marks = (_hash(body), page.article())
                    for h, own in {(h, own) for _, h, own in page.counted()} | {(0, False), (0, True)}:
                        hashes.append(h)
                        inside.append(own)
                        prints.append(marks[own])
                ends.append(len(hashes))
            each = struct_array({"hash": pa.array(hashes, pa.int64()), "inside": pa.array(inside, pa.bool_()), "print": pa.array(prints, pa.int64())})
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)

    return F.arrow_udf(build, f"array<struct<{_KINDS.replace(' ', ':')}>>".replace(",:", ",")).asNondeterministic()(source)


def templates(pages: DataFrame, host: Column, source: Column) -> DataFrame:
    """host, template: the hashes of the subtrees that recur on each host (those outside
    articles as their complement). Hosts without any have no row."""
    found = pages.select(host.alias("host"), F.explode(_subtrees(source)).alias("s"))
    found = found.where("host IS NOT NULL AND host <> ''").select("host", "s.*")
    # each page or article counts once; both steps add up in the tasks first
    found = found.groupBy("host", "inside", "hash").agg(F.count_distinct("print").alias("n"))
    found = cut(found.where((F.col("n") >= LEAST_PAGES) | (F.col("hash") == 0)))
    every = found.where("hash = 0").select("host", "inside", F.col("n").alias("all"))
    share = F.when(F.col("inside"), F.lit(SHARE_INSIDE)).otherwise(F.lit(SHARE))
    often = found.where("hash <> 0").join(every, ["host", "inside"])
    often = often.where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= share * F.col("all")))
    mark = F.when(F.col("inside"), F.col("hash")).otherwise(F.bitwise_not("hash"))
    return often.groupBy("host").agg(F.collect_set(mark).alias("template"))


def _extract(source: Column, template: Column) -> Column:
    def build(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, known in batches:
            texts, sizes, deleted = [], [], []
            sets = _sets(known)
            for row, body in enumerate(pages.to_pylist()):
                text, n = Page(body).main_text(sets(row)) if body else ("", 0)
                texts.append(text)
                sizes.append(len(text))
                deleted.append(n)
            yield struct_array(
                {"text": pa.array(texts, pa.string()), "n_chars": pa.array(sizes, pa.int64()), "n_template": pa.array(deleted, pa.int64())}
            )

    return F.arrow_udf(build, "text string, n_chars long, n_template long").asNondeterministic()(source, template)


def _sets(known: pa.Array):
    """The set of each row's array; rows of one host mostly follow each other."""
    last: list = [None, set()]

    def get(row: int) -> set[int]:
        own = known[row].values
        if own is None or not len(own):
            return set()
        raw = np.asarray(own).tobytes()
        if raw != last[0]:
            last[:] = [raw, set(own.to_pylist())]
        return last[1]

    return get


def main_text(pages: DataFrame, host: Column, html: str = "html", broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """``pages`` with a column ``main``: struct of text, n_chars (its code points) and
    n_template (subtrees deleted because they recur on the page's host)."""
    source = F.col(html).cast("string")
    known = cut(templates(pages, host, source))
    own, template = (free_name(pages.columns, x) for x in ("site_host", "site_template"))
    known = known.select(F.col("host").alias(own), F.col("template").alias(template))
    if known.count() <= broadcast_hosts:
        known = F.broadcast(known)
    rows = pages.join(known, host == F.col(own), "left")
    return rows.withColumn("main", _extract(source, F.col(template))).drop(own, template)
