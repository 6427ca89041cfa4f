"""Main text of web pages: site template removal by hashed element subtrees.

A page is read once, by the standard library's parser, to a flat list of texts and breaks, and
elements as ranges of it. Each block element has a hash of its subtree (tags and texts). Spark
counts, per host, the different pages on which a subtree occurs; one that recurs on
``MIN_PAGES`` pages, however many the host has, is a template and is deleted from that host's
pages. The (host, hash) pairs of each page are joined with the templates, so no list of them is
held anywhere. Elements that say what they are (navigation, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) go on any page, by element, role,
class or id; a name alone (whole, or a known compound) never drops what holds the main element, the only
articles, or, on a page without these, more than half of the text.

The article is the ``article`` element with the most text left, else the main element, else
the whole body. What recurs by its nature needs more than a count:

- headings, list items, table cells and captions (``LABELS``): ``PAGE_SHARE`` of the host's pages, as
  "Early life" or "Yes" on a few pages of a large host is no template. A list or table
  that recurs as a whole is one.
- inside the article, only containers (``CONTAINERS``) and blocks that are mostly link text go by the
  count; a passage that many articles quote is still text, unless it is on ``NEARLY_ALL`` pages.
- what holds the article, or more than nine tenths (``MOST``) of the text left, is never a template.

Character references are decoded; white space in a block becomes one space; blocks are joined
by one space in page order.

Edge cases. Null and empty pages give an empty text. Pages that end early, stray end tags and
deep nesting are read as far as they go. A null or odd url is a host of its own (the empty
one). Repeated rows are read alike (a page counts once for its host, however often it is
repeated); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces, drop_staged, stage, texts_of

MIN_PAGES, PAGE_SHARE, LINK_SHARE, NEARLY_ALL, MOST = 4, 0.2, 0.5, 0.9, 0.9
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"script", "style", "template", "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr", "img"}
#: A start tag of the key ends an open element of the value before it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
DROP_TAGS = {"aside", "audio", "button", "canvas", "dialog", "footer", "form", "head", "iframe", "menu", "nav", "noscript",
             "object", "script", "select", "style", "svg", "template", "textarea", "title", "video"}
DROP_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
              "navigation", "search"}
DROP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
              "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "masthead",
              "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo",
              "promoted", "recommended", "related", "replies", "share", "sharing", "sidebar", "signup", "skip", "social",
              "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Words that may stand beside one of ``DROP_WORDS`` in a class or id: site-footer, share-buttons.
BESIDE = {"alert", "area", "articles", "aside", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "col", "column", "container",
          "desktop", "fixed", "form", "global", "group", "header", "heading", "icon", "icons", "id", "inner", "item", "items", "js", "large", "left", "link", "links", "list", "main",
          "media", "message", "mobile", "outer", "overlay", "page", "panel", "policy", "post", "posts", "primary", "reader", "right", "row", "secondary", "section", "site", "slot", "small",
          "stories", "strip", "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper"}
#: Why an element is dropped: for what it is, or for a name alone.
BY_KIND, BY_NAME = 1, 2
ROOTS = {"html", "body", "article", "main"}
#: Blocks that recur by their nature, and blocks that hold others.
LABELS = {"h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "caption", "figcaption", "legend", "summary", "option"}
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "figure", "details", "fieldset", "center", "address", "header"}
#: How a subtree is told to be a template.
BY_COUNT, BY_SHARE, BY_NEARLY_ALL = 0, 1, 2
SPLIT = re.compile(r"[^a-z0-9]+")


def named(names: str) -> bool:
    """A class or id is one of ``DROP_WORDS``, or a compound of them and ``BESIDE`` words and numbers. So
    with-sidebar, has-banner, content-widget or share-price say nothing."""
    for name in names.split():
        parts = [p for p in SPLIT.split(name) if p]
        if any(p in DROP_WORDS for p in parts) and all(p in DROP_WORDS or p in BESIDE or p.isdigit() for p in parts):
            return True
    return False


class Page(HTMLParser):
    """``parts``: texts, and None for a break. ``elements``: [tag, first part, end part, parent,
    dropped (why), main, hash]."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parts: list[str | None] = []
        self.linked: list[bool] = []
        self.elements: list[list] = []
        self.open: list[int] = []
        self.inside: list[hashlib.blake2b] = []
        self.counts: dict[str, int] = {}
        self.feed(html)
        self.close()
        while self.open:
            self.pop()
        if any(e[4] == BY_NAME for e in self.elements):
            self.clear_names()

    def add(self, part: str | None) -> None:
        self.parts.append(part)
        self.linked.append(self.counts.get("a", 0) > 0)

    def pop(self) -> None:
        element = self.elements[self.open.pop()]
        own = self.inside.pop()
        element[2], element[6] = len(self.parts), own.digest()
        self.counts[element[0]] -= 1
        if element[0] not in INLINE:
            self.add(None)
        if self.inside:
            self.inside[-1].update(b"<" + own.digest())

    def pop_through(self, tags: set[str], stop_at_blocks: bool) -> None:
        """End the innermost open element of ``tags``, and what is open in it."""
        if not any(self.counts.get(t) for t in tags):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.elements[self.open[depth]][0]
            if tag in tags:
                while len(self.open) > depth:
                    self.pop()
                return
            if stop_at_blocks and tag not in INLINE:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag not in INLINE
        if tag in ENDS:
            self.pop_through(ENDS[tag], False)
        elif block and tag not in VOID:
            self.pop_through({"p"}, True)
        if block:
            self.add(None)
        if tag in VOID:
            return
        values = {k: (v or "").lower() for k, v in attrs}
        names = f"{values.get('class', '')} {values.get('id', '')}"
        role = values.get("role", "")
        framed = self.counts.get("article") or self.counts.get("main")
        dropped = 0
        if tag in DROP_TAGS or role in DROP_ROLES or tag == "header" and not framed or "hidden" in values:
            dropped = BY_KIND
        elif (tag not in ROOTS or tag == "article" and framed) and named(names):
            dropped = BY_NAME
        main = tag == "main" or role == "main" or values.get("itemprop") == "articlebody"
        parent = self.open[-1] if self.open else -1
        self.open.append(len(self.elements))
        self.elements.append([tag, len(self.parts), None, parent, dropped, main, None])
        self.inside.append(hashlib.blake2b(tag.encode("utf-8", "replace"), digest_size=8))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self.pop_through({tag}, tag in INLINE or tag == "p")

    def handle_data(self, data: str) -> None:
        self.add(data)
        if self.inside:
            self.inside[-1].update(" ".join(data.split()).encode("utf-8", "replace"))

    def kept(self, templates: set[int], why: int = 0) -> list[bool]:
        """Which parts are left without templates and what is dropped (for the reason ``why``, or any)."""
        keep = [True] * len(self.parts)
        until = 0
        for e in self.elements:
            if e[1] >= until and (e[4] and why in (0, e[4]) or templates and int.from_bytes(e[6], "little", signed=True) in templates):
                keep[e[1]:e[2]] = [False] * (e[2] - e[1])
                until = e[2]
        return keep

    def clear_names(self) -> None:
        """Names do not drop what holds a main element, or else the only articles, or else most of the text."""
        def clear(at: int) -> None:
            while at >= 0:
                if self.elements[at][4] == BY_NAME:
                    self.elements[at][4] = 0
                at = self.elements[at][3]

        for n, e in enumerate(self.elements):
            if e[5] and e[4] != BY_KIND:
                clear(n)
        if self.article(self.kept(set())):
            return
        keep = self.kept(set(), BY_KIND)
        sizes = list(accumulate((len(p.strip()) if k and p else 0 for p, k in zip(self.parts, keep)), initial=0))
        size = lambda e: sizes[e[2]] - sizes[e[1]]
        found = [n for n, e in enumerate(self.elements) if e[0] == "article" and size(e)]
        if found:
            clear(max(found, key=lambda n: (size(self.elements[n]), -n)))
            return
        for e in self.elements:
            if e[4] == BY_NAME and 2 * size(e) > sizes[-1]:
                e[4] = 0

    def article(self, keep: list[bool]) -> tuple[int, int] | None:
        """The range of the article, if there is one."""
        sizes = list(accumulate((len(p) if k and p else 0 for p, k in zip(self.parts, keep)), initial=0))
        for wanted in (lambda e: e[0] == "article", lambda e: e[5]):
            found = [e for e in self.elements if wanted(e) and any(keep[e[1]:e[2]])]
            if found:
                best = max(found, key=lambda e: (sizes[e[2]] - sizes[e[1]], -e[1]))
                return best[1], best[2]
        return None

    def candidates(self) -> list[tuple[int, int, int, int]]:
        """Block elements that may be templates: hash, rule, first part, end part."""
        keep = self.kept(set())
        found = self.article(keep)
        a, b = found or (0, 0)
        texts = list(accumulate((len(p.strip()) if p else 0 for p in self.parts), initial=0))
        links = list(accumulate((len(p.strip()) if p and k else 0 for p, k in zip(self.parts, self.linked)), initial=0))
        shown = list(accumulate((len(p.strip()) if p and k else 0 for p, k in zip(self.parts, keep)), initial=0))
        first_shown, end_shown = found or (0, len(self.parts))
        out = []
        for tag, first, end, _, _, _, digest in self.elements:
            size = texts[end] - texts[first]
            if tag in INLINE or tag in ROOTS or not size or not keep[first] or first <= a < b <= end:
                continue
            inside = a <= first < b
            held = shown[min(end, end_shown)] - shown[max(first, first_shown)] if first < end_shown and end > first_shown else 0
            if held > MOST * (shown[end_shown] - shown[first_shown]):
                continue
            if inside and tag not in CONTAINERS and links[end] - links[first] < LINK_SHARE * size:
                rule = BY_NEARLY_ALL
            else:
                rule = BY_SHARE if tag in LABELS and links[end] - links[first] < LINK_SHARE * size else BY_COUNT
            out.append((int.from_bytes(digest, "little", signed=True), rule, first, end))
        return out

    def subtrees(self) -> set[int]:
        """Hashes of the block elements that may be templates."""
        return {c[0] for c in self.candidates()}

    def pieces(self) -> tuple[str, list[tuple[int, int, int, int]]]:
        """The text before templates are deleted, and the candidates: hash, rule, place and length in it
        (no length where they are outside)."""
        keep = self.kept(set())
        a, b = self.article(keep) or (0, len(self.parts))
        shown = [" " if p is None else p if k else "" for p, k in zip(self.parts[a:b], keep[a:b])]
        at = list(accumulate(map(len, shown), initial=0))
        place = lambda part: at[min(max(part, a), b) - a]
        return "".join(shown), [(h, r, place(x), place(y) - place(x)) for h, r, x, y in self.candidates()]

    def text(self, templates: set[int]) -> str:
        keep = self.kept(templates & self.subtrees() if templates else set())
        a, b = self.article(self.kept(set())) or (0, len(self.parts))
        return " ".join("".join(" " if p is None else p for p, k in zip(self.parts[a:b], keep[a:b]) if k or p is None).split())


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


PIECES = "array<struct<hash: long, rule: int, at: int, size: int>>"


def read_pages(rows: DataFrame) -> DataFrame:
    """page_id, url, host, page (hash of its source), text (with all that may be a template), found (PIECES), row."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        htmls = texts_of(batch, "html")
        texts, found = zip(*(Page(h).pieces() for h in htmls), strict=True) if htmls else ((), ())
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("rule", pa.int32()), ("at", pa.int32()), ("size", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"),
             pa.array([hashlib.blake2b(h.encode("utf-8", "replace"), digest_size=16).digest() for h in htmls], pa.binary()),
             pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()),
             pa.array([[dict(zip(("hash", "rule", "at", "size"), x, strict=True)) for x in f] for f in found], kind)],
            ["page_id", "url", "host", "page", "text", "found"])

    kind = rows.schema["page_id"].dataType.simpleString()
    read = rows.mapInArrow(by_pieces(work, "html"), f"page_id {kind}, url string, host string, page binary, text string, found {PIECES}")
    return stage(read.withColumn("row", F.monotonically_increasing_id()), "pages", compression="zstd")


def site_templates(read: DataFrame, min_pages: int = MIN_PAGES, page_share: float = PAGE_SHARE) -> DataFrame:
    """host, hash, rule of the subtrees that are templates by that rule, from ``read_pages``."""
    # Only equal pages can have the same hash, so one of them stands for all.
    pages = read.groupBy("host", "page").agg(F.min("row").alias("row"))
    one = stage(pages.select("host", "row"), "distinct-pages")
    counts = one.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    each = read.select("row", "host", F.explode(F.array_distinct(F.transform("found", lambda x: x["hash"]))).alias("hash"))
    times = each.join(one.select("row"), "row", "left_semi").groupBy("host", "hash").agg(F.count(F.lit(1)).alias("times"))
    many = times.filter(F.col("times") >= min_pages).join(counts, "host")
    share = F.col("times") / F.col("pages")
    rules = F.filter(F.array(F.lit(BY_COUNT), F.when(share >= page_share, F.lit(BY_SHARE)),
                             F.when(share >= NEARLY_ALL, F.lit(BY_NEARLY_ALL))), lambda r: r.isNotNull())
    out = stage(many.select("host", "hash", F.explode(rules).alias("rule")), "templates")
    drop_staged(one)
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
              min_pages: int = MIN_PAGES, page_share: float = PAGE_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    kind = rows.schema["page_id"].dataType.simpleString()
    read = read_pages(rows)
    templates = site_templates(read, min_pages, page_share)
    pairs = read.select("row", "host", F.explode("found").alias("x")).select("row", "host", "x.*").filter("size > 0")
    cuts = stage(pairs.join(templates, ["host", "hash", "rule"]).groupBy("row").agg(
        F.collect_list(F.struct("at", "size")).alias("cuts")), "cuts")
    drop_staged(templates)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [without(t, c or []) for t, c in
                 zip(texts_of(batch, "text"), batch.column("cuts").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"])

    known = read.select("row", "page_id", "url", "text").join(cuts, "row", "left").select("page_id", "url", "text", "cuts")
    return known.mapInArrow(by_pieces(work, "text"), f"page_id {kind}, url string, text string, n_chars long")


def without(text: str, cuts: list[dict]) -> str:
    """The text less the cuts (nested or apart), with single spaces."""
    out, until = [], 0
    for at, size in sorted((c["at"], c["size"]) for c in cuts):
        if at >= until:
            out.append(text[until:at])
        until = max(until, at + size)
    return " ".join(" ".join([*out, text[until:]]).split())
