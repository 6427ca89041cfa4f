"""Reading elements out of pages: the one step Spark has no expression for.

Pages reach Python in plain functions, which Spark feeds 100 rows at a time: pages are large, and an Arrow
batch of them, bounded by its rows only, would hold thousands. Each page yields a small struct, and
everything after that is Column expressions.
"""

from __future__ import annotations

import html
import re
import sys
from functools import reduce
from operator import or_

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The readers travel to the executors inside the function, so that these need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that are looked for, per field in order of precedence. A test is
# (tag or None, attribute or None, how, value).
LINKS = [
    ("a", "href", "part", "/us/obituaries/name/"),
    ("a", "data-testid", "is", "obituary-card"),
    ("a", "class", "token", "obit-card"),
    ("a", "href", "part", "/obituary/"),  # only inside the list element below
]
LINK_LIST = ("div", "class", "token", "obituary-list")
LABELS = [("h3", None, None, None), ("h4", None, None, None),
          (None, "class", "token", "obit-name"), (None, "data-testid", "is", "obit-name")]
DETAIL = {
    "name": [("h1", "data-testid", "is", "obit-name"), ("h1", "class", "token", "obit-header-name"),
             ("h1", "class", "token", "obituary-name"), ("h1", None, None, None)],
    "dates": [(None, "data-testid", "is", "obit-dates"), (None, "class", "token", "obit-dates"),
              (None, "class", "token", "obituary-dates")],
    "funeral_home": [(None, "data-testid", "is", "funeral-home-name"),
                     (None, "class", "token", "funeral-home-name"),
                     ("a", "href", "part", "funeral-home"), (None, "class", "token", "fh-name")],
    "text": [(None, "data-testid", "is", "obit-text"), (None, "class", "token", "obituary-text"),
             (None, "class", "token", "obit-body"), (None, "class", "token", "obituary-body"),
             ("article", None, None, None)],
}

# Markup rules: elements without content, elements whose text is not shown, start tags
# that end an open element, and how strongly an element resists a stray end tag.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = {"script", "style", "template", "rt", "rp"}
_ENDS = {"a": {"a"}, "li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"},
         "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
for _block in ("article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
               "main nav ol p pre section table ul").split():
    _ENDS[_block] = {"p"}
_HOLD = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180,
         "table": 190, "head": 200, "body": 200, "html": 220}


def _fits(test, tag, attrs) -> bool:
    want_tag, name, how, value = test
    if want_tag and tag != want_tag:
        return False
    if name is None:
        return True
    have = attrs.get(name)
    if have is None:
        return False
    if how == "is":
        return have == value
    return value in have and (how == "part" or value in have.split())


# A comment, a declaration, or a tag with its attributes; quoted values may hold ">".
_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Elements whose content is no markup run to their own end tag.
_RAW_END = {tag: re.compile(rf"</{tag}", re.IGNORECASE) for tag in ("script", "style")}
_HINT = re.compile("class|data-testid", re.IGNORECASE)


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        value = "".join(values)
        found.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return found


class _Reader:
    """Tracks open elements and gathers the text of those a page kind asks for."""

    #: Tags whose attributes are always looked at; others only with a class or test id.
    tags: set[str] = set()

    def __init__(self):
        self.open = []  # per open element: tag, attributes or None, text lists
        self.sinks = 0
        self.silent = 0  # open elements whose text is not shown

    def wanted(self, tag: str, attrs: dict[str, str]) -> list[list[str]]:
        """Text lists that collect the text below this element."""
        raise NotImplementedError

    def read(self, page: str):
        at = start = 0
        while token := _TOKEN.search(page, at):
            at = token.end()
            self._text(page, start, token.start())
            start = at
            closing, tag, raw = token.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
                continue
            self._start(tag, raw)
            if tag in _RAW_END:
                end = _RAW_END[tag].search(page, at)
                at = start = end.start() if end else len(page)
        self._text(page, start, len(page))
        return self

    def _text(self, page: str, start: int, end: int) -> None:
        if not self.sinks or start >= end or self.silent:
            return
        text = page[start:end]
        text = (html.unescape(text) if "&" in text else text).strip()
        if text:
            for _, _, sinks in self.open:
                for sink in sinks:
                    sink.append(text)

    def _start(self, tag: str, raw: str) -> None:
        while self.open and self.open[-1][0] in _ENDS.get(tag, ()):
            self._pop(len(self.open) - 1)
        attrs, sinks = None, []
        if tag in self.tags or _HINT.search(raw):
            attrs = _attributes(raw)
            sinks = self.wanted(tag, attrs)
        if tag not in _VOID:
            self.open.append((tag, attrs, sinks))
            self.sinks += len(sinks)
            self.silent += tag in _SILENT

    def _end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            held = self.open[depth][0]
            if held == tag:
                self._pop(depth)
                return
            if _HOLD.get(held, 100) > _HOLD.get(tag, 100):
                return

    def _pop(self, depth: int) -> None:
        for tag, _, sinks in self.open[depth:]:
            self.sinks -= len(sinks)
            self.silent -= tag in _SILENT
        del self.open[depth:]


class _LinkReader(_Reader):
    """Links of a listing page, by the rule that finds them."""

    tags = {"a", "h3", "h4"}

    def __init__(self):
        super().__init__()
        self.found = [[] for _ in LINKS]  # per rule: [href, link text, label text or None]
        self.inside = []

    def wanted(self, tag, attrs):
        sinks = []
        if any(_fits(test, tag, attrs) for test in LABELS):
            live = {id(sink) for _, _, gathered in self.open for sink in gathered}
            self.inside = [link for link in self.inside if id(link[1]) in live]
            for link in self.inside:
                if link[2] is None:
                    link[2] = []
                    sinks.append(link[2])
        if tag != "a":
            return sinks
        listed = any(a is not None and _fits(LINK_LIST, t, a) for t, a, _ in self.open)
        for rule, test in enumerate(LINKS):
            if _fits(test, tag, attrs) and (rule < 3 or listed):
                link = [attrs.get("href", ""), [], None]
                self.found[rule].append(link)
                sinks.append(link[1])
                self.inside.append(link)
        return sinks

    def links(self) -> list[dict]:
        """Links of the first rule with hits; of equal addresses the first, none blank."""
        hits = next((found for found in self.found if found), [])
        names = {}
        for href, text, label in hits:
            if href:
                names.setdefault(href, "".join(text if label is None else label))
        return [{"href": href, "name": name} for href, name in names.items()]


class _DetailReader(_Reader):
    """Fields of a detail page: for each rule its first element's text."""

    tags = {"h1", "article", "meta", "a"}

    def __init__(self):
        super().__init__()
        self.texts = {(field, i): None for field, tests in DETAIL.items()
                      for i in range(len(tests))}
        self.metas = []

    def wanted(self, tag, attrs):
        if tag == "meta":
            self.metas.append({"key": (attrs.get("property") or attrs.get("name") or "").lower(),
                               "content": attrs.get("content", "")})
        sinks = []
        for (field, i), text in self.texts.items():
            if text is None and _fits(DETAIL[field][i], tag, attrs):
                self.texts[field, i] = []
                sinks.append(self.texts[field, i])
        return sinks

    def fields(self) -> dict:
        def all_of(field, joint):
            return [None if t is None else joint.join(t)
                    for (f, _), t in self.texts.items() if f == field]

        def first_of(field, joint=""):
            return next((t for t in all_of(field, joint) if t is not None), None)

        return {"name": first_of("name"), "funeral_home": first_of("funeral_home"),
                "text": first_of("text", " "),
                "date_texts": [t for t in all_of("dates", "") if t is not None],
                "metas": self.metas}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _TEXTS = T.StringType(), T.ArrayType(T.StringType())
_LINKS_TYPE = T.ArrayType(_struct(href=_S, name=_S))
_FIELDS_TYPE = _struct(name=_S, funeral_home=_S, text=_S, date_texts=_TEXTS,
                       metas=T.ArrayType(_struct(key=_S, content=_S)))


#: A tag up to a character reference in it; a > inside quotes does not end the tag.
_TAG_WITH_REFERENCE = r"""<[^>"'&]*+(?:"[^"&]*+"[^>"'&]*+|'[^'&]*+'[^>"'&]*+)*+(?:&|"[^"]*+&|'[^']*+&|"[^"]*&|'[^']*&)"""


def may_have_links(page: Column) -> Column:
    """False where no link rule can fit: none of the rules' words occurs, and no tag has a
    character reference that could hide one. Such pages need not be sent to Python."""
    lower = F.lower(page)
    marks = [value for _, _, _, value in LINKS[:3]] + [LINK_LIST[3]]
    return reduce(or_, [F.contains(lower, F.lit(m)) for m in marks]) | page.rlike(_TAG_WITH_REFERENCE)


@F.udf(_LINKS_TYPE, useArrow=False)
def page_links(page: str | None) -> list | None:
    """Record links of a listing page in page order."""
    return None if page is None else _LinkReader().read(page).links()


@F.udf(_FIELDS_TYPE, useArrow=False)
def detail_fields(page: str | None) -> dict:
    """Raw fields of a detail page; absent ones are null."""
    if page is None:
        return dict.fromkeys(_FIELDS_TYPE.names)
    return _DetailReader().read(page).fields()


#: The usual character references, of which none makes another; the ampersand comes last.
_USUAL = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'", "&nbsp;": "\xa0", "&amp;": "&"}
_UNUSUAL = rf"&(?!(?:{'|'.join(r[1:] for r in _USUAL)})|[\t\n\f <&;]|\z)"


def has_unusual_reference(text: Column) -> Column:
    """Whether a text may have a character reference that ``usual_unescaped`` does not replace."""
    return F.contains(text, F.lit("&")) & text.rlike(_UNUSUAL)


def usual_unescaped(text: Column) -> Column:
    """The usual character references replaced, without Python. Each is looked for before it is replaced:
    most texts have one or two of them, and a replacement walks the text far slower than a search."""
    def without(t: Column, ref: str) -> Column:
        return F.transform(F.array(t), lambda v: F.when(
            F.contains(v, F.lit(ref)), F.regexp_replace(v, ref, _USUAL[ref])).otherwise(v))[0]

    return F.when(F.contains(text, F.lit("&")), reduce(without, _USUAL, text)).otherwise(text)


@F.udf(_TEXTS, useArrow=False)
def unescaped(payloads: list | None) -> list | None:
    """Character references in embedded payloads replaced."""
    return None if payloads is None else [html.unescape(p) for p in payloads]
