"""Listing layouts and detail pages."""

import datetime as dt
import html
import json

import pytest
from pyspark.sql import functions as F

from noticeflow.operators.detail import enrich, extract_details
from noticeflow.operators.listing import extract_records, page_items, script_payloads
from noticeflow.schemas import RECORD_FIELDS
from noticeflow.sources.html import has_unusual_reference, may_have_links, usual_unescaped

from .samples import BASE, PAD, detail_sample, link_people, listing, listing_people, script, state_page, state_people

PEOPLE = listing_people(40, 1)
ITEMS = [item for item, _ in PEOPLE]
EDGES = state_people(13, 2)
ANCHORS = link_people(9, 3)
STATE = state_page([edge for edge, _ in EDGES])
LINKS = ('<div class="obituary-list">' + "".join(a for a, _ in ANCHORS) + ANCHORS[0][0] + ANCHORS[0][0].replace('href="', f'href="{BASE}')
         + '<a class="obit-card" href="/other">not this rule</a></div>')
DETAIL, FIELDS = detail_sample(4)
FROM_JSON, FROM_OTHER = PEOPLE[0][1]["deceased_name"], PEOPLE[1][1]["deceased_name"]
FROM_STATE, FROM_LINK = EDGES[0][1]["deceased_name"], ANCHORS[0][1][1]


def records(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    return extract_records(df, BASE).orderBy("page_id", "pos").collect()


def test_json_layout(spark):
    got = records(spark, listing(ITEMS))
    assert [r.asDict() for r in got] == [
        {"page_id": 0, "pos": i, **want, "error": None} for i, (_, want) in enumerate(PEOPLE)]


def test_state_layout(spark):
    got = records(spark, state_page([edge for edge, _ in EDGES], indent=1))
    assert [{k: r[k] for k in EDGES[0][1]} for r in got] == [want for _, want in EDGES]
    other = 'x<script>window.__INITIAL_STATE__={"obituaries":{"edges":[{"node":{"name":{"firstName":"A"}}}]}};'
    assert [r.deceased_name for r in records(spark, other)] == ["A"]


def test_link_layout(spark):
    got = [(r.url, r.deceased_name, r.first_name, r.last_name) for r in records(spark, LINKS)]
    want = [(url, name, name, "") for _, (url, name) in ANCHORS]
    # A repeated address counts once; its absolute form is another address.
    assert got == want + [want[0]]


@pytest.mark.parametrize("page, names", [
    ("<a data-testid='obituary-card' href='/1'>A B</a><a class='obit-card' href='/2'>C</a>", ["A B"]),
    ("<a class='x obit-card' href='/1'><span class='obit-name'>N M</span>rest</a><a href='/obituary/2'>C</a>", ["N M"]),
    ("<div class='obituary-list'><p><a href='/obituary/1'>In</a></p></div><a href='/obituary/2'>Out</a>", ["In"]),
    ("<a href='/obituary/2'>Out</a>", []),
    ("<a class='obit-card'>no address</a>", []),
    ("<!-- <a class='obit-card' href='/1'>hidden</a> -->", []),
    ("<a class='obit-card' href='/1'>A<script>var b = '<i>';</script><br>&amp;B", ["A&B"]),
    ("", []), ("<html><body>Nothing here</body></html>", []), (None, []),
])
def test_link_rules(spark, page, names):
    rows = records(spark, page)
    assert [r.deceased_name for r in rows if r.pos is not None] == names
    assert all(r.error is None for r in rows)
    assert rows, "a page without records still has a row"


#: The rule's words stand behind character references, and a quoted > before them.
HIDDEN = '<a title="x>y" href="&#47;us&#47;obituaries&#47;name&#47;z">Ann Lee</a>'


def test_a_link_that_references_hide(spark):
    assert [r.deceased_name for r in records(spark, HIDDEN) if r.pos is not None] == ["Ann Lee"]


def test_pages_without_a_rules_word_are_not_read(spark):
    pages = ["<a href='/obituary/2'>Out</a>", "<p>text</p>", LINKS, "<a href='/us/obituaries&#x2f;name/1'>A</a>",
             "<A CLASS='Obit-Card' href=x>B</A>", "a & b", "", "<p title='a>b'>it's & <b id=c>more</b></p>", HIDDEN,
             "<p title=\"open <a href='&#47;x'>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in df.select(may_have_links(F.col("html"))).collect()] == [
        False, False, True, True, True, False, False, False, True, True]


def test_layout_order_and_payload_choice(spark):
    good, other = listing(ITEMS[:1]), listing(ITEMS[1:])
    empty = listing([])
    first = lambda page: records(spark, page)[0].deceased_name
    assert first(LINKS + STATE + good) == FROM_JSON
    assert first(LINKS + STATE) == FROM_STATE
    assert first(empty + STATE + LINKS) == FROM_STATE
    assert first(empty + LINKS) == FROM_LINK
    assert first(script("{not json" + PAD) + good) == FROM_JSON
    assert first(script('{"a":1}') + other + good) == FROM_OTHER
    assert first(f"<!-- {other.replace('-->', '')} -->" + good) == FROM_JSON
    assert first(other.replace("application/json", "application/ld+json") + good) == FROM_JSON
    unquoted = good.replace('type="application/json"', "id=x type=application/json")
    assert first(unquoted.replace("<script", "<SCRIPT")) == FROM_JSON
    # Short payloads are skipped, single quotes are no JSON.
    assert first(script('{"obituaryList":{"obituaries":[{"name":{"fullName":"S"}}]}}') + LINKS) == FROM_LINK
    assert first(script(json.dumps({"obituaryList": {"obituaries": ITEMS}}) + " more") + LINKS) == FROM_LINK
    assert first(script(str({"obituaryList": {"obituaries": [{"name": {"fullName": "S"}}]}, "p": PAD})) + LINKS) == FROM_LINK


def test_unescape_before_decoding(spark):
    item = {"name": {"fullName": "Tom &amp; Ann O&#39;Neil &eacute;"}, "p": PAD}
    assert [r.deceased_name for r in records(spark, listing([item]))] == ["Tom & Ann O'Neil é"]
    # A quote reference becomes a bare quote and spoils the payload.
    spoiled = {"name": {"fullName": "A &quot;B&quot; C"}, "p": PAD}
    assert [r.pos for r in records(spark, listing([spoiled]))] == [None]


def test_truncated_state_falls_through(spark):
    state = '<script>window.__INITIAL_STATE__ = {"obituaries":{"edges":[{"node":{"obituaryNoHtml":"a};b"}}]}};</script>'
    assert records(spark, state + LINKS)[0].deceased_name == FROM_LINK


@pytest.mark.parametrize("payload, names, failed", [
    ({"zeta": {"obituaries": [{"name": None}]}, "alpha": {"obituaries": [{"name": {"fullName": "B"}}]}}, [""], False),
    ({"a": {"obituaries": []}, "b": {"obituaries": [{"x": 1}]}, "c": {"obituaries": [{"personId": 1}]}}, [""], False),
    ({"a": [1], "b": "obituaries", "c": None}, [], False),
    ({"obituaryList": {"obituaries": {"k": 1}}, "b": {"obituaries": [{"name": {"fullName": "B"}}]}}, ["B"], False),
    ({"obituaryList": {"obituaries": {"k": 1}}}, [], True),
    ({"obituaryList": {"obituaries": "text"}}, [], True),
    ({"obituaryList": {"obituaries": ""}}, [], False),
    ({"obituaryList": {"obituaries": [None]}}, [], True),
    ({"obituaryList": {"obituaries": ["text"]}}, [], True),
    ([1], [], True), ([], [], False), ("text", [], True), (None, [], True), (7, [], True),
])
def test_other_paths_and_malformed_payloads(spark, payload, names, failed):
    if isinstance(payload, dict):
        payload = {"pad": PAD, **payload}
    rows = records(spark, script(PAD + json.dumps(payload)))
    assert [r.deceased_name for r in rows if r.pos is not None] == names
    assert [r.error is not None for r in rows if r.pos is None] == ([failed] if not names else [])


def details(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return extract_details(df).orderBy("i").collect()


def test_detail_fields(spark):
    samples = [detail_sample(n) for n in range(20)]
    got = details(spark, *[page for page, _ in samples])
    assert [r.asDict() for r in got] == [{"i": i, **want} for i, (_, want) in enumerate(samples)]
    bare = details(spark, "<p>empty page</p>")[0]
    assert (bare.name, bare.text, bare.funeral_home, bare.published, bare.death) == ("", "", None, None, None)


@pytest.mark.parametrize("page, published, death", [
    ("<p class='obit-dates'>no range</p><p class='obituary-dates'>a to May 1, 2020</p>", None, "2020-05-01"),
    ("<p class='obit-dates'>1940 - unknown</p><meta name='death' content='2020-01-01'>", None, None),
    ("<meta property='article:Published_time' content='2020-01-02T03:04:05Z'><meta name='death-date' content='Jan 1, 2020'>",
     "2020-01-02", "2020-01-01"),
    ("<meta name='published' content='2020-01-01'><meta name='published' content='2020-01-05'>", "2020-01-05", None),
    ("<meta name='published' content='2020-01-01'><meta name='published' content='soon'>", None, None),
    ("<meta name='published' content='2020-01-01'><meta name='published' content=''>", "2020-01-01", None),
    ("<meta name='published-death' content='2020-01-01'>", "2020-01-01", None),
])
def test_detail_dates(spark, page, published, death):
    row = details(spark, page)[0]
    assert (row.published and row.published.isoformat(), row.death and row.death.isoformat()) == (published, death)


def test_enrich(spark):
    day, born = dt.date(2026, 3, 2), dt.date(1940, 1, 5)
    base = {f: "" for f in RECORD_FIELDS} | {"published_date": None, "death_date": None, "birth_date": None,
                                           "funeral_home": None}
    thin = base | {"url": "u1", "deceased_name": "List Name", "published_date": day, "birth_date": born,
                   "funeral_home": "List Home", "city": "C"}
    rows = [thin, thin | {"url": "u2"}, thin | {"url": "u3", "obit_text": "has text"}, thin | {"url": "u4"}]
    schema = ", ".join(f"{f} {'date' if f.endswith('_date') else 'string'}" for f in RECORD_FIELDS)
    df = spark.createDataFrame([tuple(r[f] for f in RECORD_FIELDS) for r in rows], schema)
    pages = spark.createDataFrame(
        [("u1", DETAIL, day), ("u3", DETAIL, day), ("u4", "<p>nothing</p>", day), ("u1", "<h1>older</h1>" + PAD * 99, born),
         ("u1", "<h1>undated</h1>", None), ("u9", DETAIL, day)], "url string, html string, fetched_at date")
    got = {r.url: r for r in enrich(df, pages).collect()}
    assert len(got) == 4
    u1 = got["u1"]
    assert (u1.deceased_name, u1.first_name, u1.last_name, u1.obit_text, u1.funeral_home) == (
        FIELDS["name"], FIELDS["name"], "", FIELDS["text"], FIELDS["funeral_home"])
    assert (u1.death_date, u1.published_date, u1.birth_date, u1.city) == (FIELDS["death"], day, born, "C")
    assert (got["u2"].deceased_name, got["u2"].first_name) == ("List Name", "")
    assert (got["u3"].deceased_name, got["u3"].obit_text) == ("List Name", "has text")
    # A page without fields still leads to the name being split.
    assert (got["u4"].deceased_name, got["u4"].first_name, got["u4"].funeral_home) == ("List Name", "List", "List Home")


def test_large_pages(spark):
    items = [ITEMS[0] | {"obitSnippet": "word " * 20_000} for _ in range(30)]
    tag = listing(items).replace("<script ", "<script " + 'data-a="b" ' * 5000)
    links = "".join(f"<a class='obit-card' href='/{i}'><h4>N{i}</h4></a>" for i in range(20_000))
    rows = records(spark, tag, links)
    assert sum(r.page_id == 0 for r in rows) == 30
    assert sum(r.page_id == 1 for r in rows) == 20_000


def test_pages_reach_python_in_small_batches(spark):
    """Arrow batches are bounded by their rows, which for pages is gigabytes; plain functions get 100 rows."""
    pages = spark.range(3).selectExpr("id AS page_id", "'<a class=\"obit-card\" href=\"/x\"><h3>A &eacute; B</h3></a>' AS html")
    for df in (extract_records(pages, "https://x"), extract_details(pages)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_usual_references_are_replaced_as_by_html(spark):
    texts = ["A &amp; B", "&amp;lt; &amp;amp; &lt;b&gt;", "&", "a & b &; &<", "&#39;&#x27;&apos;&nbsp;&quot;", "&lt", "&eacute;", "&#233;",
             "&amp", "&ampx;", "x &\n", "&\r", "&&amp;&", "&notit;", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", has_unusual_reference(F.col("t")).alias("other"), usual_unescaped(F.col("t")).alias("u")).collect()
    assert [r.u for r in rows if not r.other] == [None if r.t is None else html.unescape(r.t) for r in rows if not r.other]
    assert [r.t for r in rows if r.other] == [t for t in texts if t in ("&lt", "&eacute;", "&#233;", "&amp", "&ampx;", "&\r", "&notit;")]


def test_costly_steps_of_payloads_are_bounded(spark):
    """The state object is searched once, and a script's body is not searched by a pattern of its own."""
    pages = spark.createDataFrame([("<p>",)], "html string").repartition(1)
    plan = page_items(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__INITIAL_STATE__") == 1
    assert "(.*)</script$" not in plan


def test_bodies_of_scripts(spark):
    """Spaces of all kinds around a body and its comment marks, quoted > in attributes, characters beyond ASCII."""
    body = '{"obituaryList":{"obituaries":[{"personId":1,"name":{"fullName":"Zoë 😀 &amp; &lt;b&gt;"}}]}}' + " " * 60 + "　"
    attrs = ['type="application/json"', "data-é='>😀' TYPE=application/json", 'x=">" type=\'application/json\' y']
    htmls = [f"<html><SCRIPT {a}>\x1c <!-- {body}-->\xa0</Script></html>" for a in attrs]
    htmls += [f'<script type="Application/json">{body}</script>', f"<!-- <script {attrs[0]}>{body}</script> -->"]
    found = spark.createDataFrame(list(enumerate(htmls)), "i int, html string").select("i", script_payloads(F.col("html")).alias("p"))
    kept = body.rstrip()
    got = {r.i: list(r.p or []) for r in found.collect()}
    assert [got[i] for i in range(5)] == [[kept]] * 3 + [[]] * 2


def test_text_of_silent_elements_is_left_out(spark):
    page = ("<h1>A<template>no<b class=x>no</b></template><style>no</style> &amp; B</h1><div class=obit-body>one"
            "<rt>no<p>no</rt>two<script>no</script></div>three")
    got = extract_details(spark.createDataFrame([(page,)], "html string")).first()
    assert (got.name, got.text) == ("A& B", "one two")
