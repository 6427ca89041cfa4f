"""Leaks against a plain dynamic programme; classifiers by held-out accuracy; page texts."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from noticeflow.llm import decontaminate as dc
from noticeflow.llm import html_text, language, quality
from noticeflow.llm.common import held_out
from noticeflow.llm.queries import ORACLES, REGISTRY
from tests.llm.test_text_dedup import prose

DIR = "/root/testdata/sf0.001"


def distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1))
    return min(row)


def test_myers():
    r = random.Random(1)
    for _ in range(300):
        p, t = "".join(r.choices("abc", k=r.randint(1, 90))), "".join(r.choices("abc", k=r.randint(0, 120)))
        best, end = dc.best_end(dc.letter_masks(p), len(p), t)
        assert best == distance_in(p, t)
        assert distance_in(p, t[:end]) == best


def damaged(r, text, edits):
    out = list(text)
    for _ in range(edits):
        at = r.randrange(len(out))
        kind = r.choice("ids")
        out[at:at + (kind != "i")] = [] if kind == "d" else [r.choice("xyz")]
    return "".join(out)


@pytest.mark.parametrize("block_chars", [dc.BLOCK_CHARS, 300])
def test_leaks(spark, block_chars):
    r = random.Random(3)
    items = [(i, prose(r, 25)) for i in range(8)] + [(20, "tiny"), (21, None), (22, " ?! "), (0, "other words of item zero again and again")]
    docs = [(0, None), (1, ""), (2, prose(r, 200)), (3, "not-tiny TINY."), (4, "untinyish")]
    for i, text in items[:8]:
        for edits in (0, 1, 4, 9, 30):
            docs.append((len(docs), f"{prose(r, 40)}. {damaged(r, text.upper(), edits)} {prose(r, 30)}"))
    docs += [docs[7], (None, items[3][1])]
    got = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as distance", "'q' as item_id"),
                        spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars).collect()
    want = []
    for d, text in docs:
        body = dc.normalized(text)
        for i, item in items:
            p = dc.normalized(item)
            if p and body and (n := distance_in(p, body)) <= int(0.06 * len(p)):
                want.append((d, i, n))
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in got), key=repr) == sorted(want, key=repr)
    bodies = {d: dc.normalized(t) for d, t in docs}
    patterns = {(i, dc.normalized(t)) for i, t in items if t}
    for r_ in got:
        part = bodies[r_.doc_id][r_.match_start:r_.match_end]
        assert any(i == r_.item_id and distance_in(p, part) == r_.distance for i, p in patterns)


def test_leaks_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_leaks(docs, none).collect() == []
    assert dc.find_leaks(docs.limit(0), none.union(spark.createDataFrame([(1, "a b c")], none.schema))).collect() == []


def junk(r):
    kind = r.randrange(3)
    if kind == 0:
        return " ".join(w for x in prose(r, 8).split() for w in [x] * 25)
    return " ".join(w.upper() + "!!" if kind == 1 else w + r.choice(["***", "###"]) for w in prose(r, 150).split())


def sentences(r, n):
    return ". ".join(prose(r, 9).capitalize() for _ in range(n)) + "."


def test_quality_learns_and_handles_edges(spark):
    r = random.Random(6)
    rows = [(i, junk(r) if i % 3 == 0 else sentences(r, 15), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "a") for i, t, _ in rows] + [(900, None, "b"), (901, "", "b"), (901, "", "b"), (None, "x" * 200_000, "c")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5000, None), (None, 1), (900, 1)], "doc_id long, quality int")
    out = held_out(labels["doc_id"], 5, 0)
    model = quality.train(docs, labels, exclude=out)
    got = {r_.doc_id: r_.score for r_ in quality.score(docs, model).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == bool(rows[i][2]) for i in held]) >= 0.97
    assert got[900] == pytest.approx(got[901]) and all(0 <= s <= 1 for s in got.values())
    assert quality.score(docs, model).count() == docs.count()
    one = quality.train(docs, labels.filter("quality = 1"))
    assert {round(x.score, 6) for x in quality.score(docs, one).collect()} == {round((sum(q for *_, q in rows) + 2) / (sum(q for *_, q in rows) + 3), 6)}
    nothing = quality.train(docs.limit(0), labels.limit(0))
    assert quality.score(docs.limit(2), nothing).first().score == 0.5
    assert quality.score(docs.limit(0), nothing).collect() == []


def test_quality_of_a_text_does_not_depend_on_its_neighbours():
    r = random.Random(7)
    texts = [sentences(r, 3), "", "a", junk(r), "aaaa " * 5000, sentences(r, 60), "\x00" * 50]
    net = quality.ByteNet()
    alone = np.concatenate([net.scores([t]) for t in texts])
    assert net.scores(texts) == pytest.approx(alone, abs=1e-5)
    first = [quality.symbols([t])[0] for t in texts]
    both, edges = quality.symbols(texts)
    for k, own in enumerate(first):
        assert (both[edges[k] * quality.BLOCK:edges[k + 1] * quality.BLOCK] == own).all()


def test_gradients_match_differences():
    r = random.Random(8)
    net = quality.ByteNet()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    sym, first = quality.symbols([sentences(r, 8), junk(r)])
    y = np.array([1.0, 0.0])

    def loss():
        z = net.forward(sym, first)["logit"].astype(float)
        return float((np.log1p(np.exp(z)) - y * z).mean())

    g = net.gradients(sym, first, y)
    for name, at in (("out", (3,)), ("dense", (2, 5)), ("dense_bias", (4,)), ("out_bias", (0,)), ("filters", (3, 1, 6)), ("filter_bias", (6,))):
        keep = net.p[name][at]
        net.p[name][at] = keep + 1e-4
        up = loss()
        net.p[name][at] = keep - 1e-4
        down = loss()
        net.p[name][at] = keep
        assert g[name][at] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=5e-4)


def kneser_ney(counts, order, letters):
    """Plain recursive form over (context, letter) dictionaries."""
    tables = [{} for _ in range(order)]
    for word, n in counts.items():
        marked = "\t" * (order - 1) + word + "\n"
        for i in range(order - 1, len(marked)):
            gram = marked[i - order + 1:i + 1]
            tables[-1][gram] = tables[-1].get(gram, 0) + n
    for n in range(order - 2, -1, -1):
        for gram in tables[n + 1]:
            tables[n][gram[1:]] = tables[n].get(gram[1:], 0) + 1

    def p(gram):
        if not gram:
            return 1 / letters
        own = tables[len(gram) - 1]
        once, twice = list(own.values()).count(1), list(own.values()).count(2)
        d = once / (once + 2 * twice) if once and twice else 0.5
        same = [v for g, v in own.items() if g[:-1] == gram[:-1]]
        lower = p(gram[1:])
        return lower if not same else max(own.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * lower

    return p


def test_kneser_ney_values():
    r = random.Random(2)
    counts = {"a": language.Counter({"".join(r.choices("abcd", k=r.randint(1, 5))): r.randint(1, 4) for _ in range(60)}),
              "b": language.Counter({"".join(r.choices("cdef", k=r.randint(1, 5))): r.randint(1, 4) for _ in range(40)})}
    models = language.Models(counts)
    for k, lang in enumerate(models.languages):
        p = kneser_ney(counts[lang], language.ORDER, models.letters)
        for word in ("abcd", "cdc", "zz", "dab"):
            marked = "\t" * 3 + word + "\n"
            want = sum(np.log(p(marked[i - 3:i + 1])) for i in range(3, len(marked)))
            assert models.word_rows([word])[0, k] == pytest.approx(want)


def test_language_edges(spark):
    r = random.Random(3)
    rows = [(i, prose(r, 40, "abcde" if i % 2 else "uvwxyz"), "aa" if i % 2 else "uu") for i in range(60)]
    odd = [(900, None, "aa"), (901, "", None), (902, "123 !?", "uu"), (903, "AbC", None), (None, "uvw " * 90_000, "uu"), (1, rows[1][1], "aa")]
    docs = spark.createDataFrame([(*x, "s") for x in rows + odd], "doc_id long, text string, lang string, score string")
    out = held_out(docs["doc_id"], 4, 2)
    got = language.identify(docs, language.train(docs, exclude=out)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {x.doc_id: x for x in got}
    assert all(by_id[i].lang_pred == lang and by_id[i].score > 0.9 for i, _, lang in rows)
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].accepted) == ("und", 0.0, False) for i in (900, 901, 902))
    assert by_id[903].lang_pred == "aa" and by_id[None].lang_pred == "uu"
    none = language.train(docs.limit(0))
    assert {x.lang_pred for x in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), none).collect() == []


def test_held_out_accuracy(spark):
    langs = dict(duckdb.sql(f"select doc_id, lang from '{DIR}/documents.parquet'").fetchall())
    got = [x for x in REGISTRY["op3_language"](spark, DIR).collect()]
    held = [x for x in got if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert all(x.held_out == (x in held) for x in got)
    assert np.mean([x.lang_pred == langs[x.doc_id] for x in held]) >= 0.97


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    names = [c[0] for c in rel.description]
    df = REGISTRY[name](spark, DIR)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(rel.fetchall())


PAGES = [
    ("", ""),
    ("<p>a<p>b <i>c</i>d", "a b cd"),
    ("</p></div>x <b>y", "x y"),
    ("<nav>m</nav><p>t &amp; u&nbsp;&eacute;&#65;&am</p><footer>f</footer>", "t & u éA&am"),
    ("<main><h1>T</h1><p>x</main><div class='cookie-notice'>c</div>", "T x"),
    ("<article><p>x<aside>y</aside>z<section id=comments>c</section></article><article>s</article>", "x z"),
    ("<header>h</header><article><header><h1>T</h1></header>b</article>", "T b"),
    ("<div role='main'>m\n\t n</div><div class=ads>q</div><form>w<input></form>", "m n"),
    ("<table><tr><td>1<td>2<tr><td>3</table><ul><li>a<li>b</ul>", "1 2 3 a b"),
    ("<script>if(a<b){}</script>k<style>p{}</style><!-- c -->l", "kl"),
    ("<div>" * 3000 + "deep", "deep"),
    ("no tags " * 20_000, " ".join(["no tags"] * 20_000)),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_page(html, text):
    assert html_text.Page(html).text(set()) == text


def test_templates(spark):
    rows = []
    for i in range(12):
        teaser = "<div><p>Subscribe now to our letter</p></div>"
        quote = "<p>a passage that every article quotes</p>" if i % 2 else ""
        rows.append((i, f"https://one.example/{i}", f"<body>{teaser}<section><p>own words {i}</p></section></body>"))
        rows.append((100 + i, f"https://two.example:80/{i}", f"<div>{teaser}</div><article><p>story {i}</p>{quote}"
                     "<ul><li><a href=x>top story</a></li></ul></article>"))
    rows += [(200, None, "<p>Subscribe now to our letter</p>"), (201, "odd", None), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*x, "h") for x in rows], "page_id long, url string, html string, host string")
    got = html_text.main_text(df).collect()
    assert len(got) == len(rows)
    texts = {x.page_id: x.text for x in got}
    assert all(texts[i] == f"own words {i}" for i in range(12))
    assert all(texts[100 + i] == f"story {i}" + " a passage that every article quotes" * (i % 2) for i in range(12))
    assert texts[200] == "Subscribe now to our letter" and texts[201] == ""
    assert all(x.n_chars == len(x.text) for x in got)
    assert html_text.main_text(df.limit(0)).collect() == []


def test_templates_by_count_on_a_large_host_and_in_the_article(spark):
    rows = []
    for i in range(60):
        note = "<p>We moved to a new office</p>" if i % 10 == 0 else ""  # on a tenth of the pages
        rows.append((i, "https://big.example/", f"<body>{note}<h2>{'Early life' if i % 10 == 1 else i}</h2><p>own words number {i}</p></body>"))
        block = "<div><p>Sign up for our letter</p></div>" if i % 10 == 2 else ""
        quote = "<p>a passage some articles quote</p>" if i % 10 == 3 else ""
        rows.append((100 + i, "https://two.example/", f"<article><p>a long story with the number {i}</p>{block}{quote}"
                     "<p>All rights reserved</p></article>"))
    rows += [(200 + i, "https://three.example/", "<body><div><p>the same page again</p></div><p>end</p></body>") for i in range(9)]
    got = {x.page_id: x.text for x in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(60):
        assert got[i] == f"{'Early life' if i % 10 == 1 else i} own words number {i}"
        assert got[100 + i] == f"a long story with the number {i}" + " a passage some articles quote" * (i % 10 == 3)
    assert {got[200 + i] for i in range(9)} == {"the same page again end"}


NAMES = [
    *[(f"<div {n}><article><p>story</article></div>", "story") for n in (
        "class='layout with-sidebar'", "class=no-sidebar", "class=has-banner", "class='page cookie-consent-ok'",
        "id=content-widget", "class=sidebar", "class='widget site-footer'")],
    ("<div class=sidebar><main><p>story</main></div>", "story"),
    ("<article><section class=related-work>a</section><div class=share-price>b</div><p class=notice-period>c</p>"
     "<div class=social-history>d</div><div class='share-buttons'>no</div><ul id=related_posts-2><li>no</ul></article>", "a b c d"),
    ("<div class=widget>nearly all of the page's text is here</div><p>x</p><div class=ads>no</div>", "nearly all of the page's text is here x"),
    ("<article>s</article><div class=comments><article>a comment longer than the story</article></div>", "s"),
]


@pytest.mark.parametrize("html, text", NAMES)
def test_names(html, text):
    assert html_text.Page(html).text(set()) == text
