"""Periodic runs against every lag of every text, tried word by word."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from noticeflow.llm import periodic_runs as pr
from noticeflow.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def has_period(words, q):
    return all(words[i] == words[i + q] for i in range(len(words) - q))


def brute(words, exponent=4, shortest=6):
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q) and not any(has_period(words[i:j + q], p) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def repetitive(r, n):
    """Words with periods inside periods."""
    out = []
    while len(out) < n:
        unit = [r.choice("abc") for _ in range(r.choice([1, 1, 2, 3, 4, 5, 7, 9, 17]))]
        unit = unit * r.choice([1, 1, 2, 4, 6]) + [r.choice("abcd")] * r.choice([0, 0, 1, 8])
        out += unit * r.choice([1, 2, 3, 4, 5, 9])
    return out[:n]


@pytest.mark.parametrize(("exponent", "shortest"), [(4, 6), (3, 1), (3, 10), (5, 30)])
def test_random_texts_together(exponent, shortest):
    r = random.Random(exponent * 100 + shortest)
    texts = [repetitive(r, r.choice([0, 1, 5, 6, 7, 40, 150, 300])) for _ in range(60)]
    texts += [[str(i) for i in range(50)], ["x"] * 200, texts[3], ["a", "b"] * 4, ["a"] * 5, ["a"] * 6]
    got = pr.find_runs([[w.encode() for w in t] for t in texts], exponent, shortest)
    assert got == [brute(t, exponent, shortest) for t in texts]
    assert [pr.collapse(t, runs) for t, runs in zip(texts, got, strict=True)] == [kept(t, x) for t, x in zip(texts, got, strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=3))
def test_any_texts(texts):
    assert pr.find_runs([[c.encode() for c in t] for t in texts]) == [brute(list(t)) for t in texts]


def test_bands_cover_all_lags():
    for exponent, shortest in ((4, 6), (3, 1), (6, 100)):
        lags = [(q, overlap) for low, high, overlap in pr.bands(4000, exponent, shortest) for q in range(low, high + 1)]
        assert [q for q, _ in lags][:600] == list(range(1, 601))
        assert all(q <= overlap <= max(shortest, exponent * q) - q for q, overlap in lags)


def test_too_few_repetitions():
    with pytest.raises(ValueError):
        pr.find_runs([[b"a"]], exponent=2)


def test_a_very_long_text():
    """One hundred thousand words of period one, and as many of a long period: pairs stay linear."""
    unit = [str(i % 3000).encode() for i in range(20_000)]
    (ones, long) = pr.find_runs([[b"a"] * 100_000, [b"x", *unit * 5, b"y"]])
    assert ones == [(0, 100_000, 1)]
    assert long == sorted([(1 + 20_000 * k, 20_000, 3000) for k in range(5)] + [(1, 100_000, 20_000)], key=lambda r: (r[0], r[2]))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, "c") for i, t in rows],
                                 "doc_id long, text string, runs string, n_words int, collapsed string")


ODD = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "a " * 30), (3, "a " * 30), (None, "b " * 7), (4, "É é " * 9 + "\x1c \x85 z"),
       (5, "    x"), (6, " ".join("pqr" * 40)), (7, "x" * 100_000 + " y"), (8, "A a " * 3)]


def test_odd_rows(spark):
    got = pr.periodic_runs(documents(spark, ODD)).collect()
    want = [(i, WORD.findall(t or "")) for i, t in ODD]
    assert sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got) == sorted(
        repr((i, len(w), brute(w), " ".join(kept(w, brute(w))))) for i, w in want)
    assert pr.periodic_runs(documents(spark, [])).collect() == []


def contract(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), s, length, q, runs and 1000 * length // q or None,
            *(hashlib.sha256(x.encode()).hexdigest() for x in (text, " ".join(kept(words, runs)))))


def check(rows, docs):
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows]
    assert sorted(map(repr, got)) == sorted(repr(contract(*d)) for d in docs)


def test_query_on_made_up_rows(spark, tmp_path):
    r = random.Random(6)
    docs = ODD + [(i, " ".join(repetitive(r, r.choice([0, 3, 30, 90])))) for i in range(100, 400)]
    documents(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    check(REGISTRY["op12_periodic_runs"](spark, str(tmp_path)).collect(), docs)


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").select("doc_id", "text")
    short = [tuple(d) for d in docs.collect() if len(d.text or "") < 12_000]
    ids = {d[0] for d in short}
    rows = [r for r in REGISTRY["op12_periodic_runs"](spark, entry.SMOKE_DIR).collect() if r.doc_id in ids]
    assert len(short) > 100
    check(rows, short)
