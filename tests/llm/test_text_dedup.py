"""Exact copies, repeated byte strings and near copies against plain loops."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from noticeflow.llm import suffix_dedup as sd
from noticeflow.llm.components import components
from noticeflow.llm.exact_dedup import exact_dedup
from noticeflow.llm.ngram_join import ngram_join, prefix_length, shingles, words

SCHEMA = "doc_id long, text string, _norm string, label string, count long"


def table(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "x", "y", 7) for i, t in rows], SCHEMA)


def prose(r, n, letters="abcdefgh"):
    return " ".join("".join(r.choices(letters, k=r.randint(1, 7))) for _ in range(n))


def exact_loop(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = set()
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1] is not None, m[1] or 0))[1]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out |= {(i, keep, len(members), i == keep, digest) for _, i in members}
    return out


@pytest.mark.parametrize("rows", [
    [],
    [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, " ")],
    [(5, "a b"), (1, "ab"), (2, "a  b"), (3, "a b"), (None, "ba"), (9, "b a"), (9, "b a")],
    [(i, "x" * 5000 + str(i % 3)) for i in range(12)],
    [(i, "same start " * 30 + "é" * (i % 4) + " " * i) for i in range(20)],
])
def test_exact_copies(spark, rows):
    got = exact_dedup(table(spark, rows), digest_all=True).collect()
    assert {tuple(r) for r in got} == exact_loop(rows)
    assert len(got) == len(rows)
    part = exact_dedup(table(spark, rows)).collect()
    assert {r[:4] for r in part} == {r[:4] for r in exact_loop(rows)}
    full = {r[4] for r in exact_loop(rows)}
    assert all(r.text_sha256 in full or r.group_size == 1 for r in part)


def span_loop(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + 400] for r in raw for i in range(len(r) - 399))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - 399):
            if seen[r[i:i + 400]] > 1:
                gone[i:i + 400] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), [(a, b) for a, b in sd.stretches(gone)], hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts():
    r = random.Random(4)
    base = prose(r, 400)
    cut = [prose(r, 20) + base[a:a + n] + prose(r, 30) for a, n in ((0, 399), (10, 400), (10, 401), (300, 900), (500, 700))]
    return [None, "", "short", *cut, base, base, "ab" * 700, "ab" * 350 + "é" * 300, "x" * 399, "y" * 401,
            prose(r, 300), prose(r, 50) + "é".join(cut), "quux " * 200]


@pytest.mark.parametrize("hot", [sd.HOT, 1])
def test_repeated_strings(spark, hot):
    texts = repeated_texts()
    ids = [None, *range(1, len(texts) - 1), 1]
    got = sd.suffix_dedup(table(spark, list(zip(ids, texts))), hot=hot).collect()
    key = repr
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in got), key=key)
    assert found == sorted(((i, *w) for i, w in zip(ids, span_loop(texts))), key=key)


def thue_morse(n):
    """Letters whose sum over powers of any odd number is, from 2^10 on, that of the other letters modulo 2^64."""
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_crafted_contents(spark):
    """Contents that a polynomial hash modulo 2^64 takes for equal are not."""
    word = thue_morse(1024)
    other = word.translate(str.maketrans("ab", "ba"))
    assert sd.content_hash(memoryview(word.encode())) != sd.content_hash(memoryview(other.encode()))
    one, two = (shingles([[w]])[0][0] for w in (word, other))
    assert one != two
    r = random.Random(12)
    start, end = prose(r, 60), prose(r, 60)
    texts = [start + word + end, start + other + end, word[:500], other[:500]]
    for hot in (sd.HOT, 1):
        got = sd.suffix_dedup(table(spark, list(enumerate(texts))), hot=hot).orderBy("doc_id").collect()
        assert [(r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in got] == span_loop(texts)
    near = sorted(tuple(x) for x in ngram_join(table(spark, [(1, word), (2, other)])).collect())
    assert near == [(1, 1, 1, 0, True), (2, 2, 1, 0, True)]


def test_a_very_long_text(spark, monkeypatch):
    """A text of 3 MB with a passage that another has too; no other string of it repeats."""
    r = random.Random(5)
    passage = "".join(r.choices("abcdefghij", k=1000))
    long = "".join(r.choices("klmnopqrst", k=3_000_000))
    rows = [(1, long[:2_000_000] + passage + long[2_000_000:]), (2, "u" + passage + "v")]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in sd.suffix_dedup(table(spark, rows)).collect()}
    assert got == {1: [(2_000_000, 2_001_000)], 2: [(1, 1001)]}
    monkeypatch.setattr(sd, "LONGEST", 1000)
    with pytest.raises(ValueError, match="at most 1000"):
        sd.find_segments(pa.RecordBatch.from_pydict({"doc_id": [2], "key": [b"k"], "text": [rows[1][1]]}))


def test_repeated_strings_of_nothing(spark):
    assert sd.suffix_dedup(table(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bucket_order(seed):
    r = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdef "
    base = "".join(r.choices(letters, k=1000))
    raw = [("".join(r.choices(letters, k=r.randint(0, 90))) + base[a:a + r.randint(380, 600)]).encode()
           for a in (r.randint(0, 500) for _ in range(80))]
    raw.append(b"xyz" * 300)
    raw = [x for x in raw if len(x) >= 400]
    data = b"".join(raw)
    edges = np.cumsum([0, *map(len, raw)])
    starts = np.concatenate([np.arange(a, b - 399) for a, b in zip(edges, edges[1:])])
    seen = Counter(data[i:i + 400] for i in starts.tolist())
    got = sd.repeated_starts(np.frombuffer(data, np.uint8), starts)
    assert got.tolist() == [seen[data[i:i + 400]] > 1 for i in starts.tolist()]


def join_loop(rows):
    classes = defaultdict(list)
    for i, t in rows:
        classes[tuple(words(t or ""))].append(i)
    keys = list(classes)
    sets = [{k[i:i + 5] for i in range(max(1, len(k) - 4))} if k else set() for k in keys]
    root, links = list(range(len(keys))), Counter()
    for a, b in itertools.combinations(range(len(keys)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links.update((a, b))
            x, y = root[a], root[b]
            root = [x if z == y else z for z in root]
    first = {z: min(i for n, k in enumerate(keys) if root[n] == z for i in classes[k]) for z in set(root)}
    return sorted((i, first[root[n]], len(classes[k]), links[n], i == first[root[n]]) for n, k in enumerate(keys) for i in classes[k])


def test_near_copies(spark):
    r = random.Random(8)
    rows = [(0, None), (1, ""), (2, "?!"), (3, "one"), (4, "One."), (5, "a b c d"), (6, "a b c d e"), (7, "a b c d e")]
    for _ in range(12):
        base = prose(r, r.choice([30, 80, 400])).split()
        for _ in range(r.randint(2, 12)):
            own = list(base)
            for _ in range(r.randint(0, 3)):
                own[r.randrange(len(own))] = "new" + str(r.random())
            rows.append((len(rows), " ".join(own)))
    rows += [(500 + i, prose(r, 60)) for i in range(20)]
    got = sorted(tuple(x) for x in ngram_join(table(spark, rows)).collect())
    assert got == join_loop(rows)


def test_near_copies_of_a_large_group_and_repeated_rows(spark):
    r = random.Random(9)
    base = prose(r, 60).split()
    rows = []
    for i in range(600):  # more than two tiles
        own = list(base)
        own[i % 60] = f"w{i}"
        rows.append((i, " ".join(own)))
    rows += [(3, rows[3][1]), (None, "lonely text of some length")]
    got = ngram_join(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {row[0]: row for row in join_loop(rows[:600])}
    for row in got:
        if row.doc_id is None:
            assert (row.class_id, row.n_links, row.kept) == (None, 0, True)
        else:
            assert (row.class_id, row.n_links) == want[row.doc_id][1:4:2]
            assert row.n_copies == (2 if row.doc_id == 3 else 1)
    assert ngram_join(table(spark, [])).collect() == []


def test_prefix_is_shortened_until_the_recall_is_reached():
    assert prefix_length(0.8, 16, 8, 0.999) == 4
    assert 1 - (1 - 0.8 ** 4) ** 16 >= 0.999 > 1 - (1 - 0.8 ** 5) ** 16
    assert prefix_length(0.99, 16, 8, 0.9) == 8
    assert prefix_length(0.1, 2, 8, 0.999) == 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 199), (199, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {199: 199, 200: 199}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
