"""The language model: its base score counted plainly, its probabilities summed up, its gradient tried."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from noticeflow.llm import maxent as mx
from noticeflow.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}
COLUMNS = "doc_id long, text string, _row long, n_tokens string, key binary, base double, score string"


def tokens(text):
    return WORD.findall((text or "").translate(UPPER)) + [""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute(rows):
    """n_tokens, n_known, train_tokens, base_score of each row."""
    c = collections.Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)) if n else 0.0) for i, t in rows]


def near(got, want):
    def key(r):
        return (repr(r[:5]), round(r[5], 4))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", b"k", 0.5, "s") for i, t in rows], COLUMNS)


def query(spark, tmp_path, rows, name="documents"):
    table(spark, rows).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return REGISTRY["op11_lm_score"](spark, str(tmp_path)).collect()


def corpus(seed, n):
    """Two languages; the second word after an "x" is always a "y"."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"{'ab'[i % 2]}{r.randint(0, 30) * r.randint(0, 8)}" for _ in range(r.randint(5, 60))]
        for at in range(0, len(words) - 3, 7):
            words[at], words[at + 2] = "X", "y"
        out.append((i, " ".join(words)))
    return out


ODD = [(1000, None), (1001, ""), (1002, " \n\t "), (None, "no id"), (1003, "w" * 500 + " " + "w" * 500), (1003, "É é \x85 \x1c"),
       (1004, "same same"), (1004, "same same"), (1005, "#" + "0" * 64), (1006, "a1 " * 5000)]


def test_query_on_odd_rows(spark, tmp_path):
    rows = corpus(1, 200) + ODD
    got = query(spark, tmp_path, rows)
    near([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], brute(rows))
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    same = {r.score for r in got if r.doc_id == 1004}
    assert len(same) == 1


def test_nothing_to_learn_from(spark, tmp_path):
    unseen = next(i for i in range(100) if held(i))
    assert query(spark, tmp_path / "none", []) == []
    (row,) = query(spark, tmp_path / "one", [(unseen, "A b")])
    assert tuple(row) == (unseen, True, 3, 0, 0, 0.0, 0.0)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = REGISTRY["op11_lm_score"](spark, entry.SMOKE_DIR).collect()
    near([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], brute(rows))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)


def test_held_out_texts_gain_from_context(spark, tmp_path):
    got = [r for r in query(spark, tmp_path, corpus(5, 1500)) if r.held_out]
    n = sum(r.n_tokens for r in got)
    assert sum(r.score - r.base_score for r in got) / n > 0.2


@pytest.mark.parametrize("vocabulary", [0, 100, 150])
def test_words_beyond_the_broadcast_ones_score_alike(spark, monkeypatch, vocabulary):
    rows = table(spark, corpus(2, 150) + ODD).coalesce(1)
    monkeypatch.setattr(mx, "HEAD", 25)
    whole = {r.doc_id: r for r in mx.score(rows, mx.train(rows, exclude=mx.F.col("doc_id") % 9 == 0)).collect()}
    monkeypatch.setattr(mx, "VOCABULARY", vocabulary)
    trained = mx.train(rows, exclude=mx.F.col("doc_id") % 9 == 0)
    assert (mx.NEAR if vocabulary else 1) <= len(trained.model.lexicon.words) <= vocabulary + 1
    got = {r.doc_id: r for r in mx.score(rows, trained).collect()}
    for i, r in got.items():
        assert tuple(r)[:4] == tuple(whole[i])[:4]
        assert math.isclose(r.base_score, whole[i].base_score, rel_tol=1e-9)
        if vocabulary:  # the head and the neighbours, and with them the model, are then the same
            assert math.isclose(r.score, whole[i].score, rel_tol=1e-3, abs_tol=1e-3)


def trained(spark, monkeypatch, head=40):
    monkeypatch.setattr(mx, "HEAD", head)
    monkeypatch.setattr(mx, "CLUSTERS", 4)
    return mx.train(table(spark, corpus(3, 300))).model


def test_probabilities_add_up(spark, monkeypatch):
    model = trained(spark, monkeypatch)
    lexicon = model.lexicon
    suffix = {}  # an unknown word for each tail class
    for i in range(100_000):
        suffix.setdefault(int(lexicon.tail_class[mx.suffix_of(b"?%d" % i)]), "?%d" % i)
    for context in ("", "a0 b3 ", "never seen ", "x a1 "):
        total = 0.0
        for words in (lexicon.words[1:], [suffix[k] for k in sorted(set(lexicon.tail_class.tolist()))]):
            texts = [context + (w.decode() if isinstance(w, bytes) else w) for w in words]
            at = len(context.split())
            for group in lexicon.encode(texts):
                log = model.log_features(group)
                for i, w in enumerate(words):
                    p = math.exp(log[np.flatnonzero(group.text == i)[at]])
                    if isinstance(w, bytes):
                        total += p * 10 ** lexicon.log_share()[1 + i]
                    else:
                        total += p * 10 ** lexicon.log_unknown()[mx.suffix_of(w.encode())]
        for group in lexicon.encode([context]):
            total += math.exp(model.log_features(group)[-1])
        assert math.isclose(total, 1, rel_tol=1e-4)


def test_a_step_follows_the_gradient():
    r = np.random.default_rng(4)
    rows = [r.integers(0, 9, 50).astype(np.uint16), np.full(50, 9, np.uint16)]
    target, soft = r.integers(0, 5, 50), mx.Softmax(r.normal(size=(10, 5)).astype(np.float32))

    def loss(table):
        logits = sum(table[x] for x in rows).astype(float)
        return -(logits[np.arange(50), target] - np.log(np.exp(logits).sum(1))).sum()

    before = soft.table.astype(float)
    slope = np.zeros_like(before)
    for i, j in np.ndindex(before.shape):
        up, down = before.copy(), before.copy()
        up[i, j] += 1e-4
        down[i, j] -= 1e-4
        slope[i, j] = (loss(up) - loss(down)) / 2e-4
    error = mx.softmax(soft.logits(rows))
    error[np.arange(50), target] -= 1
    sums, touched = np.ones_like(soft.table), np.zeros(10)
    soft.learn(rows, error, sums, touched, 0.1)
    assert np.allclose(before - soft.table, 0.1 * slope / np.sqrt(1 + slope ** 2), atol=1e-3)
    assert touched.tolist() == np.bincount(np.concatenate(rows), minlength=10).tolist()


def test_rows_out_of_range():
    far = np.array([[900, 899, -900], [-900, -901, -902], [0, 1, 2]], np.float32)
    want = np.exp(far.astype(float) - far.max(1, keepdims=True).astype(float))
    assert np.allclose(mx.softmax(far.copy()), want / want.sum(1, keepdims=True), atol=1e-6)


def test_sums_by_row():
    r = np.random.default_rng(5)
    for n, kinds in ((1, 1), (300, 5), (300, 200), (64, 64)):
        rows, values = r.integers(0, kinds, n).astype(np.uint16), r.normal(size=(n, 6)).astype(np.float32)
        want = np.ones((kinds, 6))
        np.add.at(want, rows, values)
        into = np.ones((kinds, 6), np.float32)
        mx.add_rows(rows, values, into)
        assert np.allclose(want, into, atol=1e-4)


def test_words_and_their_numbers():
    r = random.Random(7)
    text = " " + "".join(r.choice("ab\x00 \n\x0b\x85é") for _ in range(5000)) + " " + "w" * 70 + " " + "w" * 71 + "\t"
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, lengths = mx.word_bounds(data)
    words = [raw[a:a + n] for a, n in zip(starts, lengths)]
    assert words == raw.split()
    hashes = mx.word_hashes(data, starts, lengths)
    by_word = dict(zip(words, hashes.tolist()))
    assert len(set(by_word.values())) == len(by_word) and [by_word[w] for w in words] == hashes.tolist()
    known = sorted(by_word)[::2]
    index = mx.HashIndex([mx.END, *known])
    assert index.numbers(hashes).tolist() == [known.index(w) + 1 if w in known else -1 for w in words]
    assert mx.HashIndex([mx.END]).numbers(hashes).max() == -1


def test_slices_keep_words_and_contexts(monkeypatch):
    r = random.Random(8)
    text = "".join(r.choice("ab \n\x85é") for _ in range(3000))
    raw = text.encode()
    assert b"".join(mx.slices(raw, 50)) == raw
    assert [w for part in mx.slices(raw, 50) for w in part.split()] == raw.split()
    words = sorted(set(raw.split()))
    whole = mx.Lexicon([mx.END, *words], np.ones(len(words) + 1), 10, 5, 3)
    (one,) = whole.encode([text])
    parts = [g for unit in [mx.units] for g in unit([text], 60)]
    assert sum(len(x.split()) for g in parts for _, x, _, _ in g) == len(raw.split())
    monkeypatch.setattr(mx.units, "__defaults__", (60,))
    many = list(whole.encode(["a b", text, "", "b"]))
    assert len(many) > 10
    for back in range(mx.BACK + 1):
        got = np.concatenate([g.before(back)[g.text == 1] for g in many])
        assert got.tolist() == one.before(back).tolist()
