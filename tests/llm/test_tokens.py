"""Token ids against the library that the vocabulary file is for, and what is built on them."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticeflow.llm import bpe, shards, token_counts
from noticeflow.llm.queries import REGISTRY, VOCABULARY
from noticeflow.session import staging_root

LIBRARY = Tokenizer.from_file(VOCABULARY)
ODD = ["", " ", "a  b", "a \n b", " x<|endoftext|>  y<|endoftext|><|endoftext|>", "<|endoftext", "don't we'll I'M 's",
       "\t\tx \n\n y", "a" * 3000, "é" * 200, "ab" * 400, "日本語 ４５ ²Ⅷ½", "a\x1cb", "\x00\x01", "👩‍👩‍👧 ok", "　 x", "\r\n \r\n",
       "trailing  ", "word.\nNext, \"quoted\" (x)", "ﬁ ǆ İ ß", "é ä"]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary(VOCABULARY), cache_entries=500)


def test_odd_texts(encoder):
    for text, ids in zip(ODD, encoder.encode(ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
        assert encoder.decode(ids) == LIBRARY.decode(library_ids(text), skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t.,'!sdtréß日٣²<|>", max_size=60))
def test_any_text(text):
    own = test_any_text.encoder = getattr(test_any_text, "encoder", None) or bpe.Encoder(bpe.load_vocabulary(VOCABULARY))
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library_ids(text)


def test_array_and_heap_agree(encoder):
    r = random.Random(2)
    for _ in range(40):
        word = "".join(r.choices("theraino", k=r.randint(2, 60))).encode()
        assert encoder.merge_rows([word])[0] == encoder.merge_long(word)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")


def test_words_of_letters_are_kept_once(encoder):
    """As a piece; the same word with marks after it, or later in a text, reads it from there."""
    own = bpe.Encoder(encoder.v)
    texts = ["Zürich zebra,", "zebra zebra, 12 über", "über, x-y Zürich. zebra"]
    assert own.encode(texts) == bpe.Encoder(encoder.v).encode(texts[::-1])[::-1]
    assert own.encode(texts) == [np.array(library_ids(t), "<u4").tobytes() for t in texts]
    assert {"zebra", "über", "Zürich"} <= own.known.keys()
    assert not {" zebra", " über", " Zürich"} & own.words.keys()


def test_unknown_words_are_learned_together(encoder):
    """One search cuts all unknown pieces, and words of up to four lengths are merged at once."""
    own, r = bpe.Encoder(encoder.v), random.Random(3)
    calls = {"findall": 0, "merge_rows": 0}

    class Counted:
        def findall(self, text, found=own.pattern):
            calls["findall"] += 1
            return found.findall(text)

    def merge_rows(words, merge=own.merge_rows):
        calls["merge_rows"] += 1
        return merge(words)

    own.pattern, own.merge_rows = Counted(), merge_rows
    some = lambda: "".join(r.choices("theraioné", k=r.randint(1, 30)))
    texts = [" " + " ".join(f"{some()}{mark}" for mark in r.choices(["", ",", "!?", ".\n" + some(), "$$$", "-7\x00"], k=40)) for _ in range(50)]
    assert own.encode(texts) == [np.array(library_ids(t), "<u4").tobytes() for t in texts]
    assert calls["findall"] <= 1 and calls["merge_rows"] <= bpe.LONG_WORD // bpe.SIZE_STEP


def test_words_of_many_lengths(encoder):
    r = random.Random(4)
    words = ["".join(r.choices("theraino\x00é", k=r.randint(2, 90))).encode() for _ in range(300)]
    assert encoder.merge(words) == [encoder.merge_long(w) for w in words]
    assert encoder.merge([]) == []


def test_pairs_that_share_a_slot(encoder):
    """The hash table gives every pair its rank, and others none."""
    keys, ranks = encoder.v.pair_keys, encoder.v.pair_ranks
    assert encoder.crowded.any()
    assert (encoder.ranks_of(keys >> 20, keys & (1 << 20) - 1) == ranks).all()
    none = np.setdiff1d(keys ^ 1, keys)
    assert len(none) and (encoder.ranks_of(none >> 20, none & (1 << 20) - 1) == bpe.NO_RANK).all()


def test_failed_texts_leave_nothing_half_known(encoder):
    own = bpe.Encoder(encoder.v)
    with pytest.raises(UnicodeEncodeError):
        own.encode(["a zebra, \ud800"])
    assert own.encode(["a zebra, x"]) == [np.array(library_ids("a zebra, x"), "<u4").tobytes()]


def test_round_trip_and_columns(spark):
    rows = [*enumerate(ODD), (3, ODD[3]), (None, "no id"), (50, None)]
    got = bpe.round_trip(docs(spark, rows), VOCABULARY).collect()
    assert sorted((repr(r.doc_id), r.decoded) for r in got) == sorted((repr(i), t or "") for i, t in rows)
    assert all(r.n_tokens == len(r.ids) // 4 == len(library_ids(r.decoded)) for r in got)
    back = bpe.decode(bpe.encode(docs(spark, rows), VOCABULARY), VOCABULARY, into="again")
    assert all(r.again == (r.text or "") and r.token_ids == library_ids(r.again) for r in back.collect())
    assert bpe.round_trip(docs(spark, []), VOCABULARY).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,)], "token_ids array<int>"), VOCABULARY).first().text is None


def counts_loop(text, spans, rule):
    out, outside = [0.0] * len(spans), 0.0
    for a, b in LIBRARY.encode(text, add_special_tokens=False).offsets:
        over = [max(0, min(b, e) - max(a, s)) for s, e in spans]
        touched = [k for k, n in enumerate(over) if n]
        if not touched:
            outside += 1
        elif rule == "share":
            for k in touched:
                out[k] += over[k] / (b - a)
        else:
            k = {"most": max(touched, key=lambda k: (over[k], -k)), "first": touched[0], "last": touched[-1]}[rule]
            out[k] += 1
    return out, outside


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections(spark, rule):
    r = random.Random(5)
    rows = []
    for i in range(60):
        text = "".join(r.choices("ther é日.\n ain", k=r.randint(0, 120)))
        edges = sorted(r.randint(0, len(text) + 3) for _ in range(2 * r.randint(0, 4)))
        rows.append((i, text, list(zip(edges[::2], edges[1::2]))))
    df = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:int,end:int>>")
    got = token_counts.count_tokens(df, VOCABULARY, sections_col="parts", rule=rule).collect()
    for i, text, spans in rows:
        own = sorted((x.section, x.n_tokens) for x in got if x.doc_id == i)
        counts, outside = counts_loop(text, spans, rule)
        want = ([(-1, outside)] if outside else []) + list(enumerate(counts))
        assert [s for s, _ in own] == [s for s, _ in want]
        assert [n for _, n in own] == pytest.approx([n for _, n in want])


def test_lines(spark):
    rows = [(1, None), (2, ""), (3, "a\n\nb c\n"), (4, "x\ny"), (4, "x\ny"), (None, "\n")]
    got = token_counts.count_tokens(docs(spark, rows), VOCABULARY).collect()
    spans = lambda i: sorted((x.section, x.start, x.end) for x in got if x.doc_id == i)
    assert spans(1) == spans(2) == [(0, 0, 0)]
    assert spans(3) == [(0, 0, 2), (1, 2, 3), (2, 3, 7)]
    assert spans(4) == [(0, 0, 2), (0, 0, 2), (1, 2, 3), (1, 2, 3)]
    assert spans(None) == [(0, 0, 1)]
    assert sum(x.n_tokens for x in got) == sum(len(library_ids(t or "")) for _, t in rows)
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs(spark, rows), VOCABULARY, rule="none")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1000, 4097])
def test_permutation(n):
    order = shards.Feistel(n, 11)
    slots = order.walk(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.walk(slots, back=True).tolist() == list(range(n))
    if n > 100:
        assert shards.Feistel(n, 12).walk(np.arange(n)).tolist() != slots.tolist()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.15


def packed(rows, sequence):
    """Texts end to end, as one task packs them: (n_tokens, docs, ids) of each sequence."""
    stream = [(i, n, x) for i, t in rows for n, x in enumerate(library_ids(t or "") + [50256])]
    out = []
    for at in range(0, len(stream), sequence):
        part = stream[at:at + sequence]
        docs = []
        for k, (i, n, _) in enumerate(part):
            if not k or n == 0:
                docs.append([i, n, 0])
            docs[-1][2] += 1
        out.append((len(part), [tuple(d) for d in docs], [x for *_, x in part] + [50256] * (sequence - len(part))))
    return out


ROWS = [*enumerate([*ODD, None, "long text of words " * 500, "a b c"]), (None, "z"), (2, ODD[2]), (None, None)]


def flat(r):
    return r.n_tokens, [tuple(d) for d in r.docs], np.frombuffer(bytes(r.record), "<u2").tolist()


@pytest.mark.parametrize("tasks", [1, 3])
def test_training_order(spark, tmp_path, tasks):
    df = shards.training_order(docs(spark, ROWS).coalesce(1) if tasks == 1 else docs(spark, ROWS).repartition(tasks), VOCABULARY,
                               key=5, sequence=16, shard_records=32)
    got = df.collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all((r.shard, r.byte_offset) == (r.slot // 32, r.slot % 32 * 32) and len(r.record) == 32 for r in got)
    if tasks == 1:
        assert sorted(map(repr, map(flat, got))) == sorted(map(repr, packed(ROWS, 16)))
    # Each text in whole, from the sequences that name it.
    assert sum(r.n_tokens < 16 for r in got) <= tasks
    for i, text in ROWS:
        if i in (2, None):
            continue
        own = []
        for r in got:
            at = 0
            for d in r.docs:
                own += [(d.from_token, flat(r)[2][at:at + d.n_tokens])] * (d.doc_id == i)
                at += d.n_tokens
        assert [x for _, ids in sorted(own) for x in ids] == library_ids(text or "") + [50256]
    shards.write_shards(df, str(tmp_path / "out"))
    by_slot = {r.slot: bytes(r.record) for r in got}
    for shard in sorted({r.shard for r in got}):
        for start in (0, 3):
            found = shards.read_shard(spark, str(tmp_path / "out"), shard, 32, start)
            assert [x.tobytes() for x in found] == [by_slot[s] for s in range(shard * 32 + start, min(shard * 32 + 32, len(got)))]
    assert shards.training_order(docs(spark, []), VOCABULARY).collect() == []


def test_packing_does_not_depend_on_pieces(spark, monkeypatch):
    rows = [(i, "some words here " * (i % 7)) for i in range(60)]
    whole = [flat(r) for r in shards.training_order(docs(spark, rows).coalesce(1), VOCABULARY, sequence=8).sort("slot").collect()]
    monkeypatch.setattr(shards.pieces, "__defaults__", (1,))
    parts = [flat(r) for r in shards.training_order(docs(spark, rows).coalesce(1), VOCABULARY, sequence=8).sort("slot").collect()]
    assert whole == parts and sorted(map(repr, whole)) == sorted(map(repr, packed(rows, 8)))


def test_written_order(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "long text of words " * 500])] + [(None, "z")]
    out = str(tmp_path / "out")
    got = shards.write_order(docs(spark, rows), VOCABULARY, out, key=5, sequence=16, shard_records=32).collect()
    want = shards.training_order(docs(spark, rows), VOCABULARY, key=5, sequence=16, shard_records=32).collect()
    cut = lambda r: (r.shard, r.slot, r.byte_offset, r.n_tokens, repr(r.docs))
    assert {(*cut(r), r.record_sha256) for r in got} == {(*cut(r), hashlib.sha256(r.record).hexdigest()) for r in want}
    assert len(got) == len(want) and len({r.shard for r in got}) > 3
    for r in got:  # a reader that goes to the offset finds the record
        [file] = (tmp_path / "out" / f"shard={r.shard}").glob("part-*")
        with file.open("rb") as f:
            f.seek(r.byte_offset)
            assert hashlib.sha256(f.read(32)).hexdigest() == r.record_sha256
        [one] = shards.read_shard(spark, out, r.shard, 32, r.slot % 32, 1)
        assert hashlib.sha256(one.tobytes()).hexdigest() == r.record_sha256
    assert shards.read_shard(spark, out, got[0].shard, 32, 32) == []
    assert shards.write_order(docs(spark, []), VOCABULARY, str(tmp_path / "none")).collect() == []


def test_query_writes_shards(spark):
    before = set(Path(staging_root(spark)).glob("noticeflow-shards-*"))
    got = REGISTRY["op9_training_order"](spark, "/root/testdata/sf0.001").collect()
    [out] = set(Path(staging_root(spark)).glob("noticeflow-shards-*")) - before
    size = {int(f.parent.name[6:]): f.stat().st_size for f in out.glob("shard=*/part-*")}
    assert sum(n // 1024 for n in size.values()) == len(got)
    assert all(r.record_sha256 and r.docs and r.byte_offset + 1024 <= size[r.shard] for r in got)
