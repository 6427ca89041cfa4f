"""The pipeline as a whole, on the smallest tables, against plain loops for each decision."""

import hashlib
import random
import re

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
from noticeflow.llm import decontaminate as dc
from noticeflow.llm import quality
from noticeflow.llm.queries import QUALITY_CUT, REGISTRY, VOCABULARY, quality_model
from tests.llm.test_text_dedup import exact_loop, join_loop

DIR = "/root/testdata/sf0.001"


def test_registered():
    numbers = {int(name[2:].split("_")[0]) for name in REGISTRY}
    assert numbers == set(range(1, 14)) and len(REGISTRY) == 13
    assert {*REGISTRY, "pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "ngram_join", "decontaminate", "bpe"]


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    good = {r.doc_id for r in quality.score(docs, quality_model(spark, DIR)).collect() if r.score >= QUALITY_CUT}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    texts = {i: texts[i] for i, *_, kept, _ in exact_loop(texts.items()) if kept}
    texts = {i: texts[i] for i, *_, kept in join_loop(list(texts.items())) if kept}
    items = [dc.normalized(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    matcher = dc.Matcher([dc.Item(n, t, int(0.06 * len(t))) for n, t in enumerate(items) if t])
    texts = {i: t for i, t in texts.items() if not matcher.matches(dc.normalized(t))}
    library = Tokenizer.from_file(VOCABULARY)
    want = set()
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, DIR).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    for _, work in corpus_pipeline.STAGES[:-1]:
        docs = work(spark, docs, DIR)
        assert docs.columns == columns
    assert re.fullmatch("[0-9a-f]{64}", got[0].ids_sha256)


def test_null_and_repeated_ids_have_fates_of_their_own(spark):
    own = {n: " ".join(f"{w}{k}" for k in range(60)) for n, w in enumerate(["red", "blue", "green", "grey", "pink"])}
    near = own[1] + " end"
    leak = spark.read.parquet(f"{DIR}/benchmark.parquet").filter("length(text) > 60").first().text
    rows = [(1, own[0]), (None, own[0]), (None, own[2]), (None, own[3]), (7, own[0]), (7, own[4]), (7, own[4]),
            (None, own[3]), (2, own[1]), (None, near), (None, leak), (9, leak), (9, "clean text of a repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda found: sorted(((r.doc_id, r.text) for r in found), key=str)
    exact = corpus_pipeline.drop_exact_copies(spark, df, DIR)
    best = [(None, own[0]), (None, own[2]), (None, own[3]), (7, own[4]), (2, own[1]), (None, near), (None, leak),
            (9, "clean text of a repeated id")]
    assert key(exact.collect()) == sorted(best, key=str)
    after = corpus_pipeline.drop_near_copies(spark, exact, DIR)
    assert key(after.collect()) == sorted((r for r in best if r[1] != near), key=str)
    twice = spark.createDataFrame([(3, own[0]), (3, own[0]), (None, own[2]), (None, own[2])], df.schema)
    assert key(corpus_pipeline.drop_near_copies(spark, twice, DIR).collect()) == [(3, own[0]), (None, own[2])]
    clean = corpus_pipeline.drop_leaks(spark, after, DIR)
    assert clean.columns == df.columns
    assert key(clean.collect()) == sorted((r for r in best if r[1] not in (near, leak)), key=str)


def test_empty_table_long_text_and_clashing_columns(spark):
    """Every stage on columns with the names that stages use inside, on nothing, and on a text of 3 MB."""
    r = random.Random(3)
    long = " ".join(f"{r.choice(['stone', 'river', 'cloud'])}{r.randint(0, 10**6)}" for _ in range(250_000))
    near = long.replace(long.split()[1000], "other", 1)
    names = ["_row", "_meta", "_block", "_place", "_gone", "_quality", "_gone_bits", "_gone_held", "_dropped", "_GONE_block"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(1, long, *names), (2, near, *names), (3, None, *names), (4, long + " ", *names), (5, "short words here", *names)]
    df = spark.createDataFrame(rows, schema)
    scored = corpus_pipeline.drop_poor_text(spark, df, DIR)
    assert scored.columns == df.columns and {r.doc_id for r in scored.collect()} <= {1, 2, 3, 4, 5}
    exact = corpus_pipeline.drop_exact_copies(spark, df, DIR)
    assert sorted(r.doc_id for r in exact.collect()) == [2, 3, 4, 5]
    after = corpus_pipeline.drop_leaks(spark, corpus_pipeline.drop_near_copies(spark, exact, DIR), DIR)
    got = {r.doc_id: r for r in after.collect()}
    assert sorted(got) == [2, 3, 5] and after.columns == df.columns
    assert tuple(got[2]) == rows[1]
    assert {r.doc_id for r in corpus_pipeline.tokenize(spark, after, DIR).collect()} == {2, 3, 5}
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, spark.createDataFrame([], schema), DIR).collect() == []
