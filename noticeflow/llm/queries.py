"""Registered queries of the operators: each runs over its whole table.

Oracle SQL is given where SQL can express a query; the others are tested in ``tests/llm``.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import bpe, language, maxent, quality
from noticeflow.llm.common import held_out, ship, table
from noticeflow.llm.decontaminate import find_leaks
from noticeflow.llm.exact_dedup import exact_dedup
from noticeflow.llm.html_text import main_text
from noticeflow.llm.ngram_join import ngram_join
from noticeflow.llm.periodic_runs import periodic_runs
from noticeflow.llm.prefix_trie import conversations, key_of, prefix_trie
from noticeflow.llm.shards import write_order
from noticeflow.llm.suffix_dedup import suffix_dedup
from noticeflow.llm.token_counts import count_tokens
from noticeflow.session import staging_root

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(run)
    def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    REGISTRY[run.__name__] = sent
    return sent


#: A document is kept as good text from this score on.
QUALITY_CUT = 0.3


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 4, 2)
    models = language.train(docs, exclude=out)
    found = language.identify(docs, models)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "accepted", "bits_per_char")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def quality_model(spark: SparkSession, sf_dir: str):
    """Learned from the labelled rows that are not held out."""
    return quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                         exclude=held_out(F.col("doc_id"), 5, 0))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality_model(spark, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = f"{staging_root(spark).rstrip('/')}/noticeflow-shards-{uuid.uuid4().hex}"
    return write_order(table(spark, sf_dir, "documents"), VOCABULARY, shards, key=2024)


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


ORACLES["op10_exact_dedup"] = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
hashed AS (SELECT doc_id, length(body) AS points,
                  sha256(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM texts)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, text_sha256
FROM hashed WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


@query
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 10, 0)
    scored = maxent.score(docs, maxent.train(docs, exclude=out))
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; of each tenth document, by h = crc32 of its id, the words from a on repeat with period p."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.when(hashed % 10 == 0, words).alias("_words"),
                       F.floor(hashed / 10).alias("_g"))
    n = F.size("_words")
    rows = rows.withColumn("_a", (F.col("_g") % F.greatest(n, F.lit(1))).cast("int"))
    # a + (i - a) % p for all i from a on: the p words from a on, at most 3 + g % 8 times.
    times = (3 + F.col("_g") % 8).cast("int")
    period = F.slice("_words", F.col("_a") + 1, 1 + F.floor((n - F.col("_a")) / times).cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, times)), 1, n - F.col("_a"))
    repeated = F.array_join(F.concat(F.slice("_words", 1, F.col("_a")), tail), " ")
    return rows.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.start")).alias("start"), "_best.length",
        (-F.col("_best.period")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def shared_starts(turns: DataFrame) -> DataFrame:
    """conv_id and key of the conversations as the query rebuilds them: each begins with the first h turns
    of the conversation with the next lower id divisible by 5, and goes on with its own turns after h."""
    own = conversations(turns)
    heads = own.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("_base"), F.slice("ids", 1, 8).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    own = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % 5, "_h": h}).join(heads, "_base", "left")
    head = F.coalesce(F.slice("_head", 1, F.col("_h")), F.array().cast("array<string>"))
    return own.select("conv_id", key_of(F.concat(head, F.slice("ids", F.col("_h") + 1, F.size("ids")))).alias("key"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(shared_starts(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_bytes").alias("saved_tokens"), "ends_sha256")


#: Unsigned CRC-32 of a decimal number, bit by bit.
CRC32 = """xor(list_reduce(list_transform(range(1, strlen({0}::varchar) + 1), lambda i: ascii(substr({0}::varchar, i::int, 1))::bigint),
  lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda s, k: xor(s >> 1, 3988292384 * (s & 1))), 4294967295::bigint), 4294967295)"""

ORACLES["op13_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32.format('conv_id')} % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT i.conv_id, o.place, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.place <= i.h
  UNION ALL
  SELECT i.conv_id, o.place, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.place > i.h),
built AS (
  SELECT i.conv_id, list(t.text ORDER BY t.place) FILTER (t.place IS NOT NULL) AS texts,
         list([t.role, t.text] ORDER BY t.place) FILTER (t.place IS NOT NULL) AS path
  FROM ids i LEFT JOIN turns t ON t.conv_id = i.conv_id GROUP BY i.conv_id),
steps AS (
  SELECT conv_id, d AS depth, coalesce(len(path), 0) = d AS here, coalesce(path[1:d], []) AS prefix,
         CASE WHEN d = 0 THEN 0 ELSE strlen(texts[d]) END AS bytes
  FROM (SELECT *, unnest(range(0, coalesce(len(path), 0) + 1)) AS d FROM built)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (here), '')) AS ends_sha256
  FROM steps GROUP BY prefix, depth),
named AS (SELECT s.conv_id AS member, s.depth, n.conv_id FROM steps s JOIN nodes n USING (prefix, depth)),
linked AS (
  SELECT n.conv_id, n.depth, up.conv_id AS parent, n.n_convs, n.saved, n.ends_sha256
  FROM nodes n LEFT JOIN named up ON up.member = n.conv_id AND up.depth = n.depth - 1),
children AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c USING (conv_id, depth)),
below AS (
  SELECT up.conv_id, up.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, sum(c.saved) AS saved_tokens
  FROM counted c JOIN named up ON up.member = c.conv_id AND up.depth <= c.depth GROUP BY ALL)
SELECT c.conv_id, c.depth::bigint AS depth, c.parent AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
       b.saved_tokens::bigint AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b USING (conv_id, depth)
"""
