"""Exact de-duplication by progressive refinement: length, prefix hash, full hash.

Texts count as equal when they are the same after deleting every space, tab, line feed,
vertical tab, form feed and carriage return. Three narrow passes cut the rows down:

1. lengths of the stripped texts that occur more than once,
2. among those, (length, hash of the first characters) pairs that occur more than once,
3. among those, SHA-256 of the whole stripped text.

A pass hands its surviving keys to the next as a bitmap of fixed size, so
what is broadcast never grows with the data. Two keys that share a bit only let a text
through that the full hash then tells apart; the result does not depend on the bitmap.

Edge cases. Null counts as empty; empty texts are one group. Of equal texts the row with the
most code points in the original text stays, then the smallest id (a null id comes first).
Rows that repeat an id and its text are reported alike. An empty table gives no rows. Only the
id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import drop_staged, stage
from noticeflow.llm.membership import bitmap, probe

#: Code points of the stripped text that the prefix hash covers.
PREFIX_CHARS = 128


def stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is null for texts that were told apart before their full hash was needed,
    unless ``digest_all`` asks for it everywhere.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), stripped(F.col(text_col)).alias("_norm"),
                       F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("_points"))
    keyed = base.select("*", F.length("_norm").alias("_len"),
                        F.xxhash64(F.substring("_norm", 1, PREFIX_CHARS)).alias("_prefix"))

    narrow = stage(keyed.select("_len", "_prefix"), "dedup-keys")
    lengths = stage(bitmap(narrow.groupBy("_len").count().filter("count > 1"), "_by_length", "_len"),
                    "dedup-lengths")
    pairs = (probe(narrow, lengths, "_by_length", "_len").filter("_by_length")
             .groupBy("_len", "_prefix").count().filter("count > 1"))
    prefixes = stage(bitmap(pairs, "_by_prefix", "_len", "_prefix"), "dedup-prefixes")
    drop_staged(narrow)

    probed = probe(probe(keyed, lengths, "_by_length", "_len"), prefixes, "_by_prefix", "_len", "_prefix")
    survives = F.col("_by_length") & F.col("_by_prefix")
    digest = F.sha2(F.col("_norm").cast("binary"), 256)
    rows = stage(probed.select(
        "doc_id", "_points", survives.alias("_survives"),
        F.unhex(digest if digest_all else F.when(survives, digest)).alias("_full")), "dedup-rows")

    groups = stage(rows.filter("_survives").groupBy("_full").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("_points")).alias("p"), F.col("doc_id").alias("id"))).alias("_best"),
    ).filter("group_size > 1").select("_full", "group_size", F.col("_best.id").alias("keep_id"),
                                      F.lit(True).alias("_grouped")), "dedup-groups")

    alone = rows.filter("not _survives").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "_full")
    grouped = rows.filter("_survives").join(groups, "_full", "left").select(
        "doc_id", F.when(F.col("_grouped"), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "_full")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_full")).alias("text_sha256"))
