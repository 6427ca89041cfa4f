"""Corpus preparation: each stage takes the documents its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). All stages but the
last return the columns of ``documents``. What a stage decides holds for a row, not for its id: of
equal or near rows one stays, also where ids are null or repeat. Other columns are carried on and may
have any name. A null text is empty, a text is read whole however long it is, and an empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import bpe, quality
from noticeflow.llm.common import ship, stage, table
from noticeflow.llm.decontaminate import find_leaks
from noticeflow.llm.exact_dedup import exact_dedup
from noticeflow.llm.membership import bitmap, probe
from noticeflow.llm.ngram_join import ngram_join
from noticeflow.llm.queries import QUALITY_CUT, VOCABULARY, quality_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Columns that tell rows apart: the id first, so that the smallest row of a group has its smallest id.
FILE, PLACE = "_file", "_place_in_file"


def free(name: str, docs: DataFrame) -> str:
    """A name that no column of the documents has, in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(docs: DataFrame, nulls_last: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a column, of the name returned, which no two rows share: id, file and place in
    the file. Ids may be null or repeat. Every stage reads a written table; other data is written
    first. With ``nulls_last`` a null id comes after all others."""
    row, meta = free("_row", docs), free("_meta", docs)
    try:
        read = docs.select("*", docs.metadataColumn("_metadata").alias(meta))
        read.select(f"{meta}.row_index").schema  # noqa: B018 - analysed here: no such field without parquet files
    except AnalysisException:
        docs = stage(docs, "rows")
        read = docs.select("*", docs.metadataColumn("_metadata").alias(meta))
    order = [F.col("doc_id").isNull().alias("_no_id")] if nulls_last else []
    return read.select(*docs.columns, F.struct(
        *order, "doc_id", F.unhex(F.md5(F.col(f"{meta}.file_path").cast("binary"))).alias(FILE),
        F.col(f"{meta}.row_index").alias(PLACE)).alias(row)), row


def without(rows: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """The documents whose ``row`` is not in ``dropped`` (doc_id). Only documents that share a bit
    with a dropped row move for the join; all others stay where they are. A row's fate is its own,
    whatever other rows have its id."""
    columns = [c for c in rows.columns if c != row]
    mark, other = free("_gone", rows), free("_dropped", rows)
    gone = stage(dropped.select("doc_id").distinct(), "dropped")
    probed = probe(rows, stage(bitmap(gone, mark, "doc_id"), "dropped-bits"), mark, row)
    doubtful = probed.filter(F.col(mark)).join(
        gone.withColumnRenamed("doc_id", other), F.col(row).eqNullSafe(F.col(other)), "left_anti")
    return probed.filter(~F.col(mark)).unionByName(doubtful).select(*columns)


def drop_poor_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    into = free("_quality", docs)
    scored = quality.score(docs, quality_model(spark, sf_dir), into=into)
    return scored.filter(F.col(into) >= QUALITY_CUT).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = rows_of(docs)
    return without(rows, row, exact_dedup(rows, row).filter("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = rows_of(docs, nulls_last=True)
    return without(rows, row, ngram_join(rows, row).filter("not kept"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = rows_of(docs)
    return without(rows, row, find_leaks(rows, table(spark, sf_dir, "benchmark"), row))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, VOCABULARY).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor_text),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("bpe", tokenize),
]

#: The classifier, the pairs and the token ids have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
