"""The record table: scan, view, schema upgrade and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.text import or_blank
from ..schemas import OBITS, VIEW_COLUMNS


def scan_obits(spark: SparkSession, path: str) -> DataFrame:
    """Record table with a declared schema and order of columns: no inference pass, columns
    prune freely, and a condition on ``state_part`` would prune folders."""
    layout = T.StructType([*OBITS.fields, T.StructField("state_part", T.StringType())])
    return spark.read.schema(layout).parquet(path).select(*OBITS.names)


def write_obits(obits: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Snapshot laid out by state, newest first inside a file.

    The folder is a derived column, as a folder name cannot tell a blank from a missing
    state; the state itself stays in the rows. Rows are spread by state and a hash of the id, so a state with much of the table is
    written by several tasks, and each task writes few states.
    """
    cluster_by_state(obits).write.mode(mode).partitionBy("state_part").parquet(path)


#: Folder of blank and missing states.
NO_STATE = "none"


def state_part(state: Column) -> Column:
    """Folder of a state: its upper case, so that a request in any case finds it."""
    return F.when(state != "", F.upper(state)).otherwise(NO_STATE)


def cluster_by_state(obits: DataFrame) -> DataFrame:
    """Rows with their folder, spread for writing and newest first in a task."""
    parts = int(obits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_ = F.pmod(F.xxhash64("id"), F.lit(max(1, parts // 8)))
    return (
        obits.withColumn("state_part", state_part(F.col("state"))).repartition(parts, "state_part", slice_)
        .sortWithinPartitions("state_part", F.col("published_date").desc())
    )


def v_obituaries(obits: DataFrame) -> DataFrame:
    """Records that are no duplicates, without internal columns. Newest first is up to the
    reader: ``newest_first`` on the rows shown, not a sort of the table."""
    return obits.where("duplicate_of is null").select(*VIEW_COLUMNS)


def newest_first(view: DataFrame) -> DataFrame:
    return view.orderBy(F.col("scraped_at").desc_nulls_last(), F.col("id").asc())


def register_view(obits: DataFrame, name: str = "v_obituaries") -> None:
    v_obituaries(obits).createOrReplaceTempView(name)


def upgrade_schema(older: DataFrame, target: T.StructType = OBITS) -> DataFrame:
    """Older layout in the current one; columns it lacks are null."""
    empty = older.sparkSession.createDataFrame([], target)
    return empty.unionByName(older, allowMissingColumns=True).to(target)


def with_text_length(obits: DataFrame) -> DataFrame:
    """Add the text length, so that ranking duplicates never reads the text."""
    return obits.withColumn("obit_text_len", F.char_length(or_blank(F.col("obit_text"))))
