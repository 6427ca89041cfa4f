"""Person-level duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import ci_key, or_blank
from .keyed import HOT_ROWS, attach

KEYS = ["given", "family", "town", "region"]
#: What orders the records of a person, beside the id.
RANK = ["undated", "shortness", "seen"]


def person_keys(accent: bool = False) -> dict[str, Column]:
    return {
        "given": ci_key(F.col("first_name"), accent),
        "family": ci_key(F.col("last_name"), accent),
        "town": ci_key(or_blank(F.col("city")), accent),
        "region": ci_key(or_blank(F.col("state")), accent),
    }


def person() -> Column:
    """The keys of a person as one value of 16 bytes: the start of a SHA-256 over them and their lengths."""
    keys = [F.concat(F.char_length(c).cast("string"), F.lit(":"), c) for c in person_keys().values()]
    return F.unhex(F.substring(F.sha2(F.concat(*keys), 256), 1, 32))


def takes_part() -> Column:
    """Named rows not marked so far."""
    return F.coalesce(
        (F.col("first_name") != "") & (F.col("last_name") != "")
        & F.col("duplicate_of").isNull(),
        F.lit(False),
    )


def text_length(obits: DataFrame) -> Column:
    """Characters of the text; a stored length saves reading the text itself."""
    if "obit_text_len" in obits.columns:
        return F.coalesce("obit_text_len", F.lit(0))
    return F.char_length(or_blank(F.col("obit_text")))


def _ranks(obits: DataFrame) -> list[Column]:
    """Dated before undated, then the longest text, then the earliest; a missing time is the earliest."""
    seen = F.coalesce("scraped_at", F.lit("0001-01-01").cast("timestamp_ntz"))
    return [F.col("death_date").isNull().alias("undated"), (-text_length(obits)).alias("shortness"), seen.alias("seen")]


def _ranked(obits: DataFrame, accent: bool) -> DataFrame:
    """The narrow columns the choice of a primary needs."""
    return obits.where(takes_part()).select(
        "id", *_ranks(obits), *[c.alias(k) for k, c in person_keys(accent).items()])


def ranked_people(obits: DataFrame) -> DataFrame:
    """The same with the person as one value."""
    return obits.where(takes_part()).select(person().alias("person"), "id", *_ranks(obits))


def live(changes: DataFrame, every: bool = False) -> DataFrame:
    """The records that entered and have not left, of rows that say what entered (op 1) and left (-1);
    with ``every`` all rows that do not cancel out, with their op. No shuffle where the rows lie by person."""
    rest = changes.groupBy("person", "id", *RANK).agg(F.sum("op").cast("int").alias("op"))
    return rest.where("op <> 0") if every else rest.where("op > 0").drop("op")


def _groups(narrow: DataFrame, keys: list[str]) -> DataFrame:
    """Per person the row count and the best row: first by rank, then the lowest id. A plain
    aggregate, so each task first reduces its own rows to one per person."""
    best = F.min(F.struct(*RANK, "id"))
    return narrow.groupBy(*keys).agg(F.count("*").alias("cnt"), best["id"].alias("primary_id"))


def marks_among(narrow: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``id, duplicate_of`` of all but the best row of each person."""
    groups = _groups(narrow, keys).where("cnt > 1")
    members = attach(narrow.select("id", *keys), groups, keys, weight="cnt", spread=F.col("id"), hot_rows=hot_rows)
    return members.where("id <> primary_id").select("id", F.col("primary_id").alias("duplicate_of"))


def duplicate_groups(obits: DataFrame, accent: bool = False) -> DataFrame:
    """Keys and sizes of the groups with more than one row."""
    keyed = obits.where(takes_part()).select(
        *[c.alias(k) for k, c in person_keys(accent).items()])
    return keyed.groupBy(*KEYS).agg(F.count("*").alias("cnt")).where("cnt > 1")


def duplicate_marks(
    obits: DataFrame, accent: bool = False, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``id, duplicate_of`` of the rows to mark now."""
    return marks_among(_ranked(obits, accent), KEYS, hot_rows)


def mark_duplicates(
    obits: DataFrame, accent: bool = False, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The table with ``duplicate_of`` filled for new duplicates, all else unchanged.

    The groups are joined back on the person key, so the wide rows move once. Rows not
    taking part have a null key and scatter.
    """
    part = takes_part()
    keyed = obits.withColumns({
        f"_{k}": F.when(part, c) for k, c in person_keys(accent).items()})
    groups = _groups(_ranked(obits, accent), KEYS).where("cnt > 1")
    keys = [f"_{k}" for k in KEYS]
    for k in KEYS:
        groups = groups.withColumnRenamed(k, f"_{k}")
    joined = attach(keyed, groups, keys, weight="cnt", spread=F.col("id"), hot_rows=hot_rows)
    mark = F.when(F.col("primary_id") != F.col("id"), F.col("primary_id"))
    return joined.withColumn("duplicate_of", F.coalesce("duplicate_of", mark)) \
        .select(*obits.columns)


def with_primary(obits: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Duplicates next to the record they point to."""
    dupes = obits.where("duplicate_of is not null").select(
        "id", "duplicate_of", F.col("legacy_url").alias("duplicate_url"))
    pointed = dupes.groupBy("duplicate_of").agg(F.count("*").alias("cnt"))
    primaries = pointed.join(
        obits.select(F.col("id").alias("duplicate_of"),
                     F.col("legacy_url").alias("primary_url"),
                     F.col("deceased_name").alias("primary_name")),
        "duplicate_of")
    return attach(dupes, primaries, ["duplicate_of"], weight="cnt", spread=F.col("id"),
                  hot_rows=hot_rows)
