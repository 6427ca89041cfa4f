"""The filtered listing, its facets and its shown page."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import ci_key, first_present, or_blank
from ..schemas import REPORT_COLUMNS

# Size limits of the listing, the shown page and the longer facets.
REPORT_ROWS = 2000
PAGE_ROWS = 50
FACET_ROWS = {"state": None, "county": 500, "city": 500, "funeral_home": 500}


def _like(column: str, fragment: str) -> Column:
    """Substring test; percent sign and underscore typed by the user are wildcards."""
    # A backslash escapes only wildcards and itself; elsewhere it has no effect.
    pattern = re.sub(r"\\(?![%_\\])", "", f"%{fragment}%")
    return F.lower(column).like(pattern.lower())


def predicates(
    funeral_home: str | None = None,
    city: str | None = None,
    county: str | None = None,
    state: str | None = None,
    death_date: str | dt.date | None = None,
) -> list[Column]:
    """Conditions of a report request; blank arguments add none."""
    given = {
        k: str(v).strip() if v is not None else ""
        for k, v in dict(funeral_home=funeral_home, city=city, county=county, state=state,
                         death_date=death_date).items()
    }
    out = [F.col("duplicate_of").isNull()]
    for column in ("funeral_home", "city"):
        if given[column]:
            out.append(_like(column, given[column]))
    for column in ("county", "state"):
        if given[column]:
            out.append(ci_key(F.col(column)) == F.lit(given[column].lower()))
    if given["death_date"]:
        out.append(F.col("death_date") == F.lit(dt.date.fromisoformat(given["death_date"])))
    return out


def report_filter(obits: DataFrame, **filters) -> DataFrame:
    return obits.where(reduce(and_, predicates(**filters)))


def sort_time() -> Column:
    return F.coalesce(*[F.col(c).cast("timestamp_ntz")
                        for c in ("death_date", "published_date", "scraped_at")])


def _latest(obits: DataFrame, limit: int | None, filters: dict) -> DataFrame:
    rows = (
        report_filter(obits, **filters)
        .select("id", *REPORT_COLUMNS, sort_time().alias("_at"))
        .orderBy(F.col("_at").desc_nulls_last(), F.col("id").asc())
    )
    return rows.limit(limit) if limit is not None else rows


def latest_report(obits: DataFrame, limit: int | None = REPORT_ROWS, **filters) -> DataFrame:
    """Newest matching records; None for all. Order and limit form one top-k, no full sort."""
    return _latest(obits, limit, filters).drop("_at")


def display_rows(report: DataFrame, *carried: str) -> DataFrame:
    """Cells as shown: a name in any case, blanks for missing values."""
    both = F.concat_ws(" ", or_blank(F.col("first_name")), or_blank(F.col("last_name")))
    shown = {"name": first_present(F.col("deceased_name"), both)}
    for column in ("birth_date", "death_date", "published_date", "funeral_home", "city",
                   "county", "state", "legacy_url"):
        shown[column] = or_blank(F.col(column).cast("string"))
    return report.select("id", *carried, *[c.alias(n) for n, c in shown.items()])


# Columns the search box looks through; the link column shows no data.
_SEARCHED = ["name", "birth_date", "death_date", "published_date", "funeral_home", "city",
             "county", "state"]


def report_page(
    obits: DataFrame, page: int = 0, search: str = "", size: int = PAGE_ROWS,
    limit: int | None = REPORT_ROWS, **filters,
) -> DataFrame:
    """One shown page of the listing: newest death date first, ties as in the listing,
    optionally only rows holding all searched words. ``limit`` bounds the listing that is
    paged through; None takes all records."""
    listing = _latest(obits, limit, filters)
    rows = display_rows(listing, "_at")
    cells = F.lower(F.concat_ws(" ", *_SEARCHED))
    for word in search.lower().split():
        rows = rows.where(F.contains(cells, F.lit(word)))
    return (
        rows.orderBy(F.col("death_date").desc(), F.col("_at").desc_nulls_last(),
                     F.col("id").asc())
        .offset(page * size).limit(size).drop("_at")
    )


#: Stands for the usual limit of a column.
USUAL = -1


def facet(obits: DataFrame, column: str, limit: int | None = USUAL) -> DataFrame:
    """Distinct non-blank values, one spelling per case-insensitive value.

    The exact spellings are reduced first by a hash aggregate in each task, so what is
    then grouped ignoring case is small however often a value occurs. ``limit`` None gives all
    values. The count is used in
    both steps to keep them apart: the optimizer would merge them and sort all rows.
    """
    spellings = obits.where(F.col(column) != "").groupBy(column).agg(F.count("*").alias("_n"))
    values = (
        spellings.groupBy(ci_key(F.col(column)).alias("_k"))
        .agg(F.min(column).alias(column), F.sum("_n").alias("_n")).where("_n > 0")
        .orderBy(F.col("_k").asc()).select(column)
    )
    limit = FACET_ROWS.get(column) if limit == USUAL else limit
    return values.limit(limit) if limit is not None else values


def facets(obits: DataFrame, limit: int | None = USUAL) -> dict[str, DataFrame]:
    return {column: facet(obits, column, limit) for column in FACET_ROWS}


def record_count(obits: DataFrame) -> DataFrame:
    return obits.agg(F.count("*").alias("obituary_count"))
