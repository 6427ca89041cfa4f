"""Backfills of the store: what they find is written as narrow rows, records stay as they are."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..operators.backfill import city_counts, fill_city, fill_county, fill_dates, fill_state, original_sources
from ..schemas import OBITS
from ..session import stage
from .daily import candidate_rows
from .store import FILLED, Store, missing

SOURCE = "backfill"


def _found(filled: DataFrame, columns: list[str]) -> DataFrame:
    """Id and new values of the rows in which a missing value was found; the old values stand
    beside the new as _old_<column>."""
    lacks = {c: F.coalesce(F.col(f"_old_{c}") == "", F.lit(True)) if c == "city" else F.col(f"_old_{c}").isNull()
             for c in columns}
    rows = filled.select("id", *[
        (F.when(lacks[c], F.nullif(F.col(c), F.lit("")) if c == "city" else F.col(c)) if c in columns else F.lit(None))
        .cast(OBITS[c].dataType).alias(c) for c in FILLED])
    return rows.where(reduce(or_, [F.col(c).isNotNull() for c in columns]))


def _write(store: Store, epoch: int, found: DataFrame) -> int:
    batch, done = store.claim(SOURCE, epoch)
    if not done:
        store.append_fills(found, batch)
        store.complete(SOURCE, epoch, batch)
    return batch


def run_backfill(store: Store, epoch: int) -> int:
    """Fill missing dates from texts, and states and counties from source ids; returns the
    batch. A scan and a projection: nothing is shuffled."""
    columns = ["birth_date", "death_date", "state", "county"]
    now = store.obits().select("id", "site_id", "obit_text", *columns, *[F.col(c).alias(f"_old_{c}") for c in columns])
    return _write(store, epoch, _found(fill_county(fill_state(fill_dates(now))), columns))


def run_city_backfill(store: Store, epoch: int, pages: DataFrame, markets: DataFrame, base_url: str) -> DataFrame:
    """Fill missing cities from the listing pages of the original sources; returns the number
    of records that each source filled. Only records without a city are joined."""
    rows = candidate_rows(pages, original_sources(markets), base_url).where("pos is not null")
    lacking = store.obits().where(missing("city")).select("id", "legacy_url", "city", F.col("city").alias("_old_city"))
    lacking = stage(lacking, "without-city")
    counts = stage(city_counts(lacking, rows), "city-counts")
    _write(store, epoch, _found(fill_city(lacking, rows), ["city"]))
    return counts
