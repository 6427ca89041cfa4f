"""Building and extending the source-market dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.places import (
    COUNTY_CLASSES, STATE_SLUGS, display_name, lookup, overridden_slug, site_id,
)
from ..operators.keyed import keep_first, number_rows
from ..schemas import MARKET, MARKET_ROW
from ..sources.markets import read_markets, write_markets


def select_counties(census: DataFrame) -> DataFrame:
    """Counties and county equivalents of the states; the rest is left out."""
    return census.where(F.col("STATE").isin(*STATE_SLUGS) & F.col("CLASSFP").isin(*COUNTY_CLASSES))


def market_rows(census: DataFrame) -> DataFrame:
    """Market columns of every selected county, with the sort columns of the list."""
    counties = select_counties(census).withColumn(
        "_slug", overridden_slug(F.col("STATE"), F.col("COUNTYNAME")))
    return counties.select(
        "STATE", "COUNTYNAME",
        site_id(F.col("STATE"), F.col("_slug")).alias("site_id"),
        lookup(STATE_SLUGS, F.col("STATE")).alias("state_slug"),
        F.col("_slug").alias("legacy_slug"),
        F.lit("county").alias("type"),
        display_name(F.col("COUNTYNAME")).alias("county"),
    )


def build_markets(census: DataFrame) -> DataFrame:
    """Markets in order of state and county name by code point."""
    rows = number_rows(market_rows(census), ["STATE", "COUNTYNAME"], "market_seq", F.lit(0))
    return rows.drop("STATE").withColumnRenamed("state_slug", "state").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MARKET_ROW])


def markets_by_state(markets: DataFrame) -> DataFrame:
    return markets.groupBy("state").agg(F.count("*").alias("markets")).orderBy("state")


def market_totals(markets: DataFrame) -> DataFrame:
    return markets.agg(F.count("*").alias("markets"), F.countDistinct("state").alias("states"))


def from_county_lines(lines: DataFrame) -> DataFrame:
    """Markets of a county list with ``abbrev, state, name, slug`` in list order ``seq``."""
    return lines.select(
        "seq",
        site_id(F.col("abbrev"), F.col("slug")).alias("site_id"), "state",
        F.col("slug").alias("legacy_slug"), F.lit("county").alias("type"),
        F.col("name").alias("county"),
    )


def merge_markets(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Existing markets, then those whose id is new; of repeated ids the first is added."""
    fields = [f.name for f in MARKET]
    firsts = keep_first(added, [F.col("site_id")], [F.col("seq")])
    fresh = firsts.join(existing.select("site_id").distinct(), "site_id", "left_anti")
    both = existing.select(F.lit(0).alias("_part"), F.col("market_seq").alias("_at"), *fields) \
        .unionByName(fresh.select(F.lit(1).alias("_part"), F.col("seq").alias("_at"), *fields))
    return number_rows(both, ["_part", "_at"], "market_seq", F.lit(0)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MARKET_ROW])


def refresh_markets(census: DataFrame, path: str, existing: DataFrame | None = None, ascii_only: bool = False) -> DataFrame:
    """Build the market list, append it to ``existing`` if given, write it and read it back."""
    built = build_markets(census)
    if existing is not None:
        built = merge_markets(existing, built.withColumnRenamed("market_seq", "seq"))
    write_markets(built, path, ascii_only=ascii_only)
    return read_markets(census.sparkSession, path)
