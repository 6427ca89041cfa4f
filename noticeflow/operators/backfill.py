"""Filling columns that older records lack. Each returns the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import with_dates_from_text
from ..functions.places import COUNTY_BY_SITE, STATE_BY_PREFIX, lookup
from ..functions.text import ci_key

#: Sources the city backfill leaves out, by the start of their id.
CITY_EXCLUDED_PREFIX = "il-"


def missing_dates() -> Column:
    """Rows with text and at least one date missing."""
    return (F.col("obit_text") != "") & (
        F.col("birth_date").isNull() | F.col("death_date").isNull())


def fill_dates(obits: DataFrame) -> DataFrame:
    """Each date is filled on its own, only where missing and found in the text. A pure
    projection: no shuffle; rows with both dates are not searched."""
    searched = obits.withColumn("_text", F.when(missing_dates(), F.col("obit_text")))
    found = with_dates_from_text(searched, "_text", "_death", "_birth")
    return found.withColumns({
        "birth_date": F.coalesce("birth_date", "_birth"),
        "death_date": F.coalesce("death_date", "_death"),
    }).select(*obits.columns)


def date_counts(obits: DataFrame) -> DataFrame:
    """Rows looked at and dates the fill adds, without writing anything."""
    thin = obits.select("obit_text", "birth_date", "death_date").where(missing_dates())
    found = with_dates_from_text(thin, "obit_text", "_death", "_birth")
    return found.agg(
        F.count("*").alias("rows_processed"),
        F.count_if(F.col("birth_date").isNull() & F.col("_birth").isNotNull())
        .alias("birth_dates_updated"),
        F.count_if(F.col("death_date").isNull() & F.col("_death").isNotNull())
        .alias("death_dates_updated"),
    )


def fill_state(obits: DataFrame) -> DataFrame:
    """Missing states from the source id; blanks are values and stay."""
    prefix = F.regexp_extract(F.lower("site_id"), "^([^-]*)-", 1)
    return obits.withColumn("state", F.coalesce("state", lookup(STATE_BY_PREFIX, prefix)))


def fill_county(obits: DataFrame) -> DataFrame:
    """Missing counties from the source id; blanks are values and stay."""
    return obits.withColumn(
        "county", F.coalesce("county", lookup(COUNTY_BY_SITE, F.lower("site_id"))))


def original_sources(markets: DataFrame) -> DataFrame:
    return markets.where(~F.col("site_id").startswith(CITY_EXCLUDED_PREFIX))


def _first_city(candidates: DataFrame) -> DataFrame:
    """Per link the first non-blank city, in source and page order. An aggregate, so a
    link listed very often is reduced before it is shuffled."""
    usable = candidates.where((F.col("city") != "") & (F.col("url") != ""))
    first = F.min(F.struct("market_seq", "pos", F.col("city").alias("new_city"),
                           F.col("site_id").alias("by_site")))
    return usable.groupBy(ci_key(F.col("url")).alias("_url")).agg(first.alias("_f")) \
        .select("_url", "_f.new_city", "_f.by_site")


def _city_matches(obits: DataFrame, candidates: DataFrame) -> DataFrame:
    keyed = obits.withColumn("_url", ci_key(F.col("legacy_url")))
    return keyed.join(_first_city(candidates), "_url", "left")


def _no_city() -> Column:
    return F.coalesce(F.col("city"), F.lit("")) == ""


def fill_city(obits: DataFrame, candidates: DataFrame) -> DataFrame:
    """Missing or blank cities from listing records of the same link."""
    city = F.when(_no_city(), F.coalesce("new_city", "city")).otherwise(F.col("city"))
    return _city_matches(obits, candidates).withColumn("city", city).select(*obits.columns)


def city_counts(obits: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records each source fills."""
    thin = obits.select("legacy_url", "city").where(_no_city())
    return (
        _city_matches(thin, candidates).where("new_city is not null")
        .groupBy(F.col("by_site").alias("site_id")).agg(F.count("*").alias("updated"))
    )
