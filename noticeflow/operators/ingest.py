"""Appending unseen records with per-source accounting.

A candidate row is one record on one listing page: ``market_seq`` is the place of its
source in the run, ``pos`` its place on the page. Sources are processed in that order, so
what counts as stored when a source starts is settled by the lowest ``market_seq`` of a
link; no loop over sources is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import ci_key, or_blank
from ..schemas import OBITS, RUN_LOG, WIDTHS
from .keyed import HOT_ROWS, attach, keep_first, number_rows

_LINK_WIDTH = WIDTHS["legacy_url"]
#: Column of a table of stored links.
LINK_KEY = "link_key"


def stored_key(url: Column) -> Column:
    """Identity of a link as stored: cut to the column width, case ignored."""
    return ci_key(F.substring(url, 1, _LINK_WIDTH))


def link_key(url: Column) -> Column:
    """The same in 16 bytes: the start of its SHA-256."""
    return F.unhex(F.substring(F.sha2(stored_key(url), 256), 1, 32))


def _keyed(candidates: DataFrame) -> DataFrame:
    """Usable candidates with their key. An over-long link never equals a stored one, so
    the stored check does not catch it, but its cut form still meets the unique key."""
    return candidates.where(F.col("url") != "").withColumns({
        "_key": link_key(F.col("url")),
        "_long": F.char_length("url") > _LINK_WIDTH,
    })


def _stored_among(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored keys that occur among ``keys``. ``stored`` is a record table or a table of link keys. It is
    far larger than a run, so it is first cut down by the run's keys; where those are few Spark
    broadcasts them, and a bucketed table of keys is not shuffled."""
    own = F.col(LINK_KEY) if LINK_KEY in stored.columns else link_key(F.col("legacy_url"))
    return stored.select(own.alias("_key")).join(keys.select("_key").distinct(), "_key", "left_semi")


def wanted_links(candidates: DataFrame) -> DataFrame:
    """Keys of the candidates' links, to be looked up in a table of link keys. Those that it has stand for
    the store in the functions below, so that a run looks at the store once."""
    return _keyed(candidates).select(F.col("_key").alias(LINK_KEY))


def new_links(
    candidates: DataFrame, stored: DataFrame, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Candidates whose link is not stored, repeats included. The verdict is taken once
    per link and then attached to its rows."""
    keyed = _keyed(candidates)
    per_key = keyed.groupBy("_key").agg(F.count("*").alias("_n"))
    known = _stored_among(stored, per_key).distinct().withColumn("_known", F.lit(True))
    verdict = per_key.join(known, "_key", "left")
    judged = attach(keyed, verdict, ["_key"], weight="_n", hot_rows=hot_rows,
                    spread=F.struct("market_seq", "pos"))
    return judged.where(F.col("_known").isNull() | F.col("_long")) \
        .select(*candidates.columns)


def with_market(candidates: DataFrame, markets: DataFrame) -> DataFrame:
    """County of the source on every candidate, by the source's place in the list: a
    ``site_id`` may be there twice. The list is a small dimension; Spark broadcasts it when
    its size allows."""
    places = markets.select(F.col("market_seq").alias("market_no"), or_blank(F.col("county")).alias("county"))
    return _with_market_no(candidates).join(places, "market_no").select(*candidates.columns, "county")


def first_new(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """The candidates an insert keeps: per unseen link the first one."""
    keyed = _keyed(candidates)
    # Two pages of one source have equal places; the row itself then decides.
    tie = F.xxhash64(*[F.col(c) for c in sorted(candidates.columns)])
    firsts = keep_first(keyed, [F.col("_key")], [F.col("market_seq"), F.col("pos"), tie])
    known = _stored_among(stored, keyed)
    return firsts.join(known, "_key", "left_anti").drop("_key", "_long")


def _fitted(column: str, source: Column) -> Column:
    width = WIDTHS.get(column)
    return F.substring(source, 1, width) if width else source


def as_records(new: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stored form of new candidates, still without ids: missing text becomes blank,
    missing dates and funeral home stay null, long text is cut."""
    blank = {
        c: or_blank(F.col(s)) for c, s in [
            ("legacy_url", "url"), *[(c, c) for c in (
                "deceased_name", "first_name", "middle_name", "last_name", "name_suffix",
                "city", "state", "county", "obit_text")]]
    }
    kept = {c: F.col(c) for c in
            ("published_date", "death_date", "birth_date", "funeral_home")}
    values = {"site_id": F.coalesce("site_id", F.lit("unknown")), **blank, **kept,
              "scraped_at": F.lit(as_of.replace(microsecond=0)).cast("timestamp_ntz"),
              "sent_to_cms": F.lit(False)}
    return new.select(
        "market_seq", "pos",
        *[_fitted(f.name, values[f.name]).cast(f.dataType).alias(f.name)
          for f in OBITS if f.name in values])


def with_ids(records: DataFrame, last_id: int) -> DataFrame:
    """Consecutive ids after ``last_id`` in source and page order."""
    numbered = number_rows(records, ["market_seq", "pos", "legacy_url"], "id",
                           F.lit(last_id + 1).cast("bigint"))
    return numbered.select(*[
        (F.col(f.name) if f.name in numbered.columns else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in OBITS])


def last_id(stored: DataFrame) -> int:
    return stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def insert_ignore(
    candidates: DataFrame, stored: DataFrame, as_of: dt.datetime,
) -> DataFrame:
    """Records to append: one per unseen link, first source and page position wins."""
    return with_ids(as_records(first_new(candidates, stored), as_of), last_id(stored))


def _with_market_no(candidates: DataFrame) -> DataFrame:
    """The place of the source in the market list. ``market_seq`` may hold the day as well."""
    if "market_no" in candidates.columns:
        return candidates
    return candidates.withColumn("market_no", F.col("market_seq"))


def link_counts(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Found and new records per source.

    Found: rows whose link was not stored when the source started, repeats included. New:
    rows inserted. Rows are first counted per link and source, then reduced per link;
    both are partial aggregates, so neither a link on all pages nor a page with most of
    the rows meets in one task.
    """
    keyed = _keyed(_with_market_no(candidates))
    per_source = keyed.groupBy("_key", "market_seq", "market_no", "site_id").agg(
        F.count_if(~F.col("_long")).alias("n"))
    per_link = per_source.groupBy("_key").agg(
        F.min(F.struct("market_seq", "market_no", "site_id", "n")).alias("_first"))
    fresh = per_link.join(_stored_among(stored, per_link), "_key", "left_anti")
    counted = fresh.select(F.col("_first.market_no").alias("market_no"), F.col("_first.site_id").alias("site_id"),
                           F.col("_first.n").alias("found"), F.lit(1).alias("new"))
    long_links = keyed.where("_long").select(
        "market_no", "site_id", F.lit(1).cast("bigint").alias("found"), F.lit(0).alias("new"))
    return counted.unionByName(long_links).groupBy("market_no", "site_id").agg(
        F.sum("found").alias("found"), F.sum("new").alias("new"))


def run_log(
    markets: DataFrame,
    candidates: DataFrame,
    stored: DataFrame,
    errors: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """One row per source of the run, also for failed ones, which count as zero.

    A source is a row of ``markets``, told by its place: a repeated ``site_id`` has a row for
    each place with that place's counts. ``errors`` has the place as ``market_no``.
    """
    counts = link_counts(candidates, stored).drop("site_id")
    failed = errors.groupBy("market_no").agg(F.min("error").alias("errors"))
    ok = F.col("errors").isNull()
    return (
        markets.select("site_id", F.col("market_seq").alias("market_no")).join(counts, "market_no", "left")
        .join(failed, "market_no", "left")
        .select(
            F.coalesce("site_id", F.lit("unknown")).alias("site_id"),
            F.lit(as_of.date()).alias("run_date"),
            F.when(ok, F.coalesce("found", F.lit(0))).otherwise(0).cast("int")
            .alias("obits_found"),
            F.when(ok, F.coalesce("new", F.lit(0))).otherwise(0).cast("int")
            .alias("obits_new"),
            "errors",
            F.lit(as_of.replace(microsecond=0)).cast("timestamp_ntz").alias("run_at"),
        )
        .to(RUN_LOG)
    )


def run_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("markets"),
        F.coalesce(F.sum("obits_found"), F.lit(0)).alias("total_found"),
        F.coalesce(F.sum("obits_new"), F.lit(0)).alias("total_new"),
    )
