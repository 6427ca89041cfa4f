"""Registered queries: every operator of the library over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeflow.functions.dates import (
    is_date_range, parse_date, range_end, with_dates_from_text, with_deciding_patterns,
)
from noticeflow.functions.names import with_split_name
from noticeflow.functions.places import county_slug, display_name, overridden_slug, site_id
from noticeflow.functions.urls import absolutise, with_listing_url
from noticeflow.operators import backfill, dedup, detail, ingest, listing, report
from noticeflow.operators.keyed import keep_first
from noticeflow.plans import market_build
from noticeflow.plans.archive import PageArchive
from noticeflow.plans.backfill_run import run_backfill, run_city_backfill
from noticeflow.plans.bucketed import BucketTable
from noticeflow.plans.compaction import compact, vacuum
from noticeflow.plans.daily import mark, marked_count as count_marked, run_day
from noticeflow.plans.store import NUMBERED, Store
from noticeflow.schemas import LISTING_PAGES, MARKET, OBITS, RECORD_FIELDS
from noticeflow.session import stage, staging_root
from noticeflow.sources import markets as market_io
from noticeflow.sources import tables
from noticeflow.streaming.page_stream import ingest_stream, page_stream

from .inputs import AS_OF, BASE_URL, PAGE_SPAN, STORED_UNTIL, detail_pages, load, payload_pages

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids a name clash."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def _obits(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "obits")[0].select(*OBITS.names)


# --- table, view, schema ------------------------------------------------------------------

@query
def scan_obits(spark, d):
    """Written and read back; blank and missing states stay apart."""
    path = f"{staging_root(spark)}/obits-{uuid.uuid4().hex}"
    states = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("state"))
    tables.write_obits(_obits(spark, d).withColumn("state", states), path)
    return tables.scan_obits(spark, path)


@query
def v_obituaries(spark, d):
    marked = dedup.mark_duplicates(_obits(spark, d))
    return tables.v_obituaries(marked)


@query
def obit_count(spark, d):
    return report.record_count(_obits(spark, d))


@query
def schema_upgrade(spark, d):
    older = _obits(spark, d).drop("city", "state", "county", "duplicate_of")
    return tables.upgrade_schema(older)


# --- duplicates ---------------------------------------------------------------------------

@query
def person_dedup(spark, d):
    return dedup.mark_duplicates(_obits(spark, d)).select("id", "duplicate_of")


@query
def dupe_groups(spark, d):
    return dedup.duplicate_groups(_obits(spark, d))


def _second_run(spark, d) -> DataFrame:
    """Records after a run over the earlier ones and a run over all. As between two days,
    the table is written in between."""
    everything, stored = load(spark, d, "obits", "stored")
    first = dedup.mark_duplicates(stored.select(*OBITS.names))
    later = everything.where(f"scraped_at >= timestamp_ntz '{STORED_UNTIL} 00:00:00'")
    table = stage(first.unionByName(later.select(*OBITS.names)), "first-run")
    return dedup.mark_duplicates(table)


@query
def dedup_incremental(spark, d):
    return _second_run(spark, d).select("id", "duplicate_of")


@query
def dup_with_primary(spark, d):
    return dedup.with_primary(stage(_second_run(spark, d), "second-run"))


# --- report -------------------------------------------------------------------------------

@query
def report_filter(spark, d):
    obits = dedup.mark_duplicates(_obits(spark, d))
    requests = {
        "funeral_home": {"funeral_home": "build%Home"},
        "city": {"city": "nation_1"},
        "county": {"county": " county 7 "},
        "state": {"state": "eu"},
        "death_date": {"death_date": "1998-03-05"},
        "combined": {"state": "am", "city": "NATION", "funeral_home": "furniture"},
        "none": {},
    }
    out = None
    for name, args in requests.items():
        part = report.report_filter(obits, **args).select(
            F.lit(name).alias("request"), "id")
        out = part if out is None else out.unionByName(part)
    return out


@query
def latest_report(spark, d):
    return report.latest_report(dedup.mark_duplicates(_obits(spark, d)))


@query
def report_rows(spark, d):
    return report.display_rows(_obits(spark, d))


@query
def report_page(spark, d):
    return report.report_page(dedup.mark_duplicates(_obits(spark, d)), page=1,
                              search="Funeral nation", county="county 7")


def _facet(column: str) -> Query:
    return lambda spark, d: report.facet(_obits(spark, d), column)


for _column in report.FACET_ROWS:
    REGISTRY[f"facet_{_column}"] = _facet(_column)


@query
def facet_all(spark, d):
    """A facet without a limit, over a column with many values."""
    named = _obits(spark, d).withColumn("county", F.concat(F.lit("County "), F.col("id") % 2000))
    return report.facet(named, "county", limit=None)


@query
def report_page_beyond(spark, d):
    """A page behind the usual end of the listing."""
    return report.report_page(_obits(spark, d), page=45, limit=None)


# --- scalar functions -----------------------------------------------------------------------

@query
def split_name(spark, d):
    names = _obits(spark, d).select("id", F.concat_ws(
        " ", "first_name", "middle_name", F.lit(" Anna,"), "last_name", "name_suffix")
        .alias("full_name"))
    return with_split_name(names, "full_name")


@query
def extract_dates(spark, d):
    return with_dates_from_text(_obits(spark, d).select("id", "obit_text"), "obit_text") \
        .drop("obit_text")


@query
def extract_dates_documents(spark, d):
    docs = load(spark, d, "documents")[0]
    return with_dates_from_text(docs.select("doc_id", "text"), "text").drop("text")


@query
def death_pattern_hits(spark, d):
    hits = with_deciding_patterns(_obits(spark, d).select("obit_text"), "obit_text")
    return hits.groupBy("death_pattern", "birth_pattern").agg(F.count("*").alias("n"))


def _date_spellings(obits: DataFrame) -> DataFrame:
    day = F.col("published_date")
    return obits.select("id", F.explode(F.array(
        F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(day, "MMMM d, yyyy"), F.concat(F.lit("on "), F.date_format(day, "MMM. d, yyyy")),
        F.date_format(day, "M/d/yyyy"), F.date_format(day, "MM-dd-yyyy"),
        F.date_format(day, "d. MMMM yyyy"), F.lit("2001-02-30"))).alias("s"))


@query
def parse_date_(spark, d):
    return _date_spellings(_obits(spark, d)).select("id", "s", parse_date(F.col("s")).alias("d"))


@query
def date_range(spark, d):
    texts = _obits(spark, d).select("id", F.concat(
        F.date_format("birth_date", "MMMM d, yyyy"),
        F.when(F.col("city") == "", " to ").when(F.col("middle_name") == "", " - ").otherwise(" / "),
        F.date_format("published_date", "MMMM d, yyyy")).alias("s"))
    return texts.select("id", "s", is_date_range(F.col("s")).alias("is_range"),
                        range_end(F.col("s")).alias("d"))


@query
def absolutise_url(spark, d):
    rel = F.when(F.col("middle_name") == "", F.col("legacy_url")) \
        .when(F.col("name_suffix") != "", "").otherwise(
            F.substring("legacy_url", len(BASE_URL) + 1, 10_000))
    return _obits(spark, d).select("id", absolutise(rel, BASE_URL).alias("url"))


@query
def listing_url(spark, d):
    rows = load(spark, d, "gaps")[0].select(
        "id", F.col("state").alias("state"), F.concat(F.lit("  "), "site_id").alias("legacy_slug"))
    out = with_listing_url(rows, BASE_URL + "/us/obituaries/local")
    return out.select("id", "listing_url", F.col("error").isNotNull().alias("failed"))


# --- markets --------------------------------------------------------------------------------

@query
def county_slug_(spark, d):
    census = load(spark, d, "census")[0]
    name = F.col("COUNTYNAME")
    return census.select("STATE", "COUNTYNAME", display_name(name).alias("county"),
                         county_slug(name).alias("slug"),
                         overridden_slug(F.col("STATE"), name).alias("used_slug"),
                         site_id(F.col("STATE"), overridden_slug(F.col("STATE"), name)).alias("site_id"))


def _census_file(spark, d) -> DataFrame:
    """The county file written and scanned; fields padded as in a fixed-width export."""
    path = f"{staging_root(spark)}/census-{uuid.uuid4().hex}"
    census = load(spark, d, "census")[0]
    census.select(*[F.concat(F.lit(" "), c, F.lit("  ")).alias(c) for c in census.columns]) \
        .write.mode("overwrite").csv(path, sep="|", header=True, ignoreLeadingWhiteSpace=False,
                                     ignoreTrailingWhiteSpace=False)
    return market_io.census_scan(spark, path)


@query
def census_scan(spark, d):
    return _census_file(spark, d)


@query
def markets_build(spark, d):
    return market_build.build_markets(load(spark, d, "census")[0])


@query
def markets_roundtrip(spark, d):
    """Built, written with escapes and read back; names are not ASCII."""
    census = load(spark, d, "census")[0]
    path = f"{staging_root(spark)}/markets-{uuid.uuid4().hex}"
    return market_build.refresh_markets(census, path, ascii_only=True)


@query
def markets_by_state(spark, d):
    return market_build.markets_by_state(_markets(spark, d))


@query
def market_totals(spark, d):
    return market_build.market_totals(_markets(spark, d))


def _markets(spark, d) -> DataFrame:
    rows = market_build.market_rows(load(spark, d, "census")[0])
    return rows.drop("STATE").withColumnRenamed("state_slug", "state")


@query
def markets_scan(spark, d):
    """Market arrays of at most ``PAGE_SPAN`` markets, decoded with their places."""
    listed = market_build.from_county_lines(
        market_io.county_lines(load(spark, d, "lines")[0], "line"))
    item = F.struct("seq", F.to_json(F.struct(*MARKET.names)).alias("o"))
    objects = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["o"])
    arrays = listed.groupBy(F.floor(F.col("seq") / PAGE_SPAN).alias("block")).agg(
        F.concat(F.lit("["), F.array_join(objects, ",\n"), F.lit("]")).alias("value"))
    return market_io.decode_markets(arrays)


@query
def county_lines(spark, d):
    return market_io.county_lines(load(spark, d, "lines")[0], "line")


@query
def markets_merge(spark, d):
    lines = market_io.county_lines(load(spark, d, "lines")[0], "line")
    listed = market_build.from_county_lines(lines)
    older = listed.where("county like '%5%'")
    existing = keep_first(older, [F.col("site_id")], [F.col("seq").desc()]) \
        .withColumnRenamed("seq", "market_seq")
    return market_build.merge_markets(existing, listed)


@query
def site_prefix(spark, d):
    return backfill.original_sources(load(spark, d, "gaps")[0]).select("id", "site_id")


# --- ingest ---------------------------------------------------------------------------------

def _run(spark, d):
    candidates, stored, sites = load(spark, d, "candidates", "stored", "sites")
    return candidates, stored, sites


def _known_links(spark, d) -> tuple[DataFrame, DataFrame]:
    """The candidates, and which of their links two days have stored, by the table of link keys."""
    candidates, stored, _ = _run(spark, d)
    store = _fresh_store(spark, "links")
    for batch in (0, 1):
        store.load(stored.where(F.col("id") % 2 == batch).select(*OBITS.names), batch)
    return candidates, store.snapshot().stored_among(ingest.wanted_links(candidates))


@query
def new_urls(spark, d):
    """The verdict reads the keys of the stored links, not the records."""
    candidates, stored, _ = _run(spark, d)
    index = BucketTable(spark, f"{staging_root(spark)}/links-{uuid.uuid4().hex}", f"{ingest.LINK_KEY} BINARY", ingest.LINK_KEY, 16)
    index.append(stored.select(ingest.link_key(F.col("legacy_url")).alias(ingest.LINK_KEY)), 1)
    known = index.among([1], ingest.wanted_links(candidates)).select(ingest.LINK_KEY)
    return ingest.new_links(candidates, stage(known, "known")).select("site_id", "pos", "url")


@query
def stored_links(spark, d):
    """A run's one look at the store, by number of rows that each known link has."""
    candidates, known = _known_links(spark, d)
    known = known.distinct()
    rows = candidates.select(ingest.link_key(F.col("url")).alias(ingest.LINK_KEY), "site_id").join(known, ingest.LINK_KEY)
    return rows.groupBy("site_id").agg(F.count("*").alias("known_rows"))


@query
def attach_market(spark, d):
    candidates, _, sites = _run(spark, d)
    return ingest.with_market(candidates.drop("county"), sites).select(
        "site_id", "pos", "url", "county")


@query
def keep_first_(spark, d):
    candidates = _run(spark, d)[0]
    return keep_first(candidates, [F.lower("url")], [F.col("market_seq"), F.col("pos")]) \
        .select("market_seq", "pos", "url")


@query
def insert_ignore(spark, d):
    candidates, stored, _ = _run(spark, d)
    return ingest.insert_ignore(candidates, stored, AS_OF)


def _run_log(spark, d) -> DataFrame:
    candidates, stored, sites = _run(spark, d)
    failed = sites.where("county = 'County 3'").select(
        F.col("market_seq").alias("market_no"), F.lit("ValueError: bad page").alias("error"))
    return ingest.run_log(sites, candidates, stored, failed, AS_OF)


@query
def run_log(spark, d):
    return _run_log(spark, d)


@query
def run_totals(spark, d):
    return ingest.run_totals(_run_log(spark, d))


@query
def enrich_merge(spark, d):
    obits = load(spark, d, "obits")[0]
    thin = obits.withColumn("obit_text", F.when(F.col("priority") != "4-NOT SPECIFIED", "")
                            .otherwise(F.col("obit_text")))
    records = thin.select("id", F.col("legacy_url").alias("url"), *RECORD_FIELDS[1:])
    return detail.enrich(records, detail_pages(obits)).drop("url")


@query
def enrich_archive(spark, d):
    """The same from an archive of three days. Each link has a page on one or two of them, an older page
    is empty, and one of the days is stored twice."""
    obits = load(spark, d, "obits")[0]
    thin = obits.withColumn("obit_text", F.when(F.col("priority") != "4-NOT SPECIFIED", "").otherwise(F.col("obit_text")))
    pages = detail_pages(obits.withColumn("legacy_url", F.concat("legacy_url", F.lit("#"), F.col("id").cast("string"))))
    pages = stage(pages.select(F.substring_index("url", "#", 1).alias("url"), "html", (
        F.substring_index("url", "#", -1).cast("bigint") % 2).alias("late")), "pages")
    empty = pages.select("url", F.lit("<html></html>").alias("html"))
    archive = PageArchive(spark, f"{staging_root(spark)}/pages-{uuid.uuid4().hex}")
    first, second = AS_OF.date() - dt.timedelta(days=1), AS_OF.date()
    archive.store_day(empty, first - dt.timedelta(days=9))
    archive.store_day(empty, second)
    archive.store_day(pages.where("late = 0"), first)
    archive.store_day(pages.where("late = 1"), second)
    records = thin.select("id", F.col("legacy_url").alias("url"), *RECORD_FIELDS[1:])
    wanted = records.where(detail.thin()).select("url")
    return detail.with_pages(records, archive.newest(wanted)).drop("url")


# --- backfills ------------------------------------------------------------------------------

@query
def backfill_dates(spark, d):
    return backfill.fill_dates(_obits(spark, d)).select("id", "death_date", "birth_date")


@query
def backfill_counts(spark, d):
    return backfill.date_counts(_obits(spark, d))


@query
def backfill_state(spark, d):
    return backfill.fill_state(load(spark, d, "gaps")[0])


@query
def backfill_county(spark, d):
    return backfill.fill_county(load(spark, d, "gaps")[0])


def _city_inputs(spark, d):
    obits, candidates = load(spark, d, "obits", "candidates")
    listed = candidates.withColumn(
        "city", F.when(F.coalesce("city", F.lit("")) == "", F.concat(F.lit("New "), "site_id"))
        .otherwise(F.col("city")))
    return obits, listed


@query
def backfill_city(spark, d):
    return backfill.fill_city(*_city_inputs(spark, d)).select("id", "city")


@query
def backfill_city_counts(spark, d):
    return backfill.city_counts(*_city_inputs(spark, d))


# --- pages ----------------------------------------------------------------------------------

def _layout(name: str) -> Query:
    def run(spark, d):
        pages = payload_pages(load(spark, d, "obits")[0], name)
        rows = listing.extract_records(pages, BASE_URL)
        return rows.drop("error", "pos" if name == "links" else "error")

    return run


for _name, _kind in (("extract_json", "json"), ("extract_state_json", "state"),
                     ("extract_links", "links")):
    REGISTRY[_name] = _layout(_kind)


@query
def extract_cascade(spark, d):
    """Records of all layouts at once, and pages that hold none."""
    obits, pages = load(spark, d, "obits", "pages")
    made = [payload_pages(obits, k).withColumn("kind", F.lit(k)) for k in ("json", "state", "links")]
    crawled = pages.select("page_id", "html", F.lit("crawled").alias("kind"))
    every = made[0].unionByName(made[1]).unionByName(made[2]).unionByName(crawled)
    return listing.extract_records(every, BASE_URL).select("kind", "page_id", "pos", "url", "deceased_name", "error")


@query
def extract_alt_path(spark, d):
    """Payloads with the list below another key, and payloads that are no objects."""
    pages = payload_pages(load(spark, d, "obits")[0], "json")
    other = F.replace("html", F.lit('"obituaryList"'), F.lit('"empty":{"obituaries":[]},"nearby"'))
    bad = F.regexp_replace(F.col("html"), r'(?s)<!--\{.*\}-->', "<!--[" + "1, " * 60 + "1]-->")
    html = F.when(F.col("page_id") % 5 == 0, bad).otherwise(other)
    rows = listing.extract_records(pages.withColumn("html", html), BASE_URL)
    return rows.select("page_id", "pos", "url", "deceased_name", F.col("error").alias("error"))


@query
def page_title(spark, d):
    pages = load(spark, d, "pages")[0]
    return detail.extract_details(pages.select("page_id", "html")).select("page_id", "name")


@query
def page_text(spark, d):
    pages = load(spark, d, "pages")[0]
    return detail.extract_details(pages.select("page_id", "html")).select("page_id", "text")


@query
def page_fields(spark, d):
    pages = detail_pages(load(spark, d, "obits")[0])
    return detail.extract_details(pages).select("url", "name", "funeral_home", "text")


@query
def page_dates(spark, d):
    pages = detail_pages(load(spark, d, "obits")[0])
    return detail.extract_details(pages).select("url", "published", "death")


@query
def link_dedup(spark, d):
    """Record links of pages that list every link two or three times: the first of equal addresses per page."""
    pages = payload_pages(load(spark, d, "obits")[0], "links")
    twice = pages.withColumn("html", F.concat("html", F.replace("html", F.lit("<h3> "), F.lit("<h3>Again "))))
    return listing.extract_records(twice, BASE_URL).select("page_id", "pos", "url", "deceased_name")


# --- runs -----------------------------------------------------------------------------------

def _run_inputs(spark, d):
    """A source per page of records, its listing page and the detail pages."""
    obits = load(spark, d, "obits")[0]
    pages = payload_pages(obits, "json").select(
        F.lit(AS_OF.date()).alias("run_date"), F.concat(F.lit("s-"), "page_id").alias("site_id"),
        F.lit(BASE_URL).alias("url"), "html")
    markets = pages.select(
        F.regexp_extract("site_id", "[0-9]+", 0).cast("int").alias("market_seq"), "site_id",
        F.lit("ohio").alias("state"), F.col("site_id").alias("legacy_slug"),
        F.lit("county").alias("type"), F.lit("Some").alias("county"))
    return pages, detail_pages(obits), markets


def _fresh_store(spark, label: str) -> Store:
    return Store(spark, f"{staging_root(spark)}/store-{label}-{uuid.uuid4().hex}")


@query
def daily_run(spark, d):
    pages, details, markets = _run_inputs(spark, d)
    store = _fresh_store(spark, "daily")
    run_day(store, pages, details, markets, AS_OF, 0, BASE_URL)
    return store.obits().select("id", "site_id", "legacy_url", "deceased_name", "death_date",
                                "birth_date", "city", "duplicate_of")


def _appended(store: Store) -> DataFrame:
    return store.obits().select("id", "site_id", "legacy_url", "deceased_name")


def _share(pages: DataFrame, parts: int, part: int) -> DataFrame:
    return pages.where(F.regexp_extract("site_id", "[0-9]+", 0).cast("bigint") % parts == part)


def _stream(spark, store: Store, pages: DataFrame, details: DataFrame, markets: DataFrame, progress: str) -> None:
    folder = f"{store.root}-pages-{uuid.uuid4().hex}"
    pages.select(*LISTING_PAGES.names).write.parquet(folder)
    ingest_stream(page_stream(spark, folder), store, lambda: details, markets, AS_OF, BASE_URL,
                  store.root + progress).awaitTermination()


@query
def stream_after_daily(spark, d):
    """Two daily batches, then a stream of all pages, then the same under a new checkpoint."""
    pages, details, markets = (stage(x, "run-input") for x in _run_inputs(spark, d))
    store = _fresh_store(spark, "mixed")
    for batch in (0, 1):
        run_day(store, _share(pages, 3, batch), details, markets, AS_OF, batch, BASE_URL)
    _stream(spark, store, pages, details, markets, "-first")
    _stream(spark, store, pages, details, markets, "-second")
    return _appended(store)


@query
def repeat_batch(spark, d):
    """The newest batch is run again; an older one is refused."""
    pages, details, markets = (stage(x, "run-input") for x in _run_inputs(spark, d))
    store = _fresh_store(spark, "repeat")
    run_day(store, _share(pages, 2, 0), details, markets, AS_OF, 0, BASE_URL)
    for _ in range(2):
        run_day(store, pages, details, markets, AS_OF, 1, BASE_URL)
    try:
        run_day(store, pages, details, markets, AS_OF, 0, BASE_URL)
    except ValueError:
        return _appended(store)
    raise AssertionError("an older batch was run")


class _Dying(Store):
    """A store whose run dies when the log is written: by then records and links of the attempt are there."""

    def append_log(self, log, batch):
        stuck = F.assert_true(F.col("obits_found") < 0, F.lit("the task is lost"))
        super().append_log(log.withColumn("errors", F.coalesce(stuck.cast("string"), F.col("errors"))), batch)


@query
def failed_repeat(spark, d):
    """A finished batch is run again with other pages, and the repeat dies half-way: the batch stays."""
    pages, details, markets = (stage(x, "run-input") for x in _run_inputs(spark, d))
    store = _fresh_store(spark, "failed")
    run_day(store, _share(pages, 2, 0), details, markets, AS_OF, 0, BASE_URL)
    run_day(store, pages, details, markets, AS_OF, 1, BASE_URL)
    try:
        run_day(_Dying(spark, store.root), _share(pages, 3, 1), details, markets, AS_OF, 1, BASE_URL)
    except PySparkException:
        return _appended(store)
    raise AssertionError("the repeat was to die")


def _three_days(spark, d, label: str, between: Callable[[Store], object] = lambda store: None) -> Store:
    """Records of three days, each stored and marked against what came before."""
    store, obits = _fresh_store(spark, label), _obits(spark, d)
    for batch in range(3):
        store.take(batch)
        store.append_records(obits.where(F.col("id") % 3 == batch), batch)
        mark(store, batch)
        store.complete(NUMBERED, batch, batch)
        between(store)
    return store


@query
def dedup_delta(spark, d):
    """Marks of three days, each from the table of people and the day alone."""
    return _three_days(spark, d, "delta").obits().select("id", "duplicate_of")


@query
def compacted_store(spark, d):
    """Three days with a compaction after each; the last one is not folded yet."""
    store = _three_days(spark, d, "folded", compact)
    vacuum(store)
    return store.obits().select(*OBITS.names)


@query
def report_state(spark, d):
    """Requests with a state over a store of a generation and a newer day; each reads the folders of its state."""
    store = _three_days(spark, d, "states", compact)
    requests = {"eu": {"state": "eu"}, "AM": {"state": " AM "}, "none": {"state": "zz"}, "any": {"city": "nation_1"},
                "both": {"state": "As", "funeral_home": "build%Home"}}
    out = None
    for name, args in requests.items():
        part = store.report(**args).select(F.lit(name).alias("request"), "id", "state")
        out = part if out is None else out.unionByName(part)
    return out


@query
def marked_count(spark, d):
    pages, details, markets = _run_inputs(spark, d)
    store = _fresh_store(spark, "marked")
    run_day(store, pages, details, markets, AS_OF, 0, BASE_URL)
    return count_marked(store, 0)


@query
def backfill_store(spark, d):
    """Records without some values are stored, filled and read back."""
    gaps = load(spark, d, "gaps")[0].select("id", F.col("site_id").alias("_site"), F.col("state").alias("_state"),
                                            F.col("county").alias("_county"))
    obits = _obits(spark, d).join(gaps, "id").withColumns(
        {"site_id": F.col("_site"), "state": F.col("_state"), "county": F.col("_county")}).select(*OBITS.names)
    store = _fresh_store(spark, "fill")
    store.load(obits, 0)
    run_backfill(store, 0)
    return store.obits().select("id", "birth_date", "death_date", "state", "county")


@query
def city_backfill_run(spark, d):
    """Stored records without cities, and listing pages that name them."""
    pages, _, markets = _run_inputs(spark, d)
    obits = _obits(spark, d)
    store = _fresh_store(spark, "city")
    store.load(obits.withColumn("city", F.when(F.col("id") % 2 == 0, "").when(F.col("id") % 5 == 0, None)
                                          .otherwise(F.col("city"))), 0)
    excluded = F.when(F.col("market_seq") % 4 == 0, F.concat(F.lit("il-"), "site_id")).otherwise(F.col("site_id"))
    run_city_backfill(store, 0, pages.withColumn("site_id", F.when(
        F.regexp_extract("site_id", "[0-9]+", 0).cast("int") % 4 == 0, F.concat(F.lit("il-"), "site_id"))
        .otherwise(F.col("site_id"))), markets.withColumn("site_id", excluded), BASE_URL)
    return store.obits().select("id", "city")


@query
def ingest_stream_(spark, d):
    pages, details, markets = _run_inputs(spark, d)
    store = _fresh_store(spark, "stream")
    folder = store.root + "-pages"
    pages.select(*LISTING_PAGES.names).write.parquet(folder)
    arriving = page_stream(spark, folder)
    fixed = stage(markets, "markets")
    found = stage(details, "details")
    ingest_stream(arriving, store, lambda: found, fixed, AS_OF, BASE_URL,
                  store.root + "-progress").awaitTermination()
    return store.obits().select("id", "site_id", "legacy_url", "deceased_name", "death_date",
                                "birth_date", "city", "duplicate_of")
