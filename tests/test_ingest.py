"""Insert and run log against a plain loop over sources in order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticeflow.operators.ingest import (
    as_records, insert_ignore, link_counts, new_links, run_log, run_totals, with_market,
)
from noticeflow.schemas import OBITS, RECORD_FIELDS, RUN_LOG

AS_OF = dt.datetime(2026, 3, 4, 11, 0, 7, 999)
FIELDS = {f: "string" for f in RECORD_FIELDS} | {
    f: "date" for f in ("published_date", "death_date", "birth_date")}
SCHEMA = "site_id string, market_seq bigint, pos int, county string, " + ", ".join(
    f"{n} {t}" for n, t in FIELDS.items())


def candidate(site, seq, pos, url, **kw):
    values = {f: None for f in RECORD_FIELDS} | {"url": url} | kw
    return (site, seq, pos, kw.get("county", ""), *[values[f] for f in RECORD_FIELDS])


def stored_table(spark, urls):
    df = spark.createDataFrame([(i + 1, u) for i, u in enumerate(urls)], "id bigint, legacy_url string")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in OBITS])


def plain_run(rows, stored):
    """Sources in order; per record the stored check, then the insert."""
    keys = {u[:500].lower() for u in stored}
    found, new, inserted = {}, {}, []
    by_source = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by_source.setdefault((r[1], r[0]), []).append(r)
    for (_, site), page in by_source.items():
        due = [r for r in page if r[4] and r[4].lower() not in keys]
        found[site] = len(due)
        new[site] = 0
        for r in due:
            if r[4][:500].lower() not in keys:
                keys.add(r[4][:500].lower())
                new[site] += 1
                inserted.append((site, r[4][:500]))
    return found, new, inserted


def random_run(seed):
    rng = random.Random(seed)
    long = "https://x/" + "l" * 495
    urls = ["", None, "https://x/hot", *[f"https://x/{i}" for i in range(40)], long, long + "a", long + "B"]
    rows = []
    for seq in range(12):
        for pos in range(rng.randint(0, 40)):
            url = "https://x/hot" if rng.random() < .35 else rng.choice(urls)
            rows.append(candidate(f"s{seq}", seq, pos, url.upper() if url and rng.random() < .2 else url))
    return rows, [f"https://X/{i}" for i in range(0, 40, 3)]


@pytest.mark.parametrize("seed", range(4))
def test_random_runs(spark, seed):
    rows, stored_urls = random_run(seed)
    found, new, inserted = plain_run(rows, stored_urls)
    df, stored = spark.createDataFrame(rows, SCHEMA), stored_table(spark, stored_urls)
    got = {r.site_id: (r.found, r.new) for r in link_counts(df, stored).collect()}
    assert {s: v for s, v in got.items() if v != (0, 0)} == {
        s: (found[s], new[s]) for s in found if (found[s], new[s]) != (0, 0)}
    records = insert_ignore(df, stored, AS_OF).orderBy("id").collect()
    assert [(r.site_id, r.legacy_url) for r in records] == inserted
    first = len(stored_urls) + 1
    assert [r.id for r in records] == list(range(first, first + len(inserted)))


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_new_links(spark, hot_rows):
    rows, stored_urls = random_run(9)
    keys = {u[:500].lower() for u in stored_urls}
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.site_id, r.pos, r.url) for r in
                 new_links(df, stored_table(spark, stored_urls), hot_rows=hot_rows).collect())
    assert got == sorted((r[0], r[2], r[4]) for r in rows if r[4] and r[4].lower() not in keys)


def test_stored_form(spark):
    rows = [candidate("s", 0, 0, "https://x/1", deceased_name="n" * 300, state="OHIO", name_suffix="j" * 30,
                      death_date=dt.date(2026, 3, 1), funeral_home="", obit_text="t" * 9000),
            candidate(None, 0, 1, "https://x/2")]
    got = as_records(spark.createDataFrame(rows, SCHEMA), AS_OF).orderBy("pos").collect()
    full, bare = got
    assert (len(full.deceased_name), full.state, len(full.name_suffix), len(full.obit_text)) == (255, "OH", 20, 9000)
    assert (full.death_date, full.birth_date, full.funeral_home) == (dt.date(2026, 3, 1), None, "")
    assert full.scraped_at == dt.datetime(2026, 3, 4, 11, 0, 7) and full.sent_to_cms is False
    assert (bare.site_id, bare.deceased_name, bare.city, bare.funeral_home, bare.published_date) == (
        "unknown", "", "", None, None)


def test_run_log_lists_every_source(spark):
    rows = [candidate("a", 0, 0, "u1"), candidate("b", 1, 0, "u1"), candidate("b", 1, 1, "u2"),
            candidate("c", 2, 0, "u3")]
    markets = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "quiet"), (4, "broken")], "market_seq int, site_id string")
    errors = spark.createDataFrame([(4, "TypeError: x"), (2, "ValueError: y")], "market_no int, error string")
    log = run_log(markets, spark.createDataFrame(rows, SCHEMA), stored_table(spark, []), errors, AS_OF)
    assert log.schema.names == RUN_LOG.names
    got = {r.site_id: (r.obits_found, r.obits_new, r.errors) for r in log.collect()}
    assert got == {"a": (1, 1, None), "b": (1, 1, None), "c": (0, 0, "ValueError: y"),
                   "quiet": (0, 0, None), "broken": (0, 0, "TypeError: x")}
    assert {(r.run_date, r.run_at) for r in log.collect()} == {
        (AS_OF.date(), dt.datetime(2026, 3, 4, 11, 0, 7))}
    total = run_totals(log).first()
    assert (total.markets, total.total_found, total.total_new) == (5, 2, 2)


def test_market_county(spark):
    df = spark.createDataFrame([candidate("a", 0, 0, "u")], SCHEMA).drop("county")
    markets = spark.createDataFrame([(0, "a", None), (1, "b", "B"), (2, "a", "Again")], "market_seq int, site_id string, county string")
    assert [(r.site_id, r.county) for r in with_market(df, markets).collect()] == [("a", "")]


def test_repeated_site(spark):
    """Each place of a repeated source has its own counts, and a link is stored once."""
    rows = [candidate("a", 0, 0, "u1"), candidate("a", 2, 0, "u1"), candidate("a", 2, 1, "u2"), candidate("b", 1, 0, "u1")]
    markets = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "market_seq int, site_id string")
    errors = spark.createDataFrame([], "market_no int, error string")
    df = spark.createDataFrame(rows, SCHEMA)
    log = run_log(markets, df, stored_table(spark, []), errors, AS_OF).collect()
    assert sorted((r.site_id, r.obits_found, r.obits_new) for r in log) == [("a", 1, 1), ("a", 1, 1), ("b", 0, 0)]
    assert [r.legacy_url for r in insert_ignore(df, stored_table(spark, []), AS_OF).orderBy("id").collect()] == ["u1", "u2"]


def test_equal_places_have_a_fixed_winner(spark):
    rows = [candidate("a", 0, 0, "u1", deceased_name=f"n{i}") for i in range(20)]
    pick = lambda r: insert_ignore(spark.createDataFrame(r, SCHEMA).repartition(5), stored_table(spark, []), AS_OF).first().deceased_name
    assert pick(rows) == pick(rows[::-1])
