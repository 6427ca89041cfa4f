"""Daily runs and the page stream over a store."""

import datetime as dt

import pytest

from noticeflow import session
from noticeflow.plans.daily import ingest, marked_count, run_day, run_epoch
from noticeflow.plans.store import Store
from noticeflow.schemas import DETAIL_PAGES, LISTING_PAGES, MARKET_ROW
from noticeflow.streaming import page_stream as page_stream_module
from noticeflow.streaming.page_stream import ingest_stream, page_stream

from .samples import BASE, detail_sample, listing

DETAIL, FIELDS = detail_sample(1)

DAY1, DAY2 = dt.datetime(2026, 3, 4, 11), dt.datetime(2026, 3, 5, 11)


def item(name, link, text="some text", city="Dayton"):
    first, last = name.split()
    return {"personId": 1, "name": {"firstName": first, "lastName": last}, "obitSnippet": text,
            "links": {"obituaryUrl": {"href": link}}, "location": {"city": {"fullName": city}, "state": {"code": "OH"}},
            "pad": "x" * 100}


def pages(spark, day, **sites):
    return spark.createDataFrame([(day.date(), s, BASE, h) for s, h in sites.items()], LISTING_PAGES)


@pytest.fixture(scope="module")
def markets(spark):
    return spark.createDataFrame(
        [(0, "a", "ohio", "a-county", "county", "Alpha"), (1, "b", "ohio", "b-county", "county", None),
         (2, "c", "ohio", "c-county", "county", "C"), (3, "bad", "", "x", "county", "X"),
         (4, "silent", "ohio", "s", "city", "S")], MARKET_ROW)


@pytest.fixture(scope="module")
def details(spark):
    return spark.createDataFrame([(BASE + "/thin", DETAIL)], DETAIL_PAGES)


FIRST = dict(a=listing([item("Ann Lee", "/1", "Ann died May 1, 2020"), item("Bo Kay", "/thin", "")]),
             b=listing([item("Ann Lee", "/1"), item("ANN Lee", "/2", "longer text of the same person")]),
             c=listing(["broken", {"pad": "x" * 100}]),
             bad=listing([item("Not Read", "/9")]))
SECOND = dict(a=listing([item("Ann Lee", "/1"), item("Ann Lee", "/3", "died May 2, 2020")]),
              b=listing([item("New Person", "/4")]))


def by_url(store):
    return {r.legacy_url.removeprefix(BASE): r for r in store.obits().collect()}


def test_two_days(spark, markets, details, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    log = run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    counts = {r.site_id: (r.obits_found, r.obits_new) for r in log.collect()}
    assert counts == {"a": (2, 2), "b": (1, 1), "c": (0, 0), "bad": (0, 0), "silent": (0, 0)}
    failed = {r.site_id for r in log.collect() if r.errors}
    assert failed == {"c", "bad"}
    got = by_url(store)
    assert [(u, got[u].id, got[u].site_id, got[u].county) for u in ("/1", "/thin", "/2")] == [
        ("/1", 1, "a", "Alpha"), ("/thin", 2, "a", "Alpha"), ("/2", 3, "b", "")]
    assert got["/thin"].deceased_name == FIELDS["name"] and got["/thin"].city == "Dayton"
    assert (got["/1"].death_date, got["/1"].duplicate_of, got["/2"].duplicate_of) == (dt.date(2020, 5, 1), None, 1)

    # Running the batch again changes nothing.
    again = run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    assert {r.site_id: (r.obits_found, r.obits_new) for r in again.collect()} == counts
    assert {u: (r.id, r.duplicate_of) for u, r in by_url(store).items()} == {
        u: (r.id, r.duplicate_of) for u, r in got.items()}

    log = run_day(store, pages(spark, DAY2, **SECOND), details, markets, DAY2, 1, BASE)
    assert {r.site_id: (r.obits_found, r.obits_new) for r in log.collect() if r.obits_found} == {
        "a": (1, 1), "b": (1, 1)}
    got = by_url(store)
    assert (got["/3"].id, got["/4"].id) == (4, 5)
    # The longer of the two dated rows is kept as primary; earlier marks stay.
    assert {u: r.duplicate_of for u, r in got.items() if r.duplicate_of} == {"/2": 1, "/3": 1}
    assert store.log().count() == 10
    assert marked_count(store, 1).first().marked == 1
    # An older batch is refused, and nothing has changed.
    with pytest.raises(ValueError):
        run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    assert {u: (r.id, r.duplicate_of) for u, r in by_url(store).items()} == {u: (r.id, r.duplicate_of) for u, r in got.items()}


def test_staged_tables_go_with_the_run(spark, markets, details, tmp_path, monkeypatch):
    folder = tmp_path / "staging"
    monkeypatch.setattr(session, "staging_root", lambda _: str(folder))
    store = Store(spark, str(tmp_path / "store"))
    run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    assert folder.exists() and list(folder.iterdir()) == []
    assert store.obits().count() == 3 and store.log().count() == 5


def test_stream_equals_batches(spark, markets, details, tmp_path):
    folder = str(tmp_path / "arriving")
    pages(spark, DAY1, **FIRST).coalesce(1).write.parquet(folder)
    store = Store(spark, str(tmp_path / "store"))

    def run():
        ingest_stream(page_stream(spark, folder, 1), store, lambda: details, markets, DAY1, BASE,
                      str(tmp_path / "progress")).awaitTermination()
        return by_url(store)

    first = run()
    assert sorted(first) == ["/1", "/2", "/thin"]
    assert {r.site_id for r in store.log().collect()} == {"a", "b", "c", "bad"}
    pages(spark, DAY2, **SECOND).coalesce(1).write.mode("append").parquet(folder)
    second = run()
    assert sorted(second) == ["/1", "/2", "/3", "/4", "/thin"]
    assert {u: r.id for u, r in second.items() if u in first} == {u: r.id for u, r in first.items()}
    assert run().keys() == second.keys()


def test_stream_writes_a_micro_batch_s_sources_once(spark, markets, details, tmp_path, monkeypatch):
    """The log and the listings use them several times; each use would read all pages again."""
    given = []

    def spy(store, df, details, seen, *args):
        given.append((sorted(r.site_id for r in seen.collect()), seen.inputFiles()))
        return run_epoch(store, df, details, seen, *args)

    monkeypatch.setattr(page_stream_module, "run_epoch", spy)
    folder = str(tmp_path / "arriving")
    pages(spark, DAY1, **FIRST).coalesce(1).write.parquet(folder)
    store = Store(spark, str(tmp_path / "store"))
    ingest_stream(page_stream(spark, folder), store, lambda: details, markets, DAY1, BASE, str(tmp_path / "progress")).awaitTermination()
    assert len(given) == 1 and given[0][0] == ["a", "b", "bad", "c"]
    assert given[0][1] and all("/noticeflow-sources-" in f for f in given[0][1])
    assert sorted(by_url(store)) == ["/1", "/2", "/thin"]


def test_pages_of_two_days_in_one_run(spark, markets, details, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    both = pages(spark, DAY2, a=listing([item("Late Name", "/1")])).unionByName(
        pages(spark, DAY1, b=listing([item("Early Name", "/1")])))
    run_day(store, both, details, markets, DAY2, 0, BASE)
    assert [(r.site_id, r.deceased_name) for r in store.obits().collect()] == [("b", "Early Name")]


def sound(store):
    """Each link and id once, one row per record however often marks were written."""
    rows = store.obits().collect()
    assert len({r.legacy_url for r in rows}) == len({r.id for r in rows}) == len(rows)
    return {r.legacy_url.removeprefix(BASE) for r in rows}


def test_stream_on_a_store_with_batches_and_a_new_checkpoint(spark, markets, details, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run_day(store, pages(spark, DAY1, a=listing([item("Ann Lee", "/1")])), details, markets, DAY1, 0, BASE)
    run_day(store, pages(spark, DAY2, c=listing([item("Cy Fox", "/c")])), details, markets, DAY2, 1, BASE)
    kept = by_url(store)

    def stream(folder, progress):
        ingest_stream(page_stream(spark, folder, 1), store, lambda: details, markets, DAY2, BASE,
                      str(tmp_path / progress)).awaitTermination()

    folder = str(tmp_path / "arriving")
    pages(spark, DAY2, b=listing([item("Cy Fox", "/c"), item("New Person", "/2")])).coalesce(1).write.parquet(folder)
    stream(folder, "first")
    assert sound(store) == {"/1", "/c", "/2"}
    assert {u: r.id for u, r in by_url(store).items() if u in kept} == {u: r.id for u, r in kept.items()}
    # A new checkpoint starts at its own epoch 0 and reads the same page again.
    stream(folder, "second")
    assert sound(store) == {"/1", "/c", "/2"}
    run_day(store, pages(spark, DAY2, a=listing([item("More Folk", "/9")])), details, markets, DAY2, store.newest() + 1, BASE)
    assert sound(store) == {"/1", "/c", "/2", "/9"}
    with pytest.raises(ValueError):
        run_day(store, pages(spark, DAY2), details, markets, DAY2, 2, BASE)


def test_an_unfinished_batch_is_not_seen_and_its_epoch_starts_anew(spark, markets, details, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    page = pages(spark, DAY1, a=listing([item("Ann Lee", "/1")]))
    batch, done = store.claim("feed", 0)
    assert (batch, done) == (0, False)
    ingest(store, page, details, markets, DAY1, batch, BASE)  # and no more: the driver is lost
    assert store.obits().count() == store.log().count() == 0
    run_day(store, pages(spark, DAY1, b=listing([item("Ann Lee", "/1"), item("Bo Kay", "/2")])), details, markets, DAY1, 1, BASE)
    assert run_epoch(store, page, details, markets, DAY1, "feed", 0, BASE) == 2
    assert sound(store) == {"/1", "/2"}
    assert run_epoch(store, page, details, markets, DAY1, "feed", 0, BASE) == 2
    assert sound(store) == {"/1", "/2"}
    assert run_epoch(store, page, details, markets, DAY1, "other", 0, BASE) == 3
    assert sound(store) == {"/1", "/2"}


def test_repeated_site(spark, details, tmp_path):
    markets = spark.createDataFrame(
        [(0, "a", "ohio", "a-county", "county", "Alpha"), (1, "a", "utah", "a", "county", "Other")], MARKET_ROW)
    store = Store(spark, str(tmp_path / "store"))
    log = run_day(store, pages(spark, DAY1, a=listing([item("Ann Lee", "/1")])), details, markets, DAY1, 0, BASE)
    assert sorted((r.obits_found, r.obits_new) for r in log.collect()) == [(0, 0), (1, 1)]
    assert [(r.id, r.county) for r in store.obits().collect()] == [(1, "Alpha")]
