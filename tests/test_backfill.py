"""Backfills of dates, states, counties and cities."""

import datetime as dt

from noticeflow.operators import backfill

DAY, BORN = dt.date(2017, 9, 23), dt.date(1951, 4, 18)
TEXT = f"He died {DAY:%B %-d, %Y}. Born {BORN:%B %-d, %Y}."


def test_dates_fill_independently(spark):
    other = dt.date(1999, 9, 9)
    rows = [(1, TEXT, None, None), (2, TEXT, other, None), (3, TEXT, None, other), (4, TEXT, other, other),
            (5, "", None, None), (6, None, None, None), (7, "no dates", None, None)]
    df = spark.createDataFrame(rows, "id int, obit_text string, death_date date, birth_date date")
    got = {r.id: (r.death_date, r.birth_date) for r in backfill.fill_dates(df).collect()}
    assert got == {1: (DAY, BORN), 2: (other, BORN), 3: (DAY, other), 4: (other, other),
                   5: (None, None), 6: (None, None), 7: (None, None)}
    n = backfill.date_counts(df).first()
    assert (n.rows_processed, n.birth_dates_updated, n.death_dates_updated) == (4, 2, 2)
    assert "Exchange" not in backfill.fill_dates(df)._jdf.queryExecution().executedPlan().toString()


def test_state_and_county(spark):
    rows = [(1, "tx-brown", None, None), (2, "OH-Hilliard", None, ""), (3, "ma-holden", "", None),
            (4, "il-cook", None, None), (5, "txbrown", None, None), (6, "ga-claxton", "XX", "Y")]
    df = spark.createDataFrame(rows, "id int, site_id string, state string, county string")
    state = {r.id: r.state for r in backfill.fill_state(df).collect()}
    assert state == {1: "TX", 2: "OH", 3: "", 4: None, 5: None, 6: "XX"}
    county = {r.id: r.county for r in backfill.fill_county(df).collect()}
    assert county == {1: "Brown", 2: "", 3: "Worcester", 4: None, 5: None, 6: "Y"}


def test_city_first_value_wins(spark):
    obits = spark.createDataFrame(
        [(1, "https://x/A", None), (2, "https://x/b", ""), (3, "https://x/c", "Kept"), (4, "https://x/d", "")],
        "id int, legacy_url string, city string")
    cand = spark.createDataFrame(
        [("s2", 2, 0, "https://x/a", "Late"), ("s1", 1, 5, "https://X/a", "First"), ("s1", 1, 2, "https://x/a", ""),
         ("s1", 1, 9, "https://x/a", "Second"), ("s2", 2, 1, "https://x/b", "B"), ("s2", 2, 2, "https://x/c", "C"),
         ("s1", 1, 0, "", "Nowhere")],
        "site_id string, market_seq int, pos int, url string, city string")
    got = {r.id: r.city for r in backfill.fill_city(obits, cand).collect()}
    assert got == {1: "First", 2: "B", 3: "Kept", 4: ""}
    counts = {r.site_id: r.updated for r in backfill.city_counts(obits, cand).collect()}
    assert counts == {"s1": 1, "s2": 1}


def test_original_sources(spark):
    df = spark.createDataFrame([("il-cook",), ("tx-brown",), ("ilx",)], "site_id string")
    assert sorted(r[0] for r in backfill.original_sources(df).collect()) == ["ilx", "tx-brown"]
