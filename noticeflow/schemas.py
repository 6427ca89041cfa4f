"""Table layouts. Column names, order and widths are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B, TS = (
    T.StringType(), T.DateType(), T.LongType(), T.IntegerType(), T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


OBITS = _struct(
    ("id", L), ("site_id", S), ("legacy_url", S), ("deceased_name", S), ("first_name", S),
    ("middle_name", S), ("last_name", S), ("name_suffix", S), ("published_date", D),
    ("death_date", D), ("birth_date", D), ("funeral_home", S), ("city", S), ("state", S),
    ("county", S), ("obit_text", S), ("scraped_at", TS), ("sent_to_cms", B),
    ("duplicate_of", L),
)

# Text column widths; longer values are cut on insert.
WIDTHS = {
    "site_id": 50, "legacy_url": 500, "deceased_name": 255, "first_name": 100,
    "middle_name": 100, "last_name": 100, "name_suffix": 20, "funeral_home": 255,
    "city": 100, "state": 2, "county": 100,
}

RUN_LOG = _struct(
    ("site_id", S), ("run_date", D), ("obits_found", I), ("obits_new", I), ("errors", S),
    ("run_at", TS),
)

MARKET = _struct(
    ("site_id", S), ("state", S), ("legacy_slug", S), ("type", S), ("county", S),
)
MARKET_ROW = _struct(("market_seq", I), *[(f.name, f.dataType) for f in MARKET])

CENSUS = _struct(("STATE", S), ("COUNTYNAME", S), ("CLASSFP", S))

LISTING_PAGES = _struct(("run_date", D), ("site_id", S), ("url", S), ("html", S))
DETAIL_PAGES = _struct(("url", S), ("html", S))

# Fields of one extracted record.
RECORD_FIELDS = [
    "url", "deceased_name", "first_name", "middle_name", "last_name", "name_suffix",
    "obit_text", "published_date", "death_date", "birth_date", "funeral_home", "city",
    "state",
]

# Columns the de-duplicated view exposes, and those of the report.
VIEW_COLUMNS = [
    "id", "first_name", "middle_name", "last_name", "name_suffix", "city", "county",
    "state", "legacy_url", "death_date", "birth_date", "published_date", "scraped_at",
    "funeral_home", "deceased_name", "obit_text",
]
REPORT_COLUMNS = [
    "deceased_name", "first_name", "last_name", "birth_date", "death_date",
    "published_date", "funeral_home", "city", "county", "state", "legacy_url", "site_id",
]

# Decoding schemas of the two embedded payload layouts.
LISTING_ITEM = _struct(
    ("name", _struct(("firstName", S), ("middleName", S), ("lastName", S), ("suffix", S),
                     ("fullName", S))),
    ("funeralHome", _struct(("name", S))),
    ("obitSnippet", S),
    ("links", _struct(("obituaryUrl", _struct(("href", S))))),
    ("datePostedFrom", S),
    ("publisherName", S),
    ("location", _struct(("city", _struct(("fullName", S))),
                         ("state", _struct(("code", S))))),
)
ITEM_LIST = _struct(("obituaries", T.ArrayType(LISTING_ITEM)))
LISTING_PAYLOAD = _struct(("obituaryList", ITEM_LIST))

STATE_EDGE = _struct(
    ("node", _struct(
        ("name", _struct(("firstName", S), ("lastName", S))),
        ("links", _struct(("obituaryUrl", _struct(("path", S))))),
        ("obituaryNoHtml", S), ("publishedDate", S), ("deathDate", S),
        ("funeralHomeName", S),
    )),
)
EDGES = T.ArrayType(STATE_EDGE)
STATE_PAYLOAD = _struct(
    ("BrowseStore", _struct(("data", _struct(("obituaries", _struct(
        ("obituaries", _struct(("edges", EDGES))))))))),
    ("obituaries", _struct(("edges", EDGES))),
)
