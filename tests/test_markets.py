"""Market dimension: inputs, build, merge, output."""

import json

import pytest

from noticeflow.plans.market_build import (
    build_markets, from_county_lines, market_totals, markets_by_state, merge_markets,
)
from noticeflow.sources.markets import (
    census_scan, county_lines, encode_markets, markets_scan, read_markets, write_markets,
)

CENSUS = """STATE|STATEFP|COUNTYNAME|CLASSFP
 TX |48| DeWitt County |H1
TX|48|Anderson County|H1
IL|17|De Witt County|H1
LA|22|St. Mary Parish|H4
NM|35|Doña Ana County|H1
AK|02|Juneau City and Borough|H6
NV|32|Carson City|C7
PR|72|Ponce Municipio|H1
VA|51|Bristol city|C7
"""


@pytest.fixture(scope="module")
def markets(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("census") / "counties.txt"
    path.write_text(CENSUS, encoding="utf-8")
    return build_markets(census_scan(spark, str(path)))


def test_build(markets):
    got = [(r.market_seq, r.site_id, r.state, r.legacy_slug, r.type, r.county)
           for r in markets.orderBy("market_seq").collect()]
    assert got == [
        (0, "ak-juneau-city-and", "alaska", "juneau-city-and-county", "county", "Juneau City and"),
        (1, "il-de-witt", "illinois", "de-witt-county", "county", "De Witt"),
        (2, "la-saint-mary", "louisiana", "saint-mary-county", "county", "St. Mary"),
        (3, "nm-do-a-ana", "new-mexico", "do-a-ana-county", "county", "Doña Ana"),
        (4, "tx-anderson", "texas", "anderson-county", "county", "Anderson"),
        (5, "tx-dewitt", "texas", "dewitt-county", "county", "DeWitt")]
    assert [(r.state, r.markets) for r in markets_by_state(markets).collect()][-1] == ("texas", 2)
    assert market_totals(markets).first().asDict() == {"markets": 6, "states": 5}


def test_config_array_keeps_its_order(spark, tmp_path):
    items = [{"site_id": f"s{i}", "state": "ohio", "legacy_slug": f"x{i}", "type": "city"} for i in (3, 1, 2)]
    items.append({"site_id": "s9", "county": "Ünïon", "extra": [1]})
    path = tmp_path / "markets.json"
    path.write_text(json.dumps(items, indent=2), encoding="utf-8")
    got = [(r.market_seq, r.site_id, r.county, r.state) for r in markets_scan(spark, str(path)).collect()]
    assert got == [(0, "s3", None, "ohio"), (1, "s1", None, "ohio"), (2, "s2", None, "ohio"),
                   (3, "s9", "Ünïon", None)]


def test_output_and_ascii_escapes(markets, spark, tmp_path):
    write_markets(markets, str(tmp_path / "m"))
    assert sorted(map(tuple, read_markets(spark, str(tmp_path / "m")).collect())) == sorted(
        map(tuple, markets.collect()))
    rows = [(0, "s", "ohio", "x", "city", 'Doña "Ana" 😀\\')]
    df = spark.createDataFrame(rows, markets.schema)
    for ascii_only in (False, True):
        text = encode_markets(df, ascii_only).first().value
        want = dict(zip(["site_id", "state", "legacy_slug", "type", "county"], rows[0][1:]))
        assert text == json.dumps(want, ensure_ascii=ascii_only, separators=(",", ":"))


def test_county_lines_and_merge(spark):
    lines = spark.createDataFrame(
        [(0, "TX", "texas", "Brown\tbrown-county"), (1, "TX", "texas", "bad line"), (2, "TX", "texas", "A\tb\tc"),
         (3, "TX", "texas", "Ellis\tellis-county"), (4, "TX", "texas", "Other\tellis-county"), (5, "TX", "texas", "")],
        "seq int, abbrev string, state string, value string")
    parsed = county_lines(lines)
    assert [(r.name, r.slug) for r in parsed.orderBy("seq").collect()] == [
        ("Brown", "brown-county"), ("Ellis", "ellis-county"), ("Other", "ellis-county")]
    existing = spark.createDataFrame(
        [(0, "oh-x", "ohio", "x", "city", None), (1, "tx-brown", "texas", "brown-county", "county", "Old")],
        "market_seq int, site_id string, state string, legacy_slug string, type string, county string")
    got = [(r.market_seq, r.site_id, r.county) for r in
           merge_markets(existing, from_county_lines(parsed)).orderBy("market_seq").collect()]
    assert got == [(0, "oh-x", None), (1, "tx-brown", "Old"), (2, "tx-ellis", "Ellis")]
