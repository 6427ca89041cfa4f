"""Test inputs derived from the driver tables.

Every relation is one SQL text that both engines run, so the oracle never sees data that
Spark produced. Only date formatting differs between the dialects. All of them cover the
whole tables.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeflow.session import spread

BASE_URL = "https://site.example"
AS_OF = dt.datetime(2001, 8, 2, 6, 30, 15)
#: Records dated before this day count as stored by earlier runs.
STORED_UNTIL = "1998-01-01"
PAGE_SPAN = 50


def _date_text(engine: str, d: str) -> tuple[str, str]:
    """Long and numeric spelling of a date expression."""
    if engine == "spark":
        return f"date_format({d}, 'MMMM d, yyyy')", f"date_format({d}, 'M/d/yyyy')"
    return f"strftime({d}, '%B %-d, %Y')", f"strftime({d}, '%-m/%-d/%Y')"


def obits_sql(engine: str) -> str:
    day = "cast(o_orderdate as date)"
    born = f"({day} - 20000)"
    long_d, num_d = _date_text(engine, day)
    long_b, num_b = _date_text(engine, born)
    return f"""
SELECT o_orderkey AS id,
  lower(substr(r_name, 1, 2)) || '-county-' || cast(o_custkey % 50 AS string) AS site_id,
  '{BASE_URL}/us/obituaries/name/c' || cast(o_custkey AS string) || '-obituary?id='
    || cast(o_orderkey AS string) AS legacy_url,
  CASE WHEN o_orderkey % 17 = 0 THEN ''
    ELSE CASE o_orderkey % 5 WHEN 0 THEN 'Joe' WHEN 1 THEN 'JOE' WHEN 2 THEN 'joe'
         WHEN 3 THEN 'Mary' ELSE '' END || ' Customer' || cast(o_custkey % 200 AS string)
    END AS deceased_name,
  CASE o_orderkey % 5 WHEN 0 THEN 'Joe' WHEN 1 THEN 'JOE' WHEN 2 THEN 'joe' WHEN 3 THEN 'Mary'
    ELSE '' END AS first_name,
  CASE WHEN o_orderstatus = 'P' THEN 'Middle' ELSE '' END AS middle_name,
  'Customer' || cast(o_custkey % 200 AS string) AS last_name,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Jr.' ELSE '' END AS name_suffix,
  {day} AS published_date,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {day} END AS death_date,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {born} END AS birth_date,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE c_mktsegment || ' Funeral Home' END AS funeral_home,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN '' ELSE n_name END AS city,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE upper(substr(r_name, 1, 2)) END AS state,
  'County ' || cast(o_custkey % 50 AS string) AS county,
  'X Y ' || CASE o_orderkey % 14
    WHEN 0 THEN 'passed away peacefully on ' || {long_d}
    WHEN 1 THEN 'passed quietly on ' || {long_d}
    WHEN 2 THEN 'passed on to some calm shore on ' || {long_d}
    WHEN 3 THEN 'passed from our street at noon on ' || {long_d}
    WHEN 4 THEN 'went home to be with old friends on ' || {long_d}
    WHEN 5 THEN 'entered eternal rest on ' || {long_d}
    WHEN 6 THEN 'died ' || {long_d}
    WHEN 7 THEN 'met death on ' || {long_d}
    WHEN 8 THEN '1930 - ' || {long_d}
    WHEN 9 THEN 'passed away ' || {num_d}
    WHEN 10 THEN 'died on ' || {num_d}
    WHEN 11 THEN 'died February 30, 1999, death on ' || {long_d}
    WHEN 12 THEN 'no dates here'
    ELSE 'died Sept. 4th 1998' END
  || '. ' || CASE o_orderkey % 3
    WHEN 0 THEN 'She was born to A and B on ' || {long_b} || '.'
    WHEN 1 THEN 'Born on ' || {long_b} || '.'
    ELSE 'born ' || {num_b} || '.' END AS obit_text,
  o_orderdate AS scraped_at,
  false AS sent_to_cms,
  cast(NULL AS bigint) AS duplicate_of,
  o_custkey % 50 * 5 + r_regionkey AS market_seq,
  o_orderstatus AS status, o_orderpriority AS priority
FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


# Records with gaps: state and county unknown for some sources, as before the upgrade.
GAPS_SQL = """
SELECT id, CASE substr(site_id, 1, 2) WHEN 'af' THEN 'tx-' WHEN 'am' THEN 'OH-'
    WHEN 'as' THEN 'ma-' WHEN 'eu' THEN 'ga-' ELSE 'il-' END
  || CASE WHEN market_seq % 10 = 0 THEN 'brown' WHEN market_seq % 10 = 1 THEN 'Hilliard'
     WHEN market_seq % 10 = 2 THEN 'holden' WHEN market_seq % 10 = 3 THEN 'claxton'
     ELSE 'place' END AS site_id,
  CASE WHEN status = 'F' THEN NULL ELSE state END AS state,
  CASE WHEN priority = '5-LOW' THEN NULL WHEN priority = '2-HIGH' THEN '' ELSE county END AS county
FROM obits"""

STORED_SQL = f"SELECT * FROM obits WHERE scraped_at < timestamp '{STORED_UNTIL} 00:00:00'"

SITES_SQL = """
SELECT site_id, min(market_seq) AS market_seq, min(county) AS county FROM obits GROUP BY site_id"""

# Listing rows of a run: each record on its own source's page; some also on the next
# source's page, some repeated in other letter case, some without a link.
CANDIDATES_SQL = """
SELECT s.site_id, l.market_seq, l.pos, l.url, l.deceased_name, l.first_name, l.middle_name,
  l.last_name, l.name_suffix, l.obit_text, l.published_date, l.death_date, l.birth_date,
  l.funeral_home, l.city, l.state, s.county
FROM (
  SELECT market_seq, id * 2 AS pos, CASE WHEN priority = '3-MEDIUM' THEN '' ELSE legacy_url END
    AS url, deceased_name, first_name, middle_name, last_name, name_suffix, obit_text,
    published_date, death_date, birth_date, funeral_home, city, state FROM obits
  UNION ALL
  SELECT (market_seq + 1) % 250, id * 2, legacy_url, deceased_name, first_name, middle_name,
    last_name, name_suffix, obit_text, published_date, death_date, birth_date, funeral_home,
    city, state FROM obits WHERE status = 'P'
  UNION ALL
  SELECT market_seq, id * 2 + 1, upper(legacy_url), deceased_name, first_name, middle_name,
    last_name, name_suffix, obit_text, published_date, death_date, birth_date, funeral_home,
    city, state FROM obits WHERE priority = '2-HIGH'
) l JOIN sites s ON l.market_seq = s.market_seq"""

# A county file: all kinds of names, classes and codes, one row per customer.
CENSUS_SQL = """
SELECT CASE c_custkey % 52 {states} END AS STATE,
  CASE c_custkey % 13 WHEN 0 THEN 'De Witt County' WHEN 1 THEN 'DeWitt County'
    WHEN 2 THEN 'St. Mary' || cast(c_custkey AS string) || ' Parish'
    WHEN 3 THEN 'O''Brien' || cast(c_custkey AS string) || ' County'
    WHEN 4 THEN 'Juneau' || cast(c_custkey AS string) || ' City and Borough'
    WHEN 5 THEN 'Carson' || cast(c_custkey AS string) || ' City'
    WHEN 6 THEN 'Do' || chr(241) || 'a Ana' || cast(c_custkey AS string) || ' County'
    WHEN 7 THEN 'Yukon' || cast(c_custkey AS string) || ' Census Area'
    WHEN 8 THEN 'Bristol' || cast(c_custkey AS string) || ' city'
    WHEN 9 THEN 'Prince George''s ' || cast(c_custkey AS string)
    WHEN 10 THEN 'Nome' || cast(c_custkey AS string) || ' Municipality'
    WHEN 11 THEN 'A.-B.  C_' || cast(c_custkey AS string) || ' Borough'
    ELSE 'Ponce' || cast(c_custkey AS string) || ' Municipio' END AS COUNTYNAME,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'H4' WHEN 'BUILDING' THEN 'H5'
    WHEN 'FURNITURE' THEN 'H6' WHEN 'MACHINERY' THEN 'C7' ELSE 'H1' END AS CLASSFP
FROM customer"""

# County lines: name and slug separated by a tab; machinery customers' lines are malformed.
LINES_SQL = """
SELECT c_custkey AS seq, upper(substr(n_name, 1, 1)) || chr(65 + c_nationkey) AS abbrev,
  lower(n_name) AS state,
  'Place ' || cast(c_custkey % 700 AS string) || chr(9) || 'place-'
    || cast(c_custkey % 700 AS string) || '-county'
    || CASE WHEN c_mktsegment = 'MACHINERY' THEN chr(9) || 'extra' ELSE '' END AS line
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def census_sql() -> str:
    from noticeflow.functions.places import STATE_SLUGS

    codes = [*STATE_SLUGS, "PR", "DC"]
    return CENSUS_SQL.format(
        states=" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(codes)))


def relations(engine: str) -> dict[str, str]:
    """Named relations; later ones may use earlier ones."""
    return {
        "obits": obits_sql(engine), "gaps": GAPS_SQL, "stored": STORED_SQL,
        "sites": SITES_SQL, "candidates": CANDIDATES_SQL, "census": census_sql(),
        "lines": LINES_SQL,
    }


def with_relations(query: str, *names: str) -> str:
    """Oracle text: the named relations as common table expressions before ``query``."""
    rel = relations("duck")
    body = ",\n".join(f"{n} AS ({rel[n]})" for n in rel if n in names)
    return f"WITH {body}\n{query}"


# Columns used of the driver tables: declared, so that no query starts with a footer scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
}


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named driver tables or relations as DataFrames."""
    rel = relations("spark")
    done: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in done:
            if name in SCHEMAS:
                table = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
                done[name] = spread(table) if name in ("orders", "documents", "pages") else table
            else:
                text = rel[name]
                inputs = [n for n in [*SCHEMAS, *rel] if _uses(text, n)]
                done[name] = spark.sql(_bound(text, inputs), **{n: get(n) for n in inputs})
        return done[name]

    return [get(n) for n in names]


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) is not None


def _bound(text: str, views: list[str]) -> str:
    return re.sub(r"\b(FROM|JOIN)\s+(\w+)\b",
                  lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in views else m[0], text)


def payload_pages(obits: DataFrame, layout: str) -> DataFrame:
    """Listing pages of the records: ``page_id, html``. A page holds the records of
    ``PAGE_SPAN`` consecutive ids, so its size does not grow with the table."""
    page = F.floor(F.col("id") / PAGE_SPAN).alias("page_id")
    path = F.substring("legacy_url", len(BASE_URL) + 1, 10_000)
    if layout == "json":
        item = F.to_json(F.struct(
            F.col("id").alias("personId"),
            F.struct(F.col("first_name").alias("firstName"), F.col("middle_name").alias("middleName"),
                     F.col("last_name").alias("lastName"), F.col("name_suffix").alias("suffix"),
                     F.col("deceased_name").alias("fullName")).alias("name"),
            F.struct(F.col("id"), F.concat("funeral_home", F.lit(" &amp; Sons")).alias("name"))
            .alias("funeralHome"),
            F.col("obit_text").alias("obitSnippet"),
            F.struct(F.struct(F.when(F.col("status") == "P", F.col("legacy_url")).otherwise(path)
                              .alias("href"), path.alias("path")).alias("obituaryUrl"))
            .alias("links"),
            F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss").alias("datePostedFrom"),
            F.lit("Publisher").alias("publisherName"),
            F.struct(F.struct(F.col("city").alias("fullName")).alias("city"),
                     F.struct(F.col("state").alias("code")).alias("state")).alias("location")))
        head = '<html><!-- <script type="application/json">[]</script> --><script>var x=1;</script>' \
               '<script type="application/json"><!--{"adMap":{"ads":[]},"obituaryList":{"obituaries":['
        tail = "]}}--></script></html>"
    elif layout == "state":
        item = F.to_json(F.struct(F.struct(
            F.struct(F.col("first_name").alias("firstName"), F.col("last_name").alias("lastName"))
            .alias("name"),
            F.struct(F.struct(path.alias("path")).alias("obituaryUrl")).alias("links"),
            F.col("obit_text").alias("obituaryNoHtml"),
            F.date_format("published_date", "MMM. d, yyyy").alias("publishedDate"),
            F.date_format("death_date", "yyyy-MM-dd").alias("deathDate"),
            F.col("funeral_home").alias("funeralHomeName")).alias("node")))
        head = '<html><script>window.__INITIAL_STATE__ = {"obituaries":{"edges":['
        tail = "]}} ;</script></html>"
    else:
        item = F.concat(F.lit('<a class="obit-card" href="'), path, F.lit('"><h3> '),
                        F.concat_ws(" ", "first_name", "middle_name", "last_name", "name_suffix"),
                        F.lit(" </h3><p>more</p></a>"),
                        F.when(F.col("priority") == "2-HIGH",
                               F.concat(F.lit('<a href="'), path, F.lit('">again</a>')))
                        .otherwise(""))
        head, tail = '<html><body><div class="obituary-list">', "</div></body></html>"
    joined = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("id", item.alias("t")))), lambda x: x["t"]),
        "," if layout != "links" else "")
    return obits.groupBy(page).agg(F.concat(F.lit(head), joined, F.lit(tail)).alias("html"))


def detail_pages(obits: DataFrame) -> DataFrame:
    """``url, html`` of detail pages, which exist for records of two of three statuses."""
    dates = F.when(F.col("priority") == "1-URGENT", F.concat(
        F.lit("<div class='obit-dates'>"), F.date_format("birth_date", "MMMM d, yyyy"),
        F.lit(" - "), F.date_format("death_date", "MMM d, yyyy"), F.lit("</div>"))) \
        .otherwise(F.concat(F.lit("<meta name='death' content='"), F.col("death_date").cast("string"),
                            F.lit("'><meta property='article:published' content='"),
                            F.col("published_date").cast("string"), F.lit("'>")))
    html = F.concat(
        F.lit("<html><body><h1>Dr. "), "last_name", F.lit(" <i>Sr.</i></h1>"), F.coalesce(dates, F.lit("")),
        F.coalesce(F.concat(F.lit("<span class='fh-name'>New "), "funeral_home", F.lit("</span>")),
                   F.lit("")),
        F.lit("<div class='x obit-body'><p>"), "obit_text", F.lit("</p><p>Services &amp; more.</p></div></html>"))
    return obits.where("status <> 'O'").select(F.col("legacy_url").alias("url"), html.alias("html"))
