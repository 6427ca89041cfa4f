"""Oracle SQL for the registered queries. Its logic is written independently of the library; the fixed
values (state and county tables, column lists) are the library's, and tests state samples of them."""

from __future__ import annotations

from noticeflow.functions.places import (
    COUNTY_BY_SITE, COUNTY_CLASSES, COUNTY_SUFFIXES, STATE_BY_PREFIX, STATE_SLUGS,
)
from noticeflow.schemas import OBITS, REPORT_COLUMNS, VIEW_COLUMNS

from .inputs import AS_OF, BASE_URL, PAGE_SPAN, with_relations

COLS = ", ".join(OBITS.names)


# --- dates in text, plain form of the patterns (test texts are ASCII) -----------------------

# Month and weekday names and the phrases of the patterns.
_MON = (r"(January|February|March|April|May|June|July|August|September|October|November|December"
        r"|Jan\.?|Feb\.?|Mar\.?|Apr\.?|Jun\.?|Jul\.?|Aug\.?|Sep\.?|Sept\.?|Oct\.?|Nov\.?|Dec\.?)")
_LONG = _MON + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})"
_NUM = r"(\d{1,2})/(\d{1,2})/(\d{4})"
_DAY = r"(?:(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday),?\s+)?"
_TO_DATE = r"(?:on\s+)?" + _DAY + _LONG

DEATH = {
    "a": r"passed\s+away\s+(?:\w+\s+)*?" + _TO_DATE,
    "b": r"passed\s+(?:peacefully|quietly|suddenly|unexpectedly)\s+" + _TO_DATE,
    "c": r"passed\s+on\s+(?:to\s+\S+\s+\S+\s+\S+\s+)?" + _TO_DATE,
    "d": r"passed\s+from\s+.{1,40}?\s+" + _TO_DATE,
    "e": r"went\s+(?:home\s+)?to\s+be\s+with\s+.{1,40}?\s+" + _TO_DATE,
    "f": r"entered\s+(?:eternal\s+|into\s+)?rest\s+" + _TO_DATE,
    "g": r"died\s+" + _TO_DATE,
    "h": r"death\s+(?:on\s+)?" + _LONG,
    "i": r"[-–—]\s*" + _LONG,
    "j": r"passed\s+away\s+(?:\w+\s+)*?" + _NUM,
    "k": r"died\s+(?:on\s+)?" + _NUM,
}
BIRTH = {
    "l": r"born\s+(?:to\s+.{1,80}?\s+on\s+)?" + _LONG,
    "m": r"born\s+(?:on\s+|in\s+)?" + _LONG,
    "n": r"born\s+(?:on\s+)?" + _NUM,
}
_MONTHS = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"


def _date_of(text: str, pattern: str, numeric: bool) -> str:
    g = [f"regexp_extract({text}, '{pattern}', {i}, 'i')" for i in (1, 2, 3)]
    month = g[0] if numeric else f"cast(list_position({_MONTHS}, lower({g[0]}[1:3])) AS varchar)"
    return f"try_cast({g[2]} || '-' || {month} || '-' || {g[1]} AS date)"


def first_date(text: str, patterns: dict[str, str]) -> str:
    return "coalesce(" + ", ".join(
        _date_of(text, p, k in "jkn") for k, p in patterns.items()) + ")"


def first_label(text: str, patterns: dict[str, str]) -> str:
    return "CASE " + " ".join(
        f"WHEN {_date_of(text, p, k in 'jkn')} IS NOT NULL THEN '{k}'"
        for k, p in patterns.items()) + " END"


DEATH_DATE, BIRTH_DATE = first_date("obit_text", DEATH), first_date("obit_text", BIRTH)

# --- duplicates ------------------------------------------------------------------------------

_PERSON = "lower(first_name), lower(last_name), lower(coalesce(city, '')), lower(coalesce(state, ''))"


def marked(source: str, out: str) -> str:
    """Common table expression ``out``: ``source`` with new duplicate marks."""
    return f"""{out} AS (
  SELECT o.* EXCLUDE (duplicate_of), coalesce(o.duplicate_of,
    CASE WHEN p.primary_id <> o.id THEN p.primary_id END) AS duplicate_of
  FROM {source} o LEFT JOIN (
    SELECT id, first_value(id) OVER (PARTITION BY {_PERSON} ORDER BY death_date IS NULL,
      length(coalesce(obit_text, '')) DESC, scraped_at ASC, id ASC) AS primary_id
    FROM {source} WHERE first_name <> '' AND last_name <> '' AND duplicate_of IS NULL) p
  ON o.id = p.id)"""


def with_marks(query: str) -> str:
    base = with_relations("", "obits").rstrip()
    return f"{base},\n{marked('obits', 'marked')}\n{query}"


def with_two_runs(query: str) -> str:
    base = with_relations("", "obits", "stored").rstrip()
    return (f"{base},\n{marked('stored', 'first_run')},\nboth_runs AS (SELECT * FROM first_run "
            f"UNION ALL BY NAME SELECT * FROM obits WHERE id NOT IN (SELECT id FROM stored)),\n"
            f"{marked('both_runs', 'second_run')}\n{query}")


_AT = "coalesce(cast(death_date AS timestamp), cast(published_date AS timestamp), scraped_at)"
_SHOWN = """id, CASE WHEN deceased_name <> '' THEN deceased_name
  ELSE coalesce(first_name, '') || ' ' || coalesce(last_name, '') END AS name,
  coalesce(cast(birth_date AS varchar), '') AS birth_date,
  coalesce(cast(death_date AS varchar), '') AS death_date,
  coalesce(cast(published_date AS varchar), '') AS published_date,
  coalesce(funeral_home, '') AS funeral_home, coalesce(city, '') AS city,
  coalesce(county, '') AS county, coalesce(state, '') AS state,
  coalesce(legacy_url, '') AS legacy_url"""

SQL: dict[str, str] = {
    "scan_obits": with_relations(
        "SELECT * REPLACE (CASE WHEN id % 7 <> 0 THEN state END AS state) FROM "
        f"(SELECT {COLS} FROM obits)", "obits"),
    "v_obituaries": with_marks(
        f"SELECT {', '.join(VIEW_COLUMNS)} FROM marked WHERE duplicate_of IS NULL"),
    "obit_count": with_relations("SELECT count(*) AS obituary_count FROM obits", "obits"),
    "schema_upgrade": with_relations(
        "SELECT " + ", ".join(
            f"cast(NULL AS {'bigint' if c == 'duplicate_of' else 'varchar'}) AS {c}"
            if c in ("city", "state", "county", "duplicate_of") else c for c in OBITS.names)
        + " FROM obits", "obits"),
    "person_dedup": with_marks("SELECT id, duplicate_of FROM marked"),
    "dupe_groups": with_relations(
        """SELECT DISTINCT person[1] AS given, person[2] AS family, person[3] AS town, person[4] AS region, size AS cnt FROM (
  SELECT person, count(*) OVER (PARTITION BY person) AS size FROM (
    SELECT list_transform([first_name, last_name, city, state], lambda x: lower(coalesce(x, ''))) AS person
    FROM obits WHERE duplicate_of IS NULL) WHERE person[1] <> '' AND person[2] <> '')
WHERE size >= 2""", "obits"),
    "dedup_incremental": with_two_runs("SELECT id, duplicate_of FROM second_run"),
    "dup_with_primary": with_two_runs(
        """SELECT d.id, d.duplicate_of, d.legacy_url AS duplicate_url, p.legacy_url AS primary_url,
  p.deceased_name AS primary_name FROM second_run d JOIN second_run p ON d.duplicate_of = p.id"""),
    "report_filter": with_marks("\nUNION ALL ".join(
        f"SELECT '{name}' AS request, id FROM marked WHERE duplicate_of IS NULL AND {cond}"
        for name, cond in {
            "funeral_home": "funeral_home ILIKE '%build%Home%'",
            "city": "city ILIKE '%nation_1%'",
            "county": "lower(county) = 'county 7'",
            "state": "state = 'EU'",
            "death_date": "death_date = date '1998-03-05'",
            "combined": "state = 'AM' AND city ILIKE '%NATION%' AND funeral_home ILIKE '%furniture%'",
            "none": "true"}.items())),
    "latest_report": with_marks(
        f"""SELECT id, {', '.join(REPORT_COLUMNS)} FROM marked WHERE duplicate_of IS NULL
ORDER BY {_AT} DESC NULLS LAST, id ASC LIMIT 2000"""),
    "report_rows": with_relations(f"SELECT {_SHOWN} FROM obits", "obits"),
    "report_page": with_marks(
        f"""SELECT * EXCLUDE (sort_at) FROM (
  SELECT {_SHOWN}, sort_at FROM (
    SELECT *, {_AT} AS sort_at FROM marked WHERE duplicate_of IS NULL AND lower(county) = 'county 7'
    ORDER BY {_AT} DESC NULLS LAST, id ASC LIMIT 2000))
WHERE concat_ws(' ', name, birth_date, death_date, published_date, funeral_home, city, county, state)
  ILIKE '%funeral%' AND concat_ws(' ', name, birth_date, death_date, published_date, funeral_home,
  city, county, state) ILIKE '%nation%'
ORDER BY death_date DESC, sort_at DESC, id ASC LIMIT 50 OFFSET 50"""),
    "extract_dates": with_relations(
        f"SELECT id, {DEATH_DATE} AS death_date, {BIRTH_DATE} AS birth_date FROM obits", "obits"),
    "extract_dates_documents":
        f"SELECT doc_id, {first_date('text', DEATH)} AS death_date, "
        f"{first_date('text', BIRTH)} AS birth_date FROM documents",
    "death_pattern_hits": with_relations(
        f"""SELECT {first_label('obit_text', DEATH)} AS death_pattern,
  {first_label('obit_text', BIRTH)} AS birth_pattern, count(*) AS n FROM obits GROUP BY ALL""",
        "obits"),
    "backfill_dates": with_relations(
        f"""SELECT id, coalesce(death_date, {DEATH_DATE}) AS death_date,
  coalesce(birth_date, {BIRTH_DATE}) AS birth_date FROM obits""", "obits"),
    "backfill_counts": with_relations(
        f"""SELECT count(*) AS rows_processed,
  count(*) FILTER (WHERE birth_date IS NULL AND {BIRTH_DATE} IS NOT NULL) AS birth_dates_updated,
  count(*) FILTER (WHERE death_date IS NULL AND {DEATH_DATE} IS NOT NULL) AS death_dates_updated
FROM obits WHERE obit_text <> '' AND (birth_date IS NULL OR death_date IS NULL)""", "obits"),
    "parse_date": with_relations(
        """SELECT id, unnest([strftime(p, '%Y-%m-%d'), strftime(p, '%Y-%m-%dT00:00:00Z'),
  strftime(p, '%B %-d, %Y'), 'on ' || strftime(p, '%b. %-d, %Y'), strftime(p, '%-m/%-d/%Y'),
  strftime(p, '%m-%d-%Y'), strftime(p, '%-d. %B %Y'), '2001-02-30']) AS s,
  unnest([p, p, p, p, p, p, NULL, NULL]) AS d
FROM (SELECT id, published_date AS p FROM obits)""", "obits"),
    "date_range": with_relations(
        """SELECT id, s, coalesce(s LIKE '% - %' OR s LIKE '% to %', false) AS is_range,
  CASE WHEN s LIKE '% - %' OR s LIKE '% to %' THEN published_date END AS d
FROM (SELECT id, published_date, strftime(birth_date, '%B %-d, %Y')
    || CASE WHEN city = '' THEN ' to ' WHEN middle_name = '' THEN ' - ' ELSE ' / ' END
    || strftime(published_date, '%B %-d, %Y') AS s FROM obits)""", "obits"),
    "split_name": with_relations(
        """SELECT id, full_name,
  CASE WHEN n >= 1 THEN t[1] ELSE '' END AS first_name,
  CASE WHEN n >= 3 THEN array_to_string(t[2:n-1], ' ') ELSE '' END AS middle_name,
  CASE WHEN n >= 2 THEN t[n] ELSE '' END AS last_name, name_suffix
FROM (SELECT id, full_name, name_suffix, t0 AS t,
    CASE WHEN name_suffix = 'Jr.' THEN len(t0) - 1 ELSE len(t0) END AS n
  FROM (SELECT id, full_name, name_suffix,
      list_filter(string_split(replace(full_name, ',', ' '), ' '), lambda x: x <> '') AS t0
    FROM (SELECT id, name_suffix, concat_ws(' ', first_name, middle_name, ' Anna,', last_name,
        name_suffix) AS full_name FROM obits)))""", "obits"),
    "absolutise_url": with_relations(
        """SELECT id, CASE WHEN middle_name = '' THEN legacy_url WHEN name_suffix <> '' THEN ''
  ELSE legacy_url END AS url FROM obits""", "obits"),
    "listing_url": with_relations(
        f"""SELECT id, CASE WHEN coalesce(state, '') <> '' THEN
  '{BASE_URL}/us/obituaries/local/' || lower(state) || '/' || lower(site_id) END AS listing_url,
  coalesce(state, '') = '' AS failed FROM gaps""", "obits", "gaps"),
    "site_prefix": with_relations(
        "SELECT id, site_id FROM gaps WHERE NOT starts_with(site_id, 'il-')", "obits", "gaps"),
    "backfill_state": with_relations(
        "SELECT id, site_id, CASE " + " ".join(
            f"WHEN state IS NULL AND lower(site_id) LIKE '{p}-%' THEN '{s}'"
            for p, s in STATE_BY_PREFIX.items())
        + " ELSE state END AS state, county FROM gaps", "obits", "gaps"),
    "backfill_county": with_relations(
        "SELECT id, site_id, state, CASE " + " ".join(
            f"WHEN county IS NULL AND lower(site_id) = '{p}' THEN '{s}'"
            for p, s in COUNTY_BY_SITE.items())
        + " ELSE county END AS county FROM gaps", "obits", "gaps"),
}

for _column, _limit in {"state": "", "county": "LIMIT 500", "city": "LIMIT 500",
                        "funeral_home": "LIMIT 500"}.items():
    SQL[f"facet_{_column}"] = with_relations(
        f"""SELECT min({_column}) AS {_column} FROM obits WHERE {_column} <> ''
GROUP BY lower({_column}) ORDER BY lower({_column}) {_limit}""", "obits")

# --- markets ---------------------------------------------------------------------------------

_BASE = "CASE " + " ".join(
    f"WHEN ends_with(n, '{s}') THEN trim(n[:len(n)-{len(s)}])" for s in COUNTY_SUFFIXES
) + " ELSE n END"
_SLUG = ("trim(regexp_replace(replace(replace(lower(regexp_replace(base, '^St\\.\\s+', 'Saint ')),"
         " '''', ''), '.', ''), '[^a-z0-9]+', '-', 'g'), '-') || '-county'")
_STATES = "CASE STATE " + " ".join(f"WHEN '{a}' THEN '{s}'" for a, s in STATE_SLUGS.items()) + " END"
_SLUGGED = f"""slugged AS (SELECT *, CASE WHEN STATE = 'IL' AND base = 'De Witt' THEN 'de-witt-county'
  WHEN STATE = 'TX' AND base = 'DeWitt' THEN 'dewitt-county' ELSE slug END AS used_slug
FROM (SELECT *, {_SLUG} AS slug FROM (SELECT *, {_BASE} AS base
  FROM (SELECT *, trim(COUNTYNAME) AS n FROM census)))),
built AS (SELECT STATE AS abbrev, COUNTYNAME, lower(STATE) || '-' || replace(used_slug, '-county', '')
  AS site_id, {_STATES} AS state, used_slug AS legacy_slug, 'county' AS type, base AS county
FROM slugged WHERE {_STATES} IS NOT NULL AND CLASSFP IN ({', '.join(f"'{c}'" for c in COUNTY_CLASSES)}))"""


def with_census(query: str) -> str:
    return with_relations("", "census").rstrip() + ",\n" + _SLUGGED + "\n" + query


SQL |= {
    "census_scan": with_relations("SELECT STATE, COUNTYNAME, CLASSFP FROM census", "census"),
    "county_slug": with_census(
        """SELECT STATE, COUNTYNAME, base AS county, slug, used_slug,
  lower(STATE) || '-' || replace(used_slug, '-county', '') AS site_id FROM slugged"""),
    "markets_build": with_census(
        """SELECT cast(row_number() OVER (ORDER BY abbrev, COUNTYNAME) - 1 AS integer) AS market_seq,
  site_id, state, legacy_slug, type, county FROM built"""),
    "markets_by_state": with_census("SELECT state, count(*) AS markets FROM built GROUP BY state"),
    "market_totals": with_census(
        "SELECT count(*) AS markets, count(DISTINCT state) AS states FROM built"),
    "markets_scan": with_relations(
        f"""SELECT seq // {PAGE_SPAN} AS block, cast(row_number() OVER (PARTITION BY seq // {PAGE_SPAN}
    ORDER BY seq) - 1 AS integer) AS market_seq,
  lower(abbrev) || '-' || replace(string_split(line, chr(9))[2], '-county', '') AS site_id, state,
  string_split(line, chr(9))[2] AS legacy_slug, 'county' AS type,
  string_split(line, chr(9))[1] AS county
FROM lines WHERE len(string_split(line, chr(9))) = 2""", "lines"),
    "county_lines": with_relations(
        """SELECT seq, abbrev, state, string_split(line, chr(9))[1] AS name,
  string_split(line, chr(9))[2] AS slug FROM lines WHERE len(string_split(line, chr(9))) = 2""",
        "lines"),
    "markets_merge": with_relations("", "lines").rstrip() + """,
listed AS (SELECT seq, lower(abbrev) || '-' || replace(string_split(line, chr(9))[2], '-county', '')
    AS site_id, state, string_split(line, chr(9))[2] AS legacy_slug, 'county' AS type,
    string_split(line, chr(9))[1] AS county
  FROM lines WHERE len(string_split(line, chr(9))) = 2),
existing AS (SELECT * FROM listed WHERE county LIKE '%5%'
  QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY seq DESC) = 1),
fresh AS (SELECT * FROM listed WHERE site_id NOT IN (SELECT site_id FROM existing)
  QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY seq) = 1)
SELECT cast(row_number() OVER (ORDER BY part, seq) - 1 AS integer) AS market_seq, site_id, state,
  legacy_slug, type, county
FROM (SELECT 0 AS part, * FROM existing UNION ALL SELECT 1, * FROM fresh)""",
}

# --- ingest ----------------------------------------------------------------------------------

_STORED_KEYS = "(SELECT lower(legacy_url) FROM stored)"
_RUN = ("obits", "stored", "sites", "candidates")
_STAMP = f"timestamp '{AS_OF:%Y-%m-%d %H:%M:%S}'"
_FIRST = """QUALIFY row_number() OVER (PARTITION BY lower(url) ORDER BY market_seq, pos) = 1"""
_LOG = f"""SELECT s.site_id, date '{AS_OF:%Y-%m-%d}' AS run_date,
  cast(CASE WHEN s.county = 'County 3' THEN 0 ELSE coalesce(found, 0) END AS integer) AS obits_found,
  cast(CASE WHEN s.county = 'County 3' THEN 0 ELSE coalesce(new, 0) END AS integer) AS obits_new,
  CASE WHEN s.county = 'County 3' THEN 'ValueError: bad page' END AS errors, {_STAMP} AS run_at
FROM sites s LEFT JOIN (
  SELECT site_id, count(*) AS found, count(*) FILTER (WHERE rn = 1) AS new FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(url) ORDER BY market_seq, pos) AS rn,
      min(market_seq) OVER (PARTITION BY lower(url)) AS first_seq
    FROM candidates WHERE url <> '' AND lower(url) NOT IN {_STORED_KEYS})
  WHERE market_seq = first_seq GROUP BY site_id) c ON s.site_id = c.site_id"""
_NEW_CITY = """SELECT lower(url) AS u, arg_min(CASE WHEN coalesce(city, '') = '' THEN 'New ' || site_id
  ELSE city END, struct_pack(market_seq, pos)) AS city,
  arg_min(site_id, struct_pack(market_seq, pos)) AS site_id
FROM candidates WHERE url <> '' GROUP BY ALL"""

SQL |= {
    "new_urls": with_relations(
        f"""SELECT site_id, pos, url FROM candidates
WHERE url <> '' AND lower(url) NOT IN {_STORED_KEYS}""", *_RUN),
    "attach_market": with_relations("SELECT site_id, pos, url, county FROM candidates", *_RUN),
    "keep_first": with_relations(
        f"SELECT market_seq, pos, url FROM candidates {_FIRST}", *_RUN),
    "insert_ignore": with_relations(
        f"""SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY market_seq, pos) AS id,
  site_id, url AS legacy_url, deceased_name, first_name, middle_name, last_name, name_suffix,
  published_date, death_date, birth_date, funeral_home, coalesce(city, '') AS city, state, county,
  obit_text, {_STAMP} AS scraped_at, false AS sent_to_cms, cast(NULL AS bigint) AS duplicate_of
FROM (SELECT * FROM candidates WHERE url <> '' {_FIRST})
WHERE lower(url) NOT IN {_STORED_KEYS}""", *_RUN),
    "run_log": with_relations(_LOG, *_RUN),
    "run_totals": with_relations(
        f"""SELECT count(*) AS markets, cast(sum(obits_found) AS bigint) AS total_found,
  cast(sum(obits_new) AS bigint) AS total_new FROM ({_LOG})""", *_RUN),
    "backfill_city": with_relations(
        f"""SELECT o.id, CASE WHEN coalesce(o.city, '') = '' THEN coalesce(c.city, o.city)
  ELSE o.city END AS city FROM obits o LEFT JOIN ({_NEW_CITY}) c ON lower(o.legacy_url) = c.u""",
        *_RUN),
    "backfill_city_counts": with_relations(
        f"""SELECT c.site_id, count(*) AS updated FROM obits o JOIN ({_NEW_CITY}) c
  ON lower(o.legacy_url) = c.u WHERE coalesce(o.city, '') = '' GROUP BY c.site_id""", *_RUN),
}

# --- pages -----------------------------------------------------------------------------------

_AT_PAGE = f"""id // {PAGE_SPAN} AS page_id,
  cast(row_number() OVER (PARTITION BY id // {PAGE_SPAN} ORDER BY id) - 1 AS integer) AS pos"""
_BOTH = "trim(first_name || ' ' || last_name)"
_FULL = f"CASE WHEN deceased_name <> '' THEN deceased_name ELSE {_BOTH} END"
_LISTED = "trim(concat_ws(' ', first_name, middle_name, last_name, name_suffix))"
_TAGGED = "'Dr. ' || last_name || 'Sr.'"
_HAS_RANGE = "priority = '1-URGENT' AND birth_date IS NOT NULL AND death_date IS NOT NULL"
_HAS_META = "priority <> '1-URGENT' AND death_date IS NOT NULL"
_SEEN = "priority <> '4-NOT SPECIFIED' AND status <> 'O'"


def _unescape(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&nbsp;", chr(160)), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


SQL |= {
    "extract_json": with_relations(
        f"""SELECT {_AT_PAGE}, legacy_url AS url, {_FULL} AS deceased_name, first_name, middle_name,
  last_name, name_suffix, obit_text, published_date, {DEATH_DATE} AS death_date,
  {BIRTH_DATE} AS birth_date, coalesce(funeral_home || ' & Sons', 'Publisher') AS funeral_home,
  coalesce(city, '') AS city, state FROM obits""", "obits"),
    "extract_state_json": with_relations(
        f"""SELECT {_AT_PAGE}, legacy_url AS url, {_BOTH} AS deceased_name,
  CASE WHEN first_name = '' THEN last_name ELSE first_name END AS first_name, '' AS middle_name,
  CASE WHEN first_name = '' THEN '' ELSE last_name END AS last_name, '' AS name_suffix, obit_text,
  published_date, death_date, cast(NULL AS date) AS birth_date, funeral_home, '' AS city, '' AS state
FROM obits""", "obits"),
    "extract_links": with_relations(
        f"""SELECT id // {PAGE_SPAN} AS page_id, legacy_url AS url,
  trim(concat_ws(' ', first_name, middle_name, last_name, name_suffix)) AS deceased_name,
  CASE WHEN first_name <> '' THEN first_name WHEN middle_name <> '' THEN middle_name
    ELSE last_name END AS first_name,
  CASE WHEN first_name <> '' THEN middle_name ELSE '' END AS middle_name,
  CASE WHEN first_name <> '' OR middle_name <> '' THEN last_name ELSE '' END AS last_name,
  name_suffix, '' AS obit_text, cast(NULL AS date) AS published_date,
  cast(NULL AS date) AS death_date, cast(NULL AS date) AS birth_date,
  cast(NULL AS varchar) AS funeral_home, '' AS city, '' AS state FROM obits""", "obits"),
    "extract_cascade": with_relations(
        f"""SELECT 'json' AS kind, {_AT_PAGE}, legacy_url AS url, {_FULL} AS deceased_name,
  cast(NULL AS varchar) AS error FROM obits
UNION ALL SELECT 'state', {_AT_PAGE}, legacy_url, {_BOTH}, NULL FROM obits
UNION ALL SELECT 'links', {_AT_PAGE}, legacy_url, {_LISTED}, NULL FROM obits
UNION ALL SELECT 'crawled', page_id, NULL, NULL, NULL, NULL FROM pages""", "obits"),
    "extract_alt_path": with_relations(
        f"""SELECT {_AT_PAGE}, legacy_url AS url, {_FULL} AS deceased_name,
  cast(NULL AS varchar) AS error FROM obits WHERE id // {PAGE_SPAN} % 5 <> 0
UNION ALL SELECT DISTINCT id // {PAGE_SPAN}, cast(NULL AS integer), NULL, NULL,
  'TypeError: listing payload is not an object' FROM obits WHERE id // {PAGE_SPAN} % 5 = 0""",
        "obits"),
    "page_title": f"""SELECT page_id,
  trim({_unescape("regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)")}) AS name FROM pages""",
    "page_text": f"""SELECT page_id, array_to_string(list_filter(list_transform(
  regexp_split_to_array(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<[^>]*>'),
  lambda x: trim({_unescape('x')}, E' \\t\\n\\r')), lambda x: x <> ''), ' ') AS text FROM pages""",
    "page_fields": with_relations(
        f"""SELECT legacy_url AS url, {_TAGGED} AS name, 'New ' || funeral_home AS funeral_home,
  obit_text || ' Services & more.' AS text FROM obits WHERE status <> 'O'""", "obits"),
    "page_dates": with_relations(
        f"""SELECT legacy_url AS url, CASE WHEN {_HAS_META} THEN published_date END AS published,
  CASE WHEN {_HAS_META} OR ({_HAS_RANGE}) THEN death_date END AS death
FROM obits WHERE status <> 'O'""", "obits"),
    "link_dedup": with_relations(
        f"SELECT {_AT_PAGE}, legacy_url AS url, {_LISTED} AS deceased_name FROM obits", "obits"),
    "enrich_merge": with_relations(
        f"""SELECT id, CASE WHEN {_SEEN} THEN {_TAGGED} ELSE deceased_name END AS deceased_name,
  CASE WHEN {_SEEN} THEN 'Dr.' ELSE first_name END AS first_name,
  CASE WHEN {_SEEN} THEN '' ELSE middle_name END AS middle_name,
  CASE WHEN {_SEEN} THEN last_name || 'Sr.' ELSE last_name END AS last_name,
  CASE WHEN {_SEEN} THEN '' ELSE name_suffix END AS name_suffix,
  CASE WHEN {_SEEN} THEN obit_text || ' Services & more.'
    WHEN priority <> '4-NOT SPECIFIED' THEN '' ELSE obit_text END AS obit_text,
  published_date, death_date, birth_date,
  CASE WHEN {_SEEN} THEN 'New ' || funeral_home ELSE funeral_home END AS funeral_home,
  CASE WHEN {_SEEN} THEN coalesce(city, '') ELSE city END AS city, state FROM obits""", "obits"),
}

# --- runs ------------------------------------------------------------------------------------

_DAY = with_relations("", "obits").rstrip() + f""",
appended AS (SELECT row_number() OVER (ORDER BY id) AS id, 's-' || cast(id // {PAGE_SPAN} AS varchar)
    AS site_id, legacy_url, {_FULL} AS deceased_name, first_name, last_name, obit_text,
    {DEATH_DATE} AS death_date, {BIRTH_DATE} AS birth_date, coalesce(city, '') AS city, state,
    {_STAMP} AS scraped_at, cast(NULL AS bigint) AS duplicate_of FROM obits),
{marked('appended', 'marked')}
SELECT id, site_id, legacy_url, deceased_name, death_date, birth_date, city, duplicate_of FROM marked"""
SQL |= {"daily_run": _DAY, "ingest_stream": _DAY}


def appended(parts: int, order: str) -> str:
    """Records of runs over shares of the pages; ``order`` tells in which run a page came."""
    return with_relations(
        f"""SELECT row_number() OVER (ORDER BY {order.format(page=f'(id // {PAGE_SPAN})', parts=parts)}, id) AS id,
  's-' || cast(id // {PAGE_SPAN} AS varchar) AS site_id, legacy_url, {_FULL} AS deceased_name FROM obits""", "obits")


_GAPS_FILLED = f"""SELECT o.id, coalesce(o.birth_date, {BIRTH_DATE}) AS birth_date,
  coalesce(o.death_date, {DEATH_DATE}) AS death_date, s.state, c.county
FROM obits o JOIN state_filled s ON o.id = s.id JOIN county_filled c ON o.id = c.id"""


def _inner(name: str) -> str:
    """The last SELECT of a registered text, to stand behind the same relations."""
    text = SQL[name]
    return text[text.rindex("SELECT id, site_id"):]


SQL |= {
    "markets_roundtrip": SQL["markets_build"],
    "facet_all": with_relations(
        "SELECT DISTINCT 'County ' || cast(id % 2000 AS varchar) AS county FROM obits", "obits"),
    "stream_after_daily": appended(3, "{page} % {parts}"),
    "repeat_batch": appended(2, "{page} % {parts}"),
    "marked_count": f"SELECT count(*) AS marked FROM ({_DAY}) WHERE duplicate_of IS NOT NULL",
    "backfill_store": with_relations("", "obits", "gaps").rstrip()
    + f", state_filled AS ({_inner('backfill_state')}), county_filled AS ({_inner('backfill_county')}) {_GAPS_FILLED}",
    "city_backfill_run": with_relations(
        f"""SELECT id, CASE WHEN lacks AND id // {PAGE_SPAN} % 4 <> 0 AND coalesce(city, '') <> '' THEN city
  WHEN id % 2 = 0 THEN '' WHEN id % 5 = 0 THEN NULL ELSE city END AS city
FROM (SELECT id, city, id % 2 = 0 OR id % 5 = 0 OR coalesce(city, '') = '' AS lacks FROM obits)""", "obits"),
}
SQL["report_page_beyond"] = with_relations(
    f"""SELECT * EXCLUDE (sort_at) FROM (SELECT {_SHOWN}, {_AT} AS sort_at FROM obits WHERE duplicate_of IS NULL)
ORDER BY death_date DESC, sort_at DESC NULLS LAST, id ASC LIMIT 50 OFFSET 2250""", "obits")


# --- days of a store --------------------------------------------------------------------------

_THREE_DAYS = with_relations("", "obits").rstrip() + f""",
day0 AS (SELECT {COLS} FROM obits WHERE id % 3 = 0), {marked('day0', 'after0')},
day1 AS (SELECT {COLS} FROM after0 UNION ALL SELECT {COLS} FROM obits WHERE id % 3 = 1), {marked('day1', 'after1')},
day2 AS (SELECT {COLS} FROM after1 UNION ALL SELECT {COLS} FROM obits WHERE id % 3 = 2), {marked('day2', 'after2')}
"""
SQL |= {
    "failed_repeat": SQL["repeat_batch"],
    "enrich_archive": SQL["enrich_merge"],
    "dedup_delta": _THREE_DAYS + "SELECT id, duplicate_of FROM after2",
    "compacted_store": _THREE_DAYS + f"SELECT {COLS} FROM after2",
    "report_state": _THREE_DAYS + """SELECT r.request, id, state FROM after2 JOIN (VALUES ('eu', 'EU', ''), ('AM', 'AM', ''),
  ('none', 'ZZ', ''), ('any', '', 'nation_1'), ('both', 'AS', '')) r(request, wanted, town)
ON (wanted = '' OR state = wanted) AND (town = '' OR lower(city) LIKE '%nation_1%')
  AND (request <> 'both' OR lower(funeral_home) LIKE '%build%home%')
WHERE duplicate_of IS NULL""",
    "stored_links": with_relations(
        f"""SELECT site_id, count(*) AS known_rows FROM candidates
WHERE url <> '' AND lower(url) IN {_STORED_KEYS} GROUP BY site_id""", *_RUN),
}
