"""County names, slugs, state names and source ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import SPACES, strip

# State abbreviations with the state part of listing addresses.
STATE_SLUGS = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california",
    "CO": "colorado", "CT": "connecticut", "DE": "delaware", "FL": "florida", "GA": "georgia",
    "HI": "hawaii", "ID": "idaho", "IL": "illinois", "IN": "indiana", "IA": "iowa",
    "KS": "kansas", "KY": "kentucky", "LA": "louisiana", "ME": "maine", "MD": "maryland",
    "MA": "massachusetts", "MI": "michigan", "MN": "minnesota", "MS": "mississippi",
    "MO": "missouri", "MT": "montana", "NE": "nebraska", "NV": "nevada",
    "NH": "new-hampshire", "NJ": "new-jersey", "NM": "new-mexico", "NY": "new-york",
    "NC": "north-carolina", "ND": "north-dakota", "OH": "ohio", "OK": "oklahoma",
    "OR": "oregon", "PA": "pennsylvania", "RI": "rhode-island", "SC": "south-carolina",
    "SD": "south-dakota", "TN": "tennessee", "TX": "texas", "UT": "utah", "VT": "vermont",
    "VA": "virginia", "WA": "washington", "WV": "west-virginia", "WI": "wisconsin",
    "WY": "wyoming",
}

# County kind suffixes; the first listed one that fits is removed.
COUNTY_SUFFIXES = [
    " County", " Parish", " Borough", " Census Area", " Municipality", " city",
    " City and Borough", " City", " Municipio",
]

# Slugs that do not follow the rule, by state and county.
SLUG_OVERRIDES = {("IL", "De Witt"): "de-witt-county", ("TX", "DeWitt"): "dewitt-county"}

# County classes kept from the census file.
COUNTY_CLASSES = ["H1", "H4", "H5", "H6"]

# States filled in from the first part of a source id.
STATE_BY_PREFIX = {"tx": "TX", "oh": "OH", "ma": "MA", "ga": "GA"}

# Counties filled in from a source id.
COUNTY_BY_SITE = {
    "tx-brown": "Brown", "tx-erath": "Erath", "tx-palo-pinto": "Palo Pinto",
    "tx-somervell": "Somervell", "tx-runnels": "Runnels", "tx-ellis": "Ellis",
    "tx-jim-wells": "Jim Wells", "tx-grayson": "Grayson", "tx-fannin": "Fannin",
    "oh-franklin": "Franklin", "oh-obetz": "Franklin", "oh-canal-winch": "Franklin",
    "oh-hamilton-twp": "Franklin", "oh-lockbourne": "Franklin", "oh-groveport": "Franklin",
    "oh-madison-twp": "Franklin", "oh-west-columbus": "Franklin",
    "oh-lincoln-vil": "Franklin", "oh-prairie-twp": "Franklin", "oh-westgate": "Franklin",
    "oh-galloway": "Franklin", "oh-hilliard": "Franklin", "oh-grove-city": "Franklin",
    "oh-urbancrest": "Franklin", "oh-lithopolis": "Fairfield", "oh-comm-point": "Pickaway",
    "ma-grafton": "Worcester", "ma-millbury": "Worcester", "ma-sutton": "Worcester",
    "ma-holden": "Worcester", "ga-claxton": "Evans",
}


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a small fixed map, null for other keys; the map is part of the plan."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def display_name(raw: Column) -> Column:
    """County name without its kind."""
    name = strip(raw)
    shown = name
    for suffix in reversed(COUNTY_SUFFIXES):
        cut = strip(F.left(name, F.char_length(name) - F.lit(len(suffix))))
        shown = F.when(name.endswith(suffix), cut).otherwise(shown)
    return shown


def county_slug(raw: Column) -> Column:
    """Address part of a county; letters outside ASCII become hyphens."""
    base = F.regexp_replace(display_name(raw), rf"^St\.[{SPACES}]+", "Saint ")
    bare = F.translate(F.lower(base), "'.", "")
    slug = F.btrim(F.regexp_replace(bare, "[^a-z0-9]+", "-"), F.lit("-"))
    return F.concat(slug, F.lit("-county"))


def overridden_slug(state: Column, raw: Column) -> Column:
    chosen = county_slug(raw)
    for (abbrev, county), slug in SLUG_OVERRIDES.items():
        chosen = F.when((state == abbrev) & (display_name(raw) == county), F.lit(slug)) \
            .otherwise(chosen)
    return chosen


def site_id(state: Column, slug: Column) -> Column:
    """Source id: state abbreviation and slug, every ``-county`` in it removed."""
    return F.concat_ws("-", F.lower(state), F.replace(slug, F.lit("-county"), F.lit("")))
