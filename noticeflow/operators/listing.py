"""Records of listing pages.

Three layouts are tried per page: a payload in a JSON script, a state object assigned in a
script, plain links. The first two are read with expressions only; a page goes through the
Python link reader only if both are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date, with_dates_from_text
from ..functions.names import PARTS, with_split_name
from ..functions.text import first_present, or_blank, present, present_once, strip, strip_long
from ..functions.urls import absolutise
from ..schemas import ITEM_LIST, LISTING_PAYLOAD, RECORD_FIELDS, STATE_PAYLOAD
from ..sources.html import has_unusual_reference, may_have_links, page_links, unescaped, usual_unescaped

# Shortest script considered, comment marks around its payload.
MIN_PAYLOAD = 100
_OPEN_MARK, _CLOSE_MARK = "<!--", "-->"

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Comments and styles are matched as well, so that a script inside one is passed over.
_SCRIPTS = rf"(?is)<!--.*?-->|<style\b{_ATTRS}>.*?</style|<script\b{_ATTRS}>.*?</script"
_OPENING = rf"(?is)^<script\b({_ATTRS})>"
# Fixed value: the script type that holds payloads.
_JSON_NAME = "application/json"
_JSON_TYPE = rf"""(?:^|\s)(?i:type)\s*=\s*(?:"{_JSON_NAME}"|'{_JSON_NAME}'|{_JSON_NAME}(?:\s|/?$))"""
# Fixed value: the assignment that carries the state object.
_ASSIGNED = r"(?s)window\.__INITIAL_STATE__\s*=\s*(\{.*?\})\s*;"

_JSON = {"allowSingleQuotes": "false"}

# One item of any layout before field rules apply.
RAW_ITEM = ("struct<layout:int, url:string, first:string, middle:string, last:string, "
            "suffix:string, full:string, text:string, published:string, death:string, "
            "funeral_home:string, city:string, state:string>")


def script_payloads(html: Column) -> Column:
    """Bodies of the JSON scripts of a page, comment marks removed, still escaped. Pages without the
    name of that type anywhere have none; they are not searched for scripts."""
    scripts = F.when(F.contains(html, F.lit(_JSON_NAME)), F.regexp_extract_all(html, F.lit(_SCRIPTS), F.lit(0)))
    tags = F.filter(
        F.transform(scripts, lambda t: F.struct(t.alias("tag"), F.regexp_extract(t, _OPENING, 1).alias("attrs"))),
        lambda t: t["attrs"].rlike(_JSON_TYPE))
    # What stands between "<script", the attributes, ">" and "</script".
    inner = F.transform(tags, lambda t: F.substring(
        t["tag"], F.char_length(t["attrs"]) + F.lit(9), F.char_length(t["tag"]) - F.char_length(t["attrs"]) - F.lit(16)))
    bodies = F.filter(F.transform(inner, strip_long), lambda b: F.char_length(b) >= MIN_PAYLOAD)
    opened = F.transform(bodies, lambda b: F.when(
        b.startswith(_OPEN_MARK), F.substring(b, len(_OPEN_MARK) + 1, 2147483647)).otherwise(b))
    closed = F.transform(opened, lambda b: F.when(
        b.endswith(_CLOSE_MARK), F.left(b, F.char_length(b) - F.lit(len(_CLOSE_MARK))))
        .otherwise(b))
    return F.transform(closed, strip_long)


def _raw(layout: int, **fields: Column) -> Column:
    parts = [F.lit(layout).alias("layout")]
    for entry in RAW_ITEM[len("struct<layout:int, "):-1].split(", "):
        name = entry.split(":")[0]
        value = fields.get(name)
        parts.append((F.lit(None).cast("string") if value is None else value).alias(name))
    return F.struct(*parts).cast(RAW_ITEM)


def _listing_item(e: Column) -> Column:
    n = e["name"]
    return _raw(
        1, url=e["links"]["obituaryUrl"]["href"], first=n["firstName"], middle=n["middleName"],
        last=n["lastName"], suffix=n["suffix"], full=n["fullName"], text=e["obitSnippet"],
        published=e["datePostedFrom"],
        funeral_home=F.coalesce(present(e["funeralHome"]["name"]), e["publisherName"]),
        city=e["location"]["city"]["fullName"], state=e["location"]["state"]["code"])


def _state_item(edge: Column) -> Column:
    n = edge["node"]
    return _raw(
        2, url=n["links"]["obituaryUrl"]["path"], first=n["name"]["firstName"],
        last=n["name"]["lastName"], text=n["obituaryNoHtml"], published=n["publishedDate"],
        death=n["deathDate"], funeral_home=n["funeralHomeName"])


def _link_item(link: Column) -> Column:
    return _raw(3, url=link["href"], full=link["name"])


def _has_rows(c: Column) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def _as_array(text: Column, kind: T.DataType) -> Column:
    """The text decoded as the only element of an array: text that goes on after the first
    value does not decode, which it would on its own."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(kind), _JSON)


def _decoded(text: Column, kind: T.DataType) -> Column:
    single = F.filter(F.array(_as_array(text, kind)), lambda a: F.size(a) == 1)
    return F.get(F.get(single, F.lit(0)), F.lit(0))


def _other_list(payload: Column) -> Column:
    """Items below the first top-level key whose object lists record-like items."""
    def record_like(entry: Column) -> Column:
        items = F.from_json(entry, T.StructType(
            [T.StructField("obituaries", T.ArrayType(T.StringType()))]), _JSON)["obituaries"]
        keys = F.json_object_keys(F.get(items, F.lit(0)))
        return F.coalesce(
            F.array_contains(keys, "personId") | F.array_contains(keys, "name"), F.lit(False))

    entries = F.map_values(_decoded(payload, T.MapType(T.StringType(), T.StringType())))
    chosen = F.get(F.filter(entries, record_like), F.lit(0))
    return F.from_json(chosen, ITEM_LIST, _JSON)["obituaries"]


_NOT_AN_OBJECT = "TypeError: listing payload is not an object"
_NOT_A_LIST = "AttributeError: listing entries are not objects"


def _error(payload: Column, items: Column) -> Column:
    """Why a payload cannot be read; null for payloads with items and for those that are
    no JSON or hold no listing, which are passed over."""
    def valid(text: Column) -> Column:
        return F.coalesce(F.size(_as_array(text, T.StringType())) == 1, F.lit(False))

    at_path = F.get_json_object(payload, "$.obituaryList.obituaries")
    nothing = at_path.isNull() | at_path.isin("", "[]", "{}", "0", "0.0", "false", "null")
    return (
        F.when(_has_rows(items), F.when(F.exists(items, lambda e: e.isNull()), F.lit(_NOT_A_LIST)))
        .when(payload.startswith("{"), F.when(~nothing & valid(payload), F.lit(_NOT_A_LIST)))
        .when(~payload.isin("[]", '""') & valid(payload), F.lit(_NOT_AN_OBJECT))
    )


def _outcomes(payloads: Column) -> Column:
    """Per script either items, an error, or nothing."""
    main = F.transform(payloads, lambda p: F.struct(
        p.alias("p"), _decoded(p, LISTING_PAYLOAD)["obituaryList"]["obituaries"].alias("main")))
    both = F.transform(main, lambda x: F.struct(
        x["p"].alias("p"),
        F.when(_has_rows(x["main"]), x["main"]).otherwise(_other_list(x["p"])).alias("items")))
    return F.transform(both, lambda x: F.struct(
        x["items"].alias("items"), _error(x["p"], x["items"]).alias("error")))


def _first_outcome(payloads: Column) -> Column:
    return F.get(F.filter(_outcomes(payloads),
                          lambda o: _has_rows(o["items"]) | o["error"].isNotNull()), F.lit(0))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that several later columns use. As the output of a generator it
    is computed once per row; a plain column would be copied into each use."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _state(html: Column) -> Column:
    """The decoded state object of a page."""
    return _decoded(present_once(F.regexp_extract(html, _ASSIGNED, 1)), STATE_PAYLOAD)


def _state_items(state: Column) -> Column:
    deep = state["BrowseStore"]["data"]["obituaries"]["obituaries"]["edges"]
    return F.transform(F.when(_has_rows(deep), deep).otherwise(state["obituaries"]["edges"]),
                       _state_item)


def page_items(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by ``items``, an array of raw items, and ``error``."""
    found = pages.withColumn("_payloads", script_payloads(F.col("html")))
    escaped = F.exists("_payloads", has_unusual_reference)
    found = found.withColumn("_plain", unescaped(F.when(escaped, F.col("_payloads"))))
    found = _once(found, "_json", _first_outcome(
        F.coalesce(F.col("_plain"), F.transform("_payloads", usual_unescaped))))
    found = _once(found, "_state",
                  F.when(F.col("_json").isNull(), _state(F.col("html"))))
    found = found.withColumn("_state", _state_items(F.col("_state")))
    needs_links = F.col("_json").isNull() & ~_has_rows(F.col("_state"))
    found = found.withColumn("_links", page_links(
        F.when(needs_links & may_have_links(F.col("html")), F.col("html"))))
    error = F.col("_json")["error"]
    return found.withColumns({
        "items": F.when(error.isNull(), F.coalesce(
            F.transform(F.col("_json")["items"], _listing_item),
            F.when(_has_rows(F.col("_state")), F.col("_state")),
            F.transform("_links", _link_item))),
        "error": error,
    }).drop("html", "_payloads", "_plain", "_json", "_state", "_links")


def _record(base_url: str) -> dict[str, Column]:
    i = F.col("_i")
    layout = i["layout"]
    raw_url = or_blank(i["url"])
    url = F.when(layout == 2, F.when(raw_url == "", raw_url)
                 .otherwise(F.concat(F.lit(base_url), raw_url))) \
        .otherwise(absolutise(raw_url, base_url))
    both = strip(F.concat_ws(" ", or_blank(i["first"]), or_blank(i["last"])))
    return {
        "url": url,
        "deceased_name": F.when(layout == 1, first_present(i["full"], both))
        .when(layout == 2, both).otherwise(or_blank(i["full"])),
        "obit_text": or_blank(i["text"]),
        "published_date": parse_date(i["published"]),
        "funeral_home": i["funeral_home"],
        "city": or_blank(i["city"]),
        "state": or_blank(i["state"]),
    }


def extract_records(pages: DataFrame, base_url: str) -> DataFrame:
    """Records of all pages: page columns, ``pos``, the record fields, ``error``.

    A page without records keeps one row with a null ``pos``, so failed pages stay
    countable in the same result.
    """
    carried = [c for c in pages.columns if c != "html"]
    rows = page_items(pages).select(*carried, "error", F.posexplode_outer("items").alias("pos", "_i"))
    rows = rows.withColumns({f"_{k}": v for k, v in _record(base_url).items()})
    dated = with_dates_from_text(
        rows.withColumn("_t", F.when(F.col("_i.layout") == 1, F.col("_obit_text"))),
        "_t", "_death", "_birth")
    dated = with_split_name(dated, "_deceased_name")
    structured = F.col("_i.layout") == 1
    given = dict(zip(PARTS, ("first", "middle", "last", "suffix")))
    values = {f: F.col(f"_{f}") for f in _record(base_url)}
    for part in PARTS:
        values[part] = F.when(structured, or_blank(F.col("_i")[given[part]])) \
            .otherwise(F.col(part))
    values["death_date"] = F.when(F.col("_i.layout") == 2, parse_date(F.col("_i.death"))) \
        .otherwise(F.col("_death"))
    values["birth_date"] = F.col("_birth")
    present_row = F.col("pos").isNotNull()
    return dated.select(*carried, "pos", *[
        F.when(present_row, values[f]).alias(f) for f in RECORD_FIELDS], "error")
