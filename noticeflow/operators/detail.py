"""Fields of detail pages and their merge into thin listing records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import is_date_range, parse_date, range_end
from ..functions.names import PARTS, with_split_name
from ..functions.text import first_present, or_blank, present
from ..sources.html import detail_fields
from .keyed import keep_first


def _last_meta(metas: Column, word: str, unless: str | None = None) -> Column:
    def hit(m: Column) -> Column:
        ok = F.contains(m["key"], F.lit(word)) & (m["content"] != "")
        return ok & ~F.contains(m["key"], F.lit(unless)) if unless else ok

    return parse_date(F.try_element_at(F.filter(metas, hit), F.lit(-1))["content"])


def extract_details(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by the fields of the page.

    A date range text wins over meta tags even when its end is no date; of meta tags the
    last one counts.
    """
    raw = pages.withColumn("_d", detail_fields("html")).drop("html")
    d = F.col("_d")
    ranged = raw.withColumn(
        "_range", F.try_element_at(F.filter(d["date_texts"], is_date_range), F.lit(1)))
    by_range = F.col("_range").isNotNull()
    return ranged.withColumns({
        "name": or_blank(d["name"]),
        "text": or_blank(d["text"]),
        "funeral_home": d["funeral_home"],
        "published": F.when(~by_range, _last_meta(d["metas"], "published")),
        "death": F.when(by_range, range_end(F.col("_range")))
        .otherwise(_last_meta(d["metas"], "death", unless="published")),
    }).drop("_d", "_range")


def merge_details(records: DataFrame, details: DataFrame) -> DataFrame:
    """Detail fields win over listing fields where present; a record without a detail
    page stays as it is. ``details`` has one row per link."""
    side = details.select(
        "url", F.struct("name", "text", "funeral_home", "published", "death").alias("_d"))
    old = {p: f"_old_{p}" for p in PARTS}
    joined = records.join(side, "url", "left").withColumnsRenamed(old)
    d, seen = F.col("_d"), F.col("_d").isNotNull()
    joined = joined.withColumn("_name", first_present(d["name"], F.col("deceased_name")))
    joined = with_split_name(joined, "_name")
    merged = {
        "deceased_name": F.col("_name"),
        "obit_text": first_present(d["text"], F.col("obit_text")),
        "published_date": F.coalesce(d["published"], "published_date"),
        "death_date": F.coalesce(d["death"], "death_date"),
        "funeral_home": F.coalesce(present(d["funeral_home"]), "funeral_home"),
        "city": or_blank(F.col("city")),
        "state": or_blank(F.col("state")),
    }
    kept = {c: F.when(seen, v).otherwise(F.col(c)) for c, v in merged.items()}
    kept |= {p: F.when(seen, F.col(p)).otherwise(F.col(o)) for p, o in old.items()}
    return joined.withColumns(kept).select(*records.columns)


def thin() -> Column:
    """Records that came without text."""
    return F.coalesce(F.col("obit_text"), F.lit("")) == ""


def enrich(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Complete records that came without text from their detail pages.

    Pages are cut down to the wanted links before they are parsed, so the parse runs only
    for unseen, thin records. ``records`` has one row per link. Of several pages of a link
    the latest by ``fetched_at`` counts, where the pages have it; then a hash decides.
    """
    wanted = records.where(thin())
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None).cast("timestamp_ntz")
    needed = pages.select("url", "html", fetched.alias("_fetched")).join(wanted.select("url"), "url", "left_semi")
    single = keep_first(needed, [F.col("url")], [F.col("_fetched").desc_nulls_last(), F.xxhash64("html")])
    return with_pages(records, single.drop("_fetched"))


def with_pages(records: DataFrame, pages: DataFrame) -> DataFrame:
    """The same from the one page (url, html) of each wanted link."""
    return merge_details(records.where(thin()), extract_details(pages.select("url", "html"))).unionByName(records.where(~thin()))
