"""Record links and listing addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import or_blank, strip


def absolutise(c: Column, base_url: str) -> Column:
    """Site-relative links become absolute; blank and absolute ones stay."""
    return F.when((c == "") | c.startswith("http"), c).otherwise(F.concat(F.lit(base_url), c))


def with_listing_url(markets: DataFrame, base_url: str) -> DataFrame:
    """Add ``listing_url``, or ``error`` where state or slug is absent.

    Presence is checked before trimming, so a padded blank passes.
    """
    state, slug = or_blank(F.col("state")), or_blank(F.col("legacy_slug"))
    usable = (state != "") & (slug != "")
    address = F.concat_ws("/", F.lit(base_url), F.lower(strip(state)), F.lower(strip(slug)))
    return markets.withColumns({
        "listing_url": F.when(usable, address),
        "error": F.when(~usable, F.lit("ValueError: market needs 'state' and 'legacy_slug'")),
    })
