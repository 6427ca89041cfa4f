"""Person names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .text import or_blank, squeeze

# Suffixes set apart from the last name, compared without trailing dots.
SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v", "esq", "phd", "md", "dds"]

PARTS = ["first_name", "middle_name", "last_name", "name_suffix"]

_SUFFIX_AT_END = rf"(?i) ((?:{'|'.join(SUFFIXES)})\.*)$"


def with_split_name(df: DataFrame, source: str) -> DataFrame:
    """Add first, middle, last name and suffix of ``source``; absent parts are blank.

    The tidied name and the name without its suffix are steps of their own, as several
    parts are cut from them.
    """
    tidy, core = F.col("_tidy"), F.col("_core")
    steps = df.withColumn("_tidy", or_blank(squeeze(F.translate(source, ",", " ")))) \
        .withColumn("_core", F.regexp_replace(tidy, _SUFFIX_AT_END, ""))
    return steps.withColumns({
        "first_name": F.substring_index(core, " ", 1),
        "middle_name": F.regexp_extract(core, r"^[^ ]+ (.+) [^ ]+$", 1),
        "last_name": F.when(F.contains(core, F.lit(" ")), F.substring_index(core, " ", -1))
        .otherwise(""),
        "name_suffix": F.regexp_extract(tidy, _SUFFIX_AT_END, 1),
    }).drop("_tidy", "_core")
