"""Dates in fields and in running text, as Column expressions.

Every candidate goes through one narrow chain: cut the date out of the first match of a
phrase, rewrite it as year-month-day, parse it. Each step refers to the one before it
once, so no text is searched twice, and ``coalesce`` stops at the first real date.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .text import SPACES, bind, present_once, strip

# Flags: ignore case also outside ASCII; a dot stops at line feeds only.
_FLAGS = "(?iud)"
_WS = f"[{SPACES}]"
_NWS = f"[^{SPACES}]"
_WORD = r"[\p{L}\p{N}_]"
_WORD_OR_WS = rf"[\p{{L}}\p{{N}}_{SPACES}]"
_DIGIT = "[0-9]"

# Month names and short forms accepted in text.
_MONTH = (
    "(?:January|February|March|April|May|June|July|August|September|October|November|December"
    r"|Jan\.?|Feb\.?|Mar\.?|Apr\.?|Jun\.?|Jul\.?|Aug\.?|Sep(?:t)?\.?|Oct\.?|Nov\.?|Dec\.?)"
)
_WEEKDAY = (
    "(?:(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
    rf",?{_WS}+)?"
)
# The date of a phrase is its only group.
_LONG = rf"({_MONTH}{_WS}+{_DIGIT}{{1,2}}(?:st|nd|rd|th)?,?{_WS}+{_DIGIT}{{4}})"
_SLASHED = rf"({_DIGIT}{{1,2}}/{_DIGIT}{{1,2}}/{_DIGIT}{{4}})"
_ON = rf"(?:on{_WS}+)?"
# Any words, as few as possible. One character loop instead of a repeated group, which
# would recurse once per word in the JVM's matcher and overflow its stack on long runs.
_WORDS = rf"(?:{_WORD}{_WORD_OR_WS}*?{_WS})??"

_PASSED, _WENT, _ENTERED, _DIED, _DEATH, _DASH, _BORN = (
    "PASSED", "WENT", "ENTERED", "DIED", "DEATH", "DASH", "BORN",
)

# Phrase patterns in order of precedence, as (label, trigger, date form, regex).
DEATH_PATTERNS = [
    ("a", _PASSED, "long", rf"passed{_WS}+away{_WS}+{_WORDS}{_ON}{_WEEKDAY}{_LONG}"),
    ("b", _PASSED, "long",
     rf"passed{_WS}+(?:peacefully|quietly|suddenly|unexpectedly){_WS}+{_ON}{_WEEKDAY}{_LONG}"),
    ("c", _PASSED, "long",
     rf"passed{_WS}+on{_WS}+(?:to{_WS}+{_NWS}+{_WS}+{_NWS}+{_WS}+{_NWS}+{_WS}+)?"
     rf"{_ON}{_WEEKDAY}{_LONG}"),
    ("d", _PASSED, "long", rf"passed{_WS}+from{_WS}+.{{1,40}}?{_WS}+{_ON}{_WEEKDAY}{_LONG}"),
    ("e", _WENT, "long",
     rf"went{_WS}+(?:home{_WS}+)?to{_WS}+be{_WS}+with{_WS}+.{{1,40}}?{_WS}+{_ON}{_WEEKDAY}{_LONG}"),
    ("f", _ENTERED, "long",
     rf"entered{_WS}+(?:eternal{_WS}+|into{_WS}+)?rest{_WS}+{_ON}{_WEEKDAY}{_LONG}"),
    ("g", _DIED, "long", rf"died{_WS}+{_ON}{_WEEKDAY}{_LONG}"),
    ("h", _DEATH, "long", rf"death{_WS}+{_ON}{_LONG}"),
    ("i", _DASH, "long", rf"[-–—]{_WS}*{_LONG}"),
    ("j", _PASSED, "slashed", rf"passed{_WS}+away{_WS}+{_WORDS}{_SLASHED}"),
    ("k", _DIED, "slashed", rf"died{_WS}+{_ON}{_SLASHED}"),
]
BIRTH_PATTERNS = [
    ("l", _BORN, "long", rf"born{_WS}+(?:to{_WS}+.{{1,80}}?{_WS}+on{_WS}+)?{_LONG}"),
    ("m", _BORN, "long", rf"born{_WS}+(?:on{_WS}+|in{_WS}+)?{_LONG}"),
    ("n", _BORN, "slashed", rf"born{_WS}+{_ON}{_SLASHED}"),
]

# Decimal digits of other scripts, derived from the character database.
_OTHER_DIGITS = [
    chr(i) for i in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"
]
_DIGITS_FROM = "".join(_OTHER_DIGITS)
_DIGITS_TO = "".join(str(unicodedata.digit(c)) for c in _OTHER_DIGITS)

_SHORT_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_NOT_YEAR_ZERO = "(?!0000)"
_LONG_PARTS = (
    rf"(?i)^([a-z]{{3}})[a-z]*\.?{_WS}+([0-9]{{1,2}})(?:st|nd|rd|th)?,?{_WS}+"
    rf"{_NOT_YEAR_ZERO}([0-9]{{4}})$"
)
_SLASHED_PARTS = rf"^([0-9]{{1,2}})/([0-9]{{1,2}})/{_NOT_YEAR_ZERO}([0-9]{{4}})$"


def _numbered_date(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("")).try_cast("date")


def _named_date(c: Column) -> Column:
    """Date of ``2026-Mar-4``. A cast tells a wrong date by null, without the exception
    and its cost that parsing by a date pattern has."""
    number = F.lower(c)
    for i, name in enumerate(_SHORT_MONTHS, start=1):
        number = F.replace(number, F.lit(name), F.lit(str(i)))
    return _numbered_date(number)


def _first_group(text: Column, pattern: str) -> Column:
    """Group of the first match; null without a match, which ends the chain."""
    return present_once(F.regexp_extract(text, _FLAGS + pattern, 1))


def _dated(text: Column, form: str, pattern: str) -> Column:
    """Date of the first match of ``pattern``; null when absent or not a real date."""
    piece = _first_group(text, pattern)
    if form == "long":
        return _named_date(F.regexp_replace(piece, _LONG_PARTS, "$3-$1-$2"))
    return _numbered_date(F.regexp_replace(piece, _SLASHED_PARTS, "$3-$1-$2"))


def _by_precedence(text: Column, triggers: dict[str, Column], patterns, wrap) -> Column:
    return F.coalesce(*[
        F.when(triggers[trigger], wrap(label, _dated(text, form, pattern)))
        for label, trigger, form, pattern in patterns
    ])


def _plain(_label: str, date: Column) -> Column:
    return date


def _labelled(label: str, date: Column) -> Column:
    return F.concat(F.lit(label), date.cast("string"))


def _prepared(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """The text with plain digits as ``_plain``, and flags for the words a pattern cannot
    match without: substring tests are far cheaper than regex searches and most text has
    none of the words."""
    beyond_ascii = F.octet_length(text) != F.char_length(text)
    plain = F.when(beyond_ascii & F.col(text).rlike(r"[\p{Nd}&&[^0-9]]"),
                   F.translate(text, _DIGITS_FROM, _DIGITS_TO)).otherwise(F.col(text))
    words = {w: f"_has_{w}" for w in (_PASSED, _WENT, _ENTERED, _DIED, _DEATH, _BORN)}
    flags = {name: F.contains(F.col("_upper"), F.lit(word)) for word, name in words.items()}
    flags[f"_has_{_DASH}"] = reduce(or_, [F.contains(text, F.lit(d)) for d in "-–—"])
    out = df.withColumns({"_plain": plain, "_upper": F.upper(text)}).withColumns(flags)
    return out.drop("_upper"), {w: F.col(f"_has_{w}") for w in [*words, _DASH]}


def _found(df: DataFrame, text: str, death: str, birth: str, wrap) -> DataFrame:
    ready, triggers = _prepared(df, text)
    return ready.withColumns({
        death: _by_precedence(F.col("_plain"), triggers, DEATH_PATTERNS, wrap),
        birth: _by_precedence(F.col("_plain"), triggers, BIRTH_PATTERNS, wrap),
    }).drop("_plain", *[f"_has_{w}" for w in triggers])


def with_dates_from_text(
    df: DataFrame, text: str, death: str = "death_date", birth: str = "birth_date",
) -> DataFrame:
    """Add the death and birth date found in ``text``.

    Per pattern only the first match counts; if that is no real date the next pattern is
    tried.
    """
    return _found(df, text, death, birth, _plain)


def with_deciding_patterns(df: DataFrame, text: str) -> DataFrame:
    """Add the labels of the patterns the death and birth dates come from."""
    labelled = _found(df, text, "death_pattern", "birth_pattern", _labelled)
    return labelled.withColumns({
        c: F.left(F.col(c), F.lit(1)) for c in ("death_pattern", "birth_pattern")})


# --- date fields -------------------------------------------------------------------------

_M = r"(1[0-2]|0?[1-9])"
_D = r"(3[01]|[12][0-9]|0?[1-9]| [1-9])"
_Y = rf"{_NOT_YEAR_ZERO}([0-9]{{4}})"
_CLOCK = r"T(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:(?:6[01]|[0-5]?[0-9])"

# Accepted field forms. ISO date with optional clock, month names full or
# short (short ones may carry a dot), numeric month first with slashes or hyphens.
_ISO = rf"(?i)^{_Y}-{_M}-{_D}(?:{_CLOCK}(?:Z|\.[0-9]{{1,6}})?)?$"
_MONTH_FIRST = (
    "(?i)^(?:(Jan)(?:uary|\\.)?|(Feb)(?:ruary|\\.)?|(Mar)(?:ch|\\.)?|(Apr)(?:il|\\.)?|(May)\\.?"
    "|(Jun)(?:e|\\.)?|(Jul)(?:y|\\.)?|(Aug)(?:ust|\\.)?|(Sep)(?:tember|\\.)?|(Oct)(?:ober|\\.)?"
    "|(Nov)(?:ember|\\.)?|(Dec)(?:ember|\\.)?)"
    rf"{_WS}+{_D},{_WS}+{_Y}$"
)
_NUMERIC = rf"^{_M}([/-]){_D}\2{_Y}$"


def _field_date(value: Column) -> Column:
    """Date of a trimmed value."""
    months = "".join(f"${i}" for i in range(1, 13))
    return F.coalesce(
        F.when(value.rlike(_ISO),
               _numbered_date(F.regexp_replace(value, _ISO, "$1-$2-$3"))),
        F.when(value.rlike(_MONTH_FIRST),
               _named_date(F.regexp_replace(value, _MONTH_FIRST, f"$14-{months}-$13"))),
        F.when(value.rlike(_NUMERIC),
               _numbered_date(F.regexp_replace(value, _NUMERIC, "$4-$1-$3"))),
    )


def parse_date(c: Column) -> Column:
    """Date of a field value in one of the accepted forms, else null."""
    trimmed = F.regexp_replace(strip(c), f"(?i)^on [{SPACES}]*", "")
    return bind(trimmed, _field_date)


# Range separators, in order of precedence.
RANGE_SEPARATORS = [" - ", " — ", " – ", " to "]


def is_date_range(c: Column) -> Column:
    hit = F.lit(False)
    for sep in RANGE_SEPARATORS:
        hit = hit | F.contains(c, F.lit(sep))
    return F.coalesce(hit, F.lit(False))


def range_end(c: Column) -> Column:
    """Date after the first occurrence of the first separator present, else null."""
    tail = F.lit(None).cast("string")
    for sep in reversed(RANGE_SEPARATORS):
        start = F.locate(sep, c)
        tail = F.when(start > 0, F.substring(c, start + F.lit(len(sep)), F.lit(2147483647))) \
            .otherwise(tail)
    return parse_date(tail)
