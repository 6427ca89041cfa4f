"""Text primitives as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The characters treated as whitespace, and the same as a regex class body.
SPACE_CHARS = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
SPACES = "".join(rf"\x{{{ord(c):x}}}" for c in SPACE_CHARS)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def strip_long(c: Column) -> Column:
    """``strip`` of a long text, which is copied only if there is something to cut off. ``c`` is referred
    to often and should be a lambda's variable."""
    return F.when(reduce(or_, [c.startswith(s) | c.endswith(s) for s in SPACE_CHARS]), strip(c)).otherwise(c)


def squeeze(c: Column) -> Column:
    """Whitespace runs to one blank, ends trimmed."""
    return F.btrim(F.regexp_replace(c, f"[{SPACES}]+", " "))


def present(c: Column) -> Column:
    """Blank strings count as missing."""
    return F.nullif(c, F.lit(""))


def present_once(c: Column) -> Column:
    """``present`` of a costly value: inside a condition, ``nullif`` would compute it twice."""
    return F.get(F.filter(F.array(c), lambda v: v != ""), F.lit(0))


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor blank; blank when there is none."""
    return F.coalesce(*[present(c) for c in cols], F.lit(""))


def ci_key(c: Column, accent: bool = False) -> Column:
    """Comparison key of a text column: ignores case, with ``accent`` also accents."""
    if accent:
        return F.collate(c, "UNICODE_CI_AI")
    return F.lower(c)
