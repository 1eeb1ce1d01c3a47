"""Expressions that turn dirty text into typed values.

Nothing here raises on bad input: a value that cannot be read becomes NULL,
whether ``spark.sql.ansi.enabled`` is on or off.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The shapes of the incoming text.
FILLER = "_"
INTEGER_TEXT = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
SSN_TEXT = r"^\d{3}-\d{2}-\d{4}$"
YEARS_TEXT = r"(\d+) Years"
MONTHS_TEXT = r"(\d+) Months"
LIST_AND = r",\s*and\s*"
LIST_COMMA = r",\s*"


def strip_filler(c: Column, filler: str = FILLER) -> Column:
    """Remove every filler character from the text."""
    return F.translate(c.cast("string"), filler, "")


def lenient_float(c: Column, strip: bool = True) -> Column:
    """Text to float; with ``strip`` the filler goes first, otherwise it spoils the value."""
    return (strip_filler(c) if strip else c).try_cast("float")


def lenient_int(c: Column, strip: bool = True) -> Column:
    """Text to int, truncating a decimal part: ``"12.7_"`` gives 12, ``"abc"`` NULL."""
    text = strip_filler(c) if strip else c.cast("string")
    return F.regexp_extract(text, INTEGER_TEXT, 1).try_cast("int")


def negative_to_null(c: Column) -> Column:
    return F.when(c >= 0, c)


def normalise_key(c: Column) -> Column:
    return F.trim(F.lower(c))


def replace_sentinel(c: Column, sentinel: str, replacement: str) -> Column:
    return F.when(c == sentinel, F.lit(replacement)).otherwise(c)


def capture_int(c: Column, pattern: str) -> Column:
    """First capture group as int; no match gives NULL."""
    return F.regexp_extract(c, pattern, 1).try_cast("int")


def keep_valid(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


def split_list(c: Column) -> Column:
    """``"A, B, and C"`` to its items. ``"A and B"`` without a comma is one item."""
    return F.split(F.regexp_replace(c, LIST_AND, ","), LIST_COMMA)


def list_items(c: Column) -> Column:
    """The items of ``split_list`` in order, without repeats and empty ones."""
    return F.filter(F.array_distinct(split_list(c)), lambda item: item != "")


def ordinal(c: Column, codes: Mapping[str, int]) -> Column:
    """Code of a category; a category that is not listed becomes NULL."""
    return F.coalesce(*(F.when(c == category, F.lit(code)) for category, code in codes.items()))


def split_part(c: Column, index: int, delimiter: str = "_") -> Column:
    """0-based part of delimited text, NULL when there are fewer parts."""
    return F.get(F.split(c, delimiter), F.lit(index))
