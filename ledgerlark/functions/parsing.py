"""Tolerant parsing of raw strings; anything unreadable becomes NULL.

Two spellings of a point in time are read: year first (``2024-12-20 10:00:00``, dashes
or slashes, time optional) and day first with dashes (``20-12-2024 10:00:00``). A day
first value with slashes is unreadable on purpose. Patterns gate the casts because
Spark's own casts also take partial values such as ``2024-12``. Each spelling is rewritten
to year-first text and cast once, so no formatter ever throws and catches per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns take slashes for dashes. The usual spelling comes first, without loops or choices: most values take
# this way, and the general one, which it is a part of, is the slow one.
DASH = "[-/]"
CLOCK = rf"[ T]\d{{1,2}}:\d{{1,2}}(?::\d{{1,2}}(?:\.\d+)?)?(?:Z|[+/-]\d{{2}}:?\d{{2}})?\s*"
USUAL = rf"\d\d\d\d{DASH}\d\d{DASH}\d\d(?: \d\d:\d\d:\d\d)?"
YEAR_FIRST = rf"^(?:{USUAL}|\d{{4,6}}{DASH}\d{{1,2}}{DASH}\d{{1,2}}(?:{CLOCK})?)$"
SHORT_YEAR_FIRST = rf"^\d{{1,3}}{DASH}\d{{1,2}}{DASH}\d{{1,2}}(?:{CLOCK})?$"
DAY_FIRST = r"\s*(\d{1,2})-(\d{1,2})-(\d{4})\s*"
DAY_FIRST_TIME = r"\s*(\d{1,2})-(\d{1,2})-(\d{4})\s+(\d{1,2}:\d{1,2}:\d{1,2})\s*"
NUMBER = r"(?i)^(?:\d+\.\d+|\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\s*)$"


def dashed(c: Column) -> Column:
    """Slashes to dashes."""
    return F.replace(c, F.lit("/"), F.lit("-"))


def _year_first(text: Column) -> Column:
    """The text with dashes if it is year first. A year of one to three digits is taken as it stands."""
    return F.when(text.rlike(YEAR_FIRST), dashed(text)).when(
        text.rlike(SHORT_YEAR_FIRST), F.concat(F.lit("000"), dashed(text))
    )


def _swapped(c: Column, day_first: str, parts: str) -> Column:
    """Day-first text put year first. Of any other text dashes are left, which are no date."""
    return F.regexp_replace(c, rf"(?s)^(?:{day_first}$|.*)", parts)


def iso_timestamp(c: Column) -> Column:
    """Year-first text to a timestamp."""
    return _year_first(c).try_cast("timestamp_ntz")


def parse_timestamp(c: Column) -> Column:
    """Year-first or day-first text (the latter with a time) to a timestamp."""
    swapped = _swapped(c, DAY_FIRST_TIME, "$3-$2-$1 $4")
    return _year_first(c).otherwise(swapped).try_cast("timestamp_ntz")


def parse_date(c: Column) -> Column:
    """Year-first text, with or without a time, or day-first text without one, to a date."""
    swapped = _swapped(c, DAY_FIRST, "$3-$2-$1")
    return _year_first(F.trim(c)).otherwise(swapped).try_cast("timestamp_ntz").cast("date")


def parse_double(c: Column) -> Column:
    return F.when(c.rlike(NUMBER), F.trim(c)).try_cast("double")


def parse_int(c: Column) -> Column:
    """Whole number; decimals are rounded."""
    return F.round(parse_double(c)).try_cast("int")


PARSERS = {
    "string": lambda c: c,
    "timestamp_ntz": parse_timestamp,
    "date": parse_date,
    "double": parse_double,
    "int": parse_int,
}
