"""Dates: lenient parsing, keys and calendar parts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns tried for date text, first match wins; then Spark's own parsing.
DATE_PATTERNS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
]
# Parts of a column name that mark date text, and endings that rule it out.
DATE_NAME_PARTS = ("date", "time", "datetime", "created", "modified", "updated", "birth", "hire",
                   "shipped", "required")
NOT_DATE_ENDINGS = ("id", "key")
# Fixed value: date text written by the merge.
DATE_TEXT = "yyyy-MM-dd HH:mm:ss"


_SAYS_DATE = re.compile(rf"({'|'.join(DATE_NAME_PARTS)}).*(?<!{NOT_DATE_ENDINGS[0]})(?<!{NOT_DATE_ENDINGS[1]})$", re.I | re.S)


def date_texts(schema: T.StructType) -> list[str]:
    """P10: text columns whose name says date. Typed dates need no parsing and are not listed."""
    return [f.name for f in schema if f.dataType == T.StringType() and _SAYS_DATE.search(f.name)]


def parse_timestamp(text: Column) -> Column:
    """Text in any known pattern to a timestamp; anything else is null, never an error."""
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in DATE_PATTERNS]
    return F.coalesce(*tries, F.try_to_timestamp(text))


def as_date(value: Column) -> Column:
    """The calendar day of a date, timestamp or ISO text; null where there is none."""
    return value.try_cast("date")


def date_key(day: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than through text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def us_week(day: Column) -> Column:
    """X11: week number where week 1 holds 1 January and weeks start on Sunday."""
    new_year = F.trunc(day, "year")
    return F.ceil((F.dayofyear(day) + F.dayofweek(new_year) - 1) / 7).cast("int")
