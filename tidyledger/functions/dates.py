"""Dates: lenient parsing of mixed formats, canonical text, month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# White space that may surround a date or a number (fixed values): tab, line
# feed, vertical tab, form feed, carriage return, space. No-break and other
# Unicode spaces do not count.
ASCII_SPACES = "\t\n\x0b\x0c\r "
BLANKS = r"[\t-\r ]*+"

# Accepted shapes after dots became dashes (fixed values). \z and not $, which
# would also match before a final line break.
YEAR_FIRST = rf"^{BLANKS}\d{{1,4}}-\d{{1,2}}-\d{{1,2}}{BLANKS}\z"
DAY_FIRST = rf"^{BLANKS}(\d{{1,2}})-(\d{{1,2}})-(\d{{1,4}}){BLANKS}\z"


def _calendar_day(year_month_day: Column) -> Column:
    """The day as DATE, or NULL where the calendar has no such day.

    A year has four to seven digits in a cast, hence the zeros in front.
    """
    return F.concat(F.lit("000"), year_month_day).try_cast("date")


def parse_date(text: Column) -> Column:
    """DATE from year-first or day-first text with dashes or dots.

    Year-first is tried before day-first, so ``12-05-24`` is 24 May of year 12.
    Days and months have one or two digits and years one to four. Anything
    else, other separators included, is NULL.
    """
    dashed = F.replace(text, F.lit("."), F.lit("-"))
    day_last = F.ltrim(dashed, F.lit(ASCII_SPACES))
    day_first = F.regexp_replace(dashed, DAY_FIRST, "$3-$2-$1")
    return F.coalesce(
        F.when(dashed.rlike(YEAR_FIRST), _calendar_day(day_last)),
        F.when(dashed.rlike(DAY_FIRST), _calendar_day(day_first)),
    )


def parse_timestamp(value: Column, source: DataType = StringType()) -> Column:
    """The day as a TIMESTAMP without time zone (midnight), from text or a date type.

    A ``source`` that is neither text nor a date nor a timestamp is an error: its
    text would match no format and every order would be dropped.
    """
    if isinstance(source, (DateType, TimestampType, TimestampNTZType)):
        return value.cast("date").cast("timestamp_ntz")
    if not isinstance(source, StringType):
        raise ValueError(f"the column date has the type {source.simpleString()}, not text or a date")
    return parse_date(value).cast("timestamp_ntz")


def canonical_date(moment: Column) -> Column:
    """Day-first text ``DD-MM-YYYY``."""
    return F.date_format(moment.cast("date"), "dd-MM-yyyy")


def month_key(canonical: Column) -> Column:
    """``YYYY-MM`` of a canonical ``DD-MM-YYYY`` text.

    The text has fixed places, so no date parsing is needed. There are fewer
    than 120,000 different months (four-digit years), which bounds every table
    that has one row per month.
    """
    return F.concat(F.substring(canonical, 7, 4), F.lit("-"), F.substring(canonical, 4, 2))
