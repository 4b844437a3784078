"""Scalar cleaning expressions. All are JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The US ticker suffix, and where the six-character short code
# sits in an ISIN (1-based start, length).
US_SUFFIX = r"\.US$"
SHORT_CODE = (4, 6)

# Blanks beyond ASCII white space (no-break and full-width
# space), and the character that stands in for bytes that aren't UTF-8.
BLANKS = chr(0xA0) + chr(0x3000)
NOT_UTF8 = chr(0xFFFD)

_EDGES = " \t\n\r\f\v" + BLANKS


def strip(text: Column) -> Column:
    """Trim white space, non-breaking and full-width blanks included."""
    return F.btrim(text, F.lit(_EDGES))


def without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def comma_int(text: Column) -> Column:
    """``1,234`` to 1234; NULL where it isn't a whole number."""
    return without_commas(strip(text)).try_cast("bigint")


def dotted_date(text: Column) -> Column:
    """``2023.12.20`` (or with dashes) to a date; NULL where it isn't one."""
    iso = F.replace(strip(text), F.lit("."), F.lit("-"))
    return F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso.try_cast("date"))


def clock_time(text: Column) -> Column:
    """The first HH:MM in a noisy cell; NULL where there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d{2}:\d{2})", 1), F.lit(""))


def day_time(day: Column, time: Column) -> Column:
    """A day and a clock time as a naive timestamp."""
    return F.concat_ws(" ", day.cast("string"), time).cast("timestamp_ntz")


def try_day_time(day: Column, time: Column) -> Column:
    return F.concat_ws(" ", day.cast("string"), time).try_cast("timestamp_ntz")


def packed_timestamp(day: Column, time: Column) -> Column:
    """``20211012`` and ``153000`` as a naive timestamp; NULL if malformed."""
    part = lambda c, at: F.substring(c, at, 2)
    text = F.concat(
        F.substring(day, 1, 4), F.lit("-"), part(day, 5), F.lit("-"), part(day, 7),
        F.lit(" "), part(time, 1), F.lit(":"), part(time, 3), F.lit(":"), part(time, 5),
    )
    shaped = (F.length(day) == 8) & (F.length(time) == 6)
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def ticker_symbol(ticker: Column) -> Column:
    """Drop the upper-case US suffix; anything else stays as it is."""
    return F.regexp_replace(ticker, US_SUFFIX, "")


def whole_volume(volume: Column) -> Column:
    """Missing volume is 0; fractions round half to even."""
    return F.bround(F.coalesce(volume, F.lit(0.0)), 0).cast("bigint")


def short_code(isin: Column) -> Column:
    return F.substring(isin, *SHORT_CODE)


def without_bad_bytes(text: Column) -> Column:
    """Leave out what a reader put in for bytes that aren't UTF-8."""
    return F.replace(text, F.lit(NOT_UTF8), F.lit(""))


def file_day(file_name: Column) -> Column:
    """The day in a ``YYYY-MM-DD.txt`` file name."""
    return F.substring(file_name, 1, 10)
