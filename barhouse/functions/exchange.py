"""Source-clock (Warsaw) to exchange-clock (New York) time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The usual distance in hours, and the one that holds while only
# one of the two regions is on summer time.
USUAL_HOURS = 6
SPLIT_HOURS = 5
SOURCE_ZONE = "Europe/Warsaw"
EXCHANGE_ZONE = "America/New_York"


def _sunday_from(year: Column, month: int, day: int) -> Column:
    """The first Sunday on or after the given day of the year."""
    return F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(day)), 1), "SUN")


def exchange_hours(day: Column) -> Column:
    """Hours between the two clocks, decided by the calendar day.

    Summer time starts on March's second Sunday in the US and its last Sunday
    in Europe; it ends on October's last Sunday in Europe and November's first
    in the US. A month's last Sunday is the one on or after day 25 of its 31.
    """
    d = day.cast("date")
    y = F.year(d)
    us_start, eu_start = _sunday_from(y, 3, 8), _sunday_from(y, 3, 25)
    eu_end, us_end = _sunday_from(y, 10, 25), _sunday_from(y, 11, 1)
    split = ((d >= us_start) & (d < eu_start)) | ((d >= eu_end) & (d < us_end))
    return F.when(split, F.lit(SPLIT_HOURS)).otherwise(F.lit(USUAL_HOURS))


def exchange_time(ts: Column, mode: str = "rule") -> Column:
    """Shift a naive source timestamp to the exchange's clock.

    ``rule`` decides the distance by calendar day; ``zone`` uses the time-zone
    database, which differs before the switch hour on the four switch days and
    is right for years under older rules.
    """
    if mode == "zone":
        return F.convert_timezone(F.lit(SOURCE_ZONE), F.lit(EXCHANGE_ZONE), ts)
    if mode != "rule":
        raise ValueError(f"unknown mode {mode!r}")
    hours = exchange_hours(ts)
    return (ts - F.make_dt_interval(F.lit(0), hours)).cast("timestamp_ntz")
