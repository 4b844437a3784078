"""Which market a symbol belongs to, and the time bounds of a request."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, functions as F

from barhouse.datasets import KR_1D, KR_1M, US_5M, Dataset


def market_of(symbol: Column) -> Column:
    """KR for symbols that are all digits apart from dots and dashes, else US."""
    bare = F.regexp_replace(symbol, "[.-]", "")
    return F.when(bare.rlike("^[0-9]+$"), F.lit("KR")).otherwise(F.lit("US"))


def market_of_text(symbol: str) -> str:
    bare = symbol.replace(".", "").replace("-", "")
    return "KR" if bare.isascii() and bare.isdigit() else "US"


def route(kind: str, symbol: str, market: str | None = None) -> Dataset:
    """The dataset that answers a ``day`` or ``min`` request for a symbol."""
    where = market or market_of_text(symbol)
    if kind == "day":
        if where == "KR":
            return KR_1D
        raise ValueError(f"no daily data for US symbol {symbol!r}")
    if kind == "min":
        return KR_1M if where == "KR" else US_5M
    raise ValueError(f"unknown kind {kind!r}")


@dataclass(frozen=True)
class TimeBounds:
    """Both ends inclusive; the days decide which periods are opened."""

    start: datetime
    end: datetime

    @property
    def first_day(self) -> str:
        return self.start.date().isoformat()

    @property
    def last_day(self) -> str:
        return self.end.date().isoformat()

    def holds(self, column: Column) -> Column:
        return column.between(_ntz(self.start), _ntz(self.end))


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def time_bounds(start: str, end: str | None, intraday: bool) -> TimeBounds:
    """Read a request's ends.

    A bare end date reaches to 23:59:59 for intraday data and stays midnight
    for daily data; an end with a clock time is used as given.
    """
    end = end or start
    if intraday and " " not in end and ":" not in end:
        end = f"{end} 23:59:59"
    return TimeBounds(datetime.fromisoformat(start), datetime.fromisoformat(end))
