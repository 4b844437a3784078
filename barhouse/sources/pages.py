"""Landed quote pages: rows of (symbol, date, page, content bytes)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from barhouse.functions.clean import clock_time, dotted_date, try_day_time, without_commas
from barhouse.functions.html import last_page, quote_rows
from barhouse.operators.dedup import first_per_key

# The cell each value is in.
DAY_CELLS = {"close": 1, "open": 3, "high": 4, "low": 5, "volume": 6}
MINUTE_CELLS = {"price": 1, "volume": 6}

# Page numbers listed by one row.
_BLOCK = 10_000


def decode_page(content: Column) -> Column:
    """EUC-KR, or else UTF-8 without the bytes that don't fit.

    Spark's own ``decode`` knows no EUC-KR, so this one step is vectorised
    Python. The function is local so that it travels with the job and the
    package needn't be installed on the executors.
    """

    def text_of(raw):
        if raw is None:
            return None
        try:
            return bytes(raw).decode("euc-kr")
        except UnicodeDecodeError:
            return bytes(raw).decode("utf-8", errors="ignore")

    @F.pandas_udf(StringType())
    def decoded(batch: pd.Series) -> pd.Series:
        return batch.map(text_of)

    return decoded(content)


def decode_pages(pages: DataFrame) -> DataFrame:
    """Replace ``content`` by its text, ``html``."""
    return pages.withColumn("html", decode_page(F.col("content"))).drop("content")


def _rows(pages: DataFrame) -> DataFrame:
    rows = F.posexplode(quote_rows(F.col("html"))).alias("row", "_r")
    return pages.select("symbol", "date", "page", rows).where(F.col("_r").isNotNull())


def _values(cells: dict[str, int]) -> list[Column]:
    return [without_commas(F.get(F.col("_r.cells"), i)).alias(name) for name, i in cells.items()]


def parse_day_pages(pages: DataFrame) -> DataFrame:
    """Every well-formed row of daily quote pages, values as bare text."""
    rows = _rows(pages).select(
        "symbol", "date", "page", "row", dotted_date(F.col("_r.span")).alias("row_date"), *_values(DAY_CELLS)
    )
    return rows.where(F.col("row_date").isNotNull())


def day_bars(pages: DataFrame) -> DataFrame:
    """The KR-1d row of each (symbol, date): first row of that date that traded."""
    return bars_of(parse_day_pages(pages))


def bars_of(rows: DataFrame) -> DataFrame:
    """The same from rows that are parsed already."""
    wanted = rows.where(
        (F.col("row_date") == F.col("date").cast("date")) & (F.col("open") != "0")
    )
    first = first_per_key(wanted, ["symbol", "date"], ["page", "row"])
    numbers = ["open", "high", "low", "close", "volume"]
    typed = first.select(
        "symbol", F.col("date").cast("timestamp_ntz").alias("date"), *[F.col(c).try_cast("bigint").alias(c) for c in numbers]
    )
    return typed.dropna(subset=numbers)


def parse_minute_pages(pages: DataFrame) -> DataFrame:
    """Every well-formed row of minute quote pages, values as bare text."""
    rows = _rows(pages).select(
        "symbol", "date", "page", "row", clock_time(F.col("_r.span")).alias("time"), *_values(MINUTE_CELLS)
    )
    return rows.where(F.col("time").isNotNull())


def minute_ticks(pages: DataFrame) -> DataFrame:
    """KR-1m rows: of rows with one clock time, the first in page order."""
    return ticks_of(parse_minute_pages(pages))


def ticks_of(rows: DataFrame) -> DataFrame:
    """The same from rows that are parsed already."""
    first = first_per_key(rows, ["symbol", "date", "time"], ["page", "row"])
    typed = first.select(
        "symbol",
        try_day_time(F.col("date").cast("date"), F.col("time")).alias("dt"),
        F.col("price").try_cast("bigint").alias("price"),
        F.col("volume").try_cast("bigint").alias("volume"),
    )
    return typed.dropna()


def page_rejects(rows: DataFrame) -> DataFrame:
    """Parsed page rows, of either kind, with a value that is no whole number, or of a page without a date."""
    values = [c for c in rows.columns if c in {*DAY_CELLS, *MINUTE_CELLS}]
    bad = [F.col("date").isNull(), *[F.col(c).try_cast("bigint").isNull() for c in values]]
    return rows.where(reduce(Column.__or__, bad))


def page_gaps(pages: DataFrame) -> DataFrame:
    """(symbol, date, page) of pages that should have landed but didn't.

    Page 1 tells how many there are; without it only page 1 itself is known to
    be wanted.
    """
    first_page_last = F.max(F.when(F.col("page") == 1, last_page(F.col("html"))))
    ends = pages.groupBy("symbol", "date").agg(F.greatest(F.coalesce(first_page_last, F.lit(1)), F.lit(1)).alias("_last"))
    # A page that claims very many is spread over tasks before its numbers are listed.
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("_last") - 1) / _BLOCK).cast("int"))).alias("_block")
    blocks = ends.select("symbol", "date", "_last", block).repartition("symbol", "date", "_block")
    first = F.col("_block") * _BLOCK + 1
    numbers = F.explode(F.sequence(first, F.least(first + (_BLOCK - 1), F.col("_last")))).alias("page")
    wanted = blocks.select("symbol", "date", numbers)
    landed = pages.select("symbol", "date", F.col("page").cast("int").alias("page")).distinct()
    return wanted.join(landed, ["symbol", "date", "page"], "left_anti")
