"""Rows of symbols between two moments, in time order, over any tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse.datasets import KR_1D, KR_1M, US_5M, Dataset, dataset
from barhouse.functions.routing import route, time_bounds
from barhouse.operators.dedup import drop_copies
from barhouse.operators.symbols import restrict_to_symbols
from barhouse.sources.periods import list_periods, manifest_of, read_periods, resolve_tiers

Symbols = str | list[str] | DataFrame


def read_range(
    spark: SparkSession,
    which: str | Dataset,
    root: str,
    start: str,
    end: str | None = None,
    *,
    policy: str = "coarsest",
    ignore_corrupt: bool = False,
) -> DataFrame:
    """All rows with start <= time <= end, unordered.

    Only the chosen period folders are opened, and the bounds are pushed into
    their Parquet scans. No stored period gives an empty table.
    """
    ds = dataset(which)
    bounds = time_bounds(start, end, ds.intraday)
    found = list_periods(spark, root, range(bounds.start.year, bounds.end.year + 1))
    tiers = resolve_tiers(manifest_of(spark, found), bounds.first_day, bounds.last_day, policy)
    paths = [row.path for row in tiers.select("path").collect()] if found else []
    rows = read_periods(spark, ds, root, paths, bounds, ignore_corrupt).select(*ds.columns)
    return drop_copies(rows) if policy == "union" else rows


def extract(
    spark: SparkSession,
    which: str | Dataset,
    root: str,
    symbols: Symbols,
    start: str,
    end: str | None = None,
    **options,
) -> DataFrame:
    """Rows of one or many symbols between two moments, in time order.

    Symbols given by name are upper-cased; stored ones are taken as they are.
    Equal times are ordered by the other columns.
    """
    ds = dataset(which)
    if isinstance(symbols, str):
        symbols = [symbols]
    if isinstance(symbols, list):
        symbols = [s.upper() for s in symbols]
    rows = restrict_to_symbols(read_range(spark, ds, root, start, end, **options), symbols)
    return rows.orderBy(ds.time, "symbol", *[F.col(c) for c in ds.values])


def extract_day(spark: SparkSession, root: str, symbols: Symbols, start: str, end: str | None = None, **options):
    return extract(spark, KR_1D, root, symbols, start, end, **options)


def extract_minute(spark: SparkSession, root: str, symbols: Symbols, start: str, end: str | None = None, **options):
    return extract(spark, KR_1M, root, symbols, start, end, **options)


def extract_us(spark: SparkSession, root: str, symbols: Symbols, start: str, end: str | None = None, **options):
    return extract(spark, US_5M, root, symbols, start, end, **options)


def query(
    spark: SparkSession,
    lake: str,
    kind: str,
    symbol: str,
    start: str,
    end: str | None = None,
    *,
    market: str | None = None,
    **options,
) -> DataFrame:
    """``day`` or ``min`` rows of a symbol, its market told from its name.

    ``lake`` holds one folder per dataset. ``market`` overrides the routing.
    """
    ds = route(kind, symbol, market)
    return extract(spark, ds, f"{lake}/{ds.name}", symbol, start, end, **options)
