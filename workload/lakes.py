"""Stored forms of the views that queries read: day files, tiers, pages.

A lake that no query changes is written once per session and table set.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse import write_days, write_text_days
from barhouse.session import scratch_dir
from workload import views as v

_BUILT: dict[tuple[str, str, str], str] = {}


def shared(spark: SparkSession, sf: str, name: str, build: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _BUILT:
        root = scratch_dir(spark, name)
        build(root)
        _BUILT[key] = root
    return _BUILT[key]


def tick_days(spark: SparkSession, sf: str) -> str:
    return shared(spark, sf, "tick-days", lambda r: write_days(v.ticks(spark, sf), "KR-1m", r))


def bar_months(spark: SparkSession, sf: str) -> str:
    return shared(spark, sf, "bar-months", lambda r: write_days(v.bars(spark, sf), "KR-1d", r, grain="month"))


def us_years(spark: SparkSession, sf: str) -> str:
    return shared(spark, sf, "us-years", lambda r: write_days(v.us_ticks(spark, sf), "US-5m", r, grain="year"))


def mixed_bars(spark: SparkSession, sf: str) -> str:
    """Bars to 1999 as years, 2000 as months, from 2001 as days."""

    def build(root: str) -> None:
        bars, year = v.bars(spark, sf), F.year("date")
        write_days(bars.where(year <= 1999), "KR-1d", root, grain="year")
        write_days(bars.where(year == 2000), "KR-1d", root, grain="month")
        write_days(bars.where(year >= 2001), "KR-1d", root, grain="day")

    return shared(spark, sf, "mixed-bars", build)


def bar_text(spark: SparkSession, sf: str) -> str:
    """Every bar twice, as text day files."""
    return shared(spark, sf, "bar-text", lambda r: write_text_days(_twice(v.bars(spark, sf)), "KR-1d", r))


def tick_text(spark: SparkSession, sf: str) -> str:
    return shared(spark, sf, "tick-text", lambda r: write_text_days(_twice(v.ticks(spark, sf)), "KR-1m", r))


def us_text(spark: SparkSession, sf: str) -> str:
    """US ticks with fractional volumes, every eighth volume left blank."""

    def build(root: str) -> None:
        raw = v.us_raw(spark, sf)
        blank = F.pmod(F.floor("price").cast("bigint"), F.lit(8)) == 0
        write_text_days(raw.withColumn("volume", F.when(~blank, F.col("volume"))), "US-5m", root)

    return shared(spark, sf, "us-text", build)


def _twice(df: DataFrame) -> DataFrame:
    return df.unionAll(df)

