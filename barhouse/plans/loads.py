"""Bulk and daily loads into stored days."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barhouse.datasets import KR_1D, KR_1M, US_5M, Dataset
from barhouse.operators.reports import load_summary
from barhouse.plans.extract import read_range
from barhouse.plans.writers import with_period, write_rows
from barhouse.sources.pages import bars_of, decode_pages, page_rejects, parse_day_pages, parse_minute_pages, ticks_of
from barhouse.sources.ticker_csv import VERDICTS, parse_ticker_fields, read_ticker_fields


def load_ticker_csv(
    spark: SparkSession, source: str, root: str, earliest: str | None = None, mode: str = "rule"
) -> DataFrame:
    """Load a bulk dump into US-5m days; returns (verdict, lines) counts.

    Every row goes to the day and year of its own exchange time. The dump is
    parsed once: verdicts are counted on the way to the writer. A task that is run
    again after a lost executor would count twice, so the counts are held against the
    rows that were written, and made afresh from the dump if they don't agree.
    """
    parsed = parse_ticker_fields(read_ticker_fields(spark, source), earliest, mode)
    counted, written = Observation(), Observation()
    of = F.col("verdict")
    good = parsed.observe(counted, *[F.count_if(of == v).alias(v) for v in VERDICTS]).where(of == "ok")
    write_rows(with_period(good, US_5M, "day"), US_5M, root, layout="rebalance", observation=written)
    if counted.get["ok"] != written.get["rows"]:
        return parsed.groupBy("verdict").agg(F.count(F.lit(1)).alias("lines"))
    lines = [(v, counted.get[v]) for v in VERDICTS if counted.get[v]]
    return spark.createDataFrame(lines, "verdict string, lines bigint")


def load_day_pages(pages: DataFrame, root: str) -> DataFrame:
    """Load landed daily quote pages into KR-1d days; returns the load summary and, per day, the rows rejected.

    Rows of pages without a date are rejected; the report has them under a null date.
    """
    return _load(pages, KR_1D, bars_of, parse_day_pages, root)


def load_minute_pages(pages: DataFrame, root: str) -> DataFrame:
    """Load landed minute quote pages into KR-1m days; returns the load summary and, per day, the rows rejected.

    Rows of pages without a date are rejected; the report has them under a null date.
    """
    return _load(pages, KR_1M, ticks_of, parse_minute_pages, root)


def _load(pages: DataFrame, ds: Dataset, rows_of, parse, root: str) -> DataFrame:
    """Pages are decoded and parsed once: their rows are kept for the writer and for the count of rejects.

    Kept rows that are lost with an executor are parsed again.
    """
    spark, day = pages.sparkSession, F.col("date").cast("date").alias("date")
    parsed = parse(decode_pages(pages)).persist(StorageLevel.DISK_ONLY)
    try:
        write_rows(with_period(rows_of(parsed), ds, "day"), ds, root, layout="rebalance")
        rejected = page_rejects(parsed).groupBy(day).agg(F.count(F.lit(1)).alias("rejected"))
        # The report is small, and is made while the rows are kept.
        counts = spark.createDataFrame(rejected.collect(), "date date, rejected bigint")
    finally:
        parsed.unpersist()
    loaded = _loaded(pages.select(day).distinct(), ds, root)
    joined = loaded.join(counts, loaded["date"].eqNullSafe(counts["date"]), "full")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("rows", "symbols", "rejected")]
    return joined.select(F.coalesce("dataset", F.lit(ds.name)).alias("dataset"), F.coalesce(loaded["date"], counts["date"]).alias("date"), *numbers)


def _loaded(dates: DataFrame, ds: Dataset, root: str) -> DataFrame:
    days = sorted(str(r["date"]) for r in dates.collect() if r["date"])
    if not days:
        return load_summary({ds.name: dates.sparkSession.createDataFrame([], ds.schema)})
    stored = read_range(dates.sparkSession, ds, root, days[0], days[-1])
    loaded = F.col(ds.time).cast("date").cast("string").isin(days)
    return load_summary({ds.name: stored.where(loaded)})
