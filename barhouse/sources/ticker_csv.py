"""Bulk dumps: one comma-separated file per US ticker, five-minute bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barhouse.functions.clean import packed_timestamp, ticker_symbol, whole_volume, without_bad_bytes
from barhouse.functions.exchange import EXCHANGE_ZONE, SOURCE_ZONE, exchange_hours, exchange_time

# The record layout of a dump line.
FIELDS = ["TICKER", "PER", "DATE", "TIME", "OPEN", "HIGH", "LOW", "CLOSE", "VOL", "OPENINT"]

WHOLE = "_line"


def read_ticker_fields(spark: SparkSession, root: str) -> DataFrame:
    """Ten text fields of every line of every ``*.txt`` below a folder.

    Hidden files are left out. Commas always separate: quotes mean nothing. A
    line with another number of fields is also kept whole.
    """
    schema = ", ".join(f"{name} string" for name in [*FIELDS, WHOLE])
    reader = spark.read.schema(schema).options(
        sep=",", quote="", mode="PERMISSIVE", columnNameOfCorruptRecord=WHOLE, columnPruning=False,
        recursiveFileLookup=True, pathGlobFilter="*.txt",
    )
    return reader.csv(root)


# What a line of a dump can be.
VERDICTS = ("ok", "short", "header", "bad", "early")


def parse_ticker_fields(fields: DataFrame, earliest: str | None = None, mode: str = "rule") -> DataFrame:
    """One row per line: the record on the exchange's clock, and a verdict.

    ``verdict`` is ``ok``, ``short`` (fewer than ten fields), ``header``,
    ``bad`` (a full line whose date, time or numbers can't be read), or
    ``early``. It is told from the line's own fields, before any clock is
    shifted, so that filtering on it stays a small expression.
    """
    volume = F.trim(F.col("VOL"))
    typed = fields.select(
        F.col(WHOLE),
        F.col("DATE"),
        ticker_symbol(without_bad_bytes(F.col("TICKER"))).alias("symbol"),
        packed_timestamp(F.col("DATE"), F.col("TIME")).alias("_source"),
        F.col("CLOSE").try_cast("double").alias("price"),
        F.when(F.coalesce(volume, F.lit("")) == "", 0.0).otherwise(volume.try_cast("double")).alias("volume"),
    )
    short = F.col(WHOLE).isNotNull() & (F.size(F.split(WHOLE, ",")) < len(FIELDS))
    bad = F.col("_source").isNull() | F.col("price").isNull() | F.col("volume").isNull()
    verdict = F.when(short, "short").when(~F.col("DATE").rlike("[0-9]"), "header").when(bad, "bad")
    if earliest:
        verdict = verdict.when(F.col("_source") < first_source_time(earliest, mode), "early")
    return typed.select(
        "symbol",
        exchange_time(F.col("_source"), mode).alias("dt"),
        "price",
        whole_volume(F.col("volume")).alias("volume"),
        verdict.otherwise("ok").alias("verdict"),
    )


def first_source_time(earliest: str, mode: str = "rule") -> Column:
    """The source time at which the exchange's earliest day begins.

    Both the source day and the shifted day must reach the earliest date. The
    source clock is ahead, by an amount that holds for the whole day, so one
    constant decides both.
    """
    midnight = F.lit(earliest).cast("date").cast("timestamp_ntz")
    if mode == "zone":
        return F.convert_timezone(F.lit(EXCHANGE_ZONE), F.lit(SOURCE_ZONE), midnight)
    return midnight + F.make_dt_interval(F.lit(0), exchange_hours(midnight))


def read_ticker_csv(
    spark: SparkSession, root: str, earliest: str | None = None, mode: str = "rule"
) -> DataFrame:
    """Typed US-5m rows of a bulk dump."""
    parsed = parse_ticker_fields(read_ticker_fields(spark, root), earliest, mode)
    return parsed.where("verdict = 'ok'").drop("verdict")
