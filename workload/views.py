"""The driver's tables in the shapes of the price-history datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HANGUL_DAY = "날짜"
HANGUL_TIME = "체결시각"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def padded(number: Column) -> Column:
    """At least six characters; a longer number stays as it is."""
    return F.lpad(number, F.greatest(F.length(number), F.lit(6)), F.lit("0"))


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """KR-1d shape from orders; ``open = 0`` marks suspended bars."""
    close = F.floor("o_totalprice").cast("bigint")
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        padded(F.col("o_custkey").cast("string")).alias("symbol"),
        F.col("o_orderdate").alias("date"),
        F.when(key % 11 == 0, F.lit(0)).otherwise(close - key % 100).cast("bigint").alias("open"),
        (close + 100 + key % 50).alias("high"),
        (close - 200).alias("low"),
        close.alias("close"),
        (key % 100000).alias("volume"),
    )


def ticks(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """KR-1m shape from events."""
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        padded(F.col("user_id").cast("string")).alias("symbol"),
        minute.alias("dt"),
        F.floor(F.col("value") * 100).cast("bigint").alias("price"),
        (F.col("event_id") % 1000).alias("volume"),
        *extra,
    )


def us_raw(spark: SparkSession, sf: str) -> DataFrame:
    """US-5m shape from lineitem, volumes still with halves."""
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.timestamp_add("MINUTE", 570 + 5 * F.col("l_linenumber"), F.col("l_shipdate")).alias("dt"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") / 2).alias("volume"),
    )


def us_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return us_raw(spark, sf).withColumn("volume", F.bround("volume").cast("bigint"))


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """(market, code) of listed symbols, from suppliers."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.when(key % 2 == 0, "KOSPI").otherwise("KOSDAQ").alias("market"),
        F.concat(F.lit("KR7"), F.when(F.length(key.cast("string")) <= 6, padded(key.cast("string"))).otherwise(F.raise_error(F.lit("key too wide for a code")).cast("string")), F.lit("000")).alias("code"),
    )


# The same views as common table expressions for the oracle.
BARS = """bars as (
  select lpad(cast(o_custkey as varchar), greatest(6, length(cast(o_custkey as varchar)))::int, '0') as symbol, o_orderdate as date,
         case when o_orderkey % 11 = 0 then 0 else cast(floor(o_totalprice) as bigint) - o_orderkey % 100 end as open,
         cast(floor(o_totalprice) as bigint) + 100 + o_orderkey % 50 as high,
         cast(floor(o_totalprice) as bigint) - 200 as low,
         cast(floor(o_totalprice) as bigint) as close, o_orderkey % 100000 as volume
  from orders)"""
TICK_COLUMNS = """lpad(cast(user_id as varchar), greatest(6, length(cast(user_id as varchar)))::int, '0') as symbol, date_trunc('minute', ts) as dt,
         cast(floor(value * 100) as bigint) as price, event_id % 1000 as volume"""
TICKS = f"ticks as (select {TICK_COLUMNS} from events)"
US = """us as (
  select concat('T', l_partkey) as symbol, l_shipdate + to_minutes(570 + 5 * l_linenumber) as dt,
         l_extendedprice as price, cast(round_even(l_quantity / 2, 0) as bigint) as volume
  from lineitem)"""
LISTINGS = """listings as (
  select case when s_suppkey % 2 = 0 then 'KOSPI' else 'KOSDAQ' end as market,
         concat('KR7', lpad(cast(s_suppkey as varchar), greatest(6, length(cast(s_suppkey as varchar)))::int, '0'), '000') as code
  from supplier)"""
