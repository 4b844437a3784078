"""Clock shift, cleaning, dedup and reports."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from barhouse.functions import clean
from barhouse.functions.exchange import exchange_hours, exchange_time
from barhouse.operators.dedup import copy_counts, drop_copies, first_per_key
from barhouse.operators.reports import load_summary, narrow_profile
from tests.helpers import BARS, TICKS, frame, rows_of


def _by_zone(moment):
    local = moment.replace(tzinfo=ZoneInfo("Europe/Warsaw"))
    return local.astimezone(ZoneInfo("America/New_York")).replace(tzinfo=None)


def test_rule_agrees_with_the_zones_in_trading_hours(spark):
    days = spark.sql("select explode(sequence(date'2007-01-01', date'2030-12-31')) as d")
    at = days.select((F.col("d").cast("timestamp_ntz") + F.expr("interval 16 hours")).alias("t"))
    for row in at.select("t", exchange_time(F.col("t")).alias("x")).collect():
        assert row.x == _by_zone(row.t), row.t


def test_zone_mode_is_the_zone_database(spark):
    rng = random.Random(5)
    moments = [(datetime(2007, 1, 1) + timedelta(minutes=rng.randrange(12_000_000)),) for _ in range(500)]
    df = spark.createDataFrame(moments, "t timestamp_ntz")
    for row in df.select("t", exchange_time(F.col("t"), "zone").alias("x")).collect():
        assert row.x == _by_zone(row.t), row.t


def test_split_days_of_a_year(spark):
    days = spark.sql("select explode(sequence(date'2021-01-01', date'2021-12-31')) as d")
    split = [r.d.isoformat() for r in days.where(exchange_hours(F.col("d")) == 5).orderBy("d").collect()]
    assert (split[0], split[13], split[14], split[-1], len(split)) == ("2021-03-14", "2021-03-27", "2021-10-31", "2021-11-06", 21)


def test_cleaning(spark):
    row = spark.createDataFrame([("  1,234 　", "x", "2023.12.20", "12/20", "\n 09:05x")], "a string, b string, c string, d string, e string")
    got = row.select(
        clean.comma_int(F.col("a")), clean.comma_int(F.col("b")), clean.dotted_date(F.col("c")).cast("string"),
        clean.dotted_date(F.col("d")), clean.clock_time(F.col("e")), clean.clock_time(F.col("d")),
        clean.ticker_symbol(F.lit("A.US.US")), clean.short_code(F.lit("KR7005930003")),
    ).first()
    assert tuple(got) == (1234, None, "2023-12-20", None, "09:05", None, "A.US", "005930")


def test_packed_timestamps(spark):
    cases = [("20211012", "153000", datetime(2021, 10, 12, 15, 30)), ("20211312", "153000", None), ("2021-1-2", "153000", None),
             ("20211012", "1530", None), ("DATE", "TIME", None), ("20211012", "250000", None)]
    df = spark.createDataFrame([c[:2] for c in cases], "d string, t string")
    assert [r[0] for r in df.coalesce(1).select(clean.packed_timestamp(F.col("d"), F.col("t"))).collect()] == [c[2] for c in cases]


def test_dedup_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice("abc"), rng.randrange(5), rng.randrange(4), rng.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, page int, row int, v int").repartition(7)
    assert rows_of(drop_copies(df)) == sorted(set(rows))
    want = {}
    for r in sorted(rows):
        want.setdefault(r[0], r)
    assert rows_of(first_per_key(df, ["k"], ["page", "row"])) == sorted(want.values())
    counts = copy_counts(df).first()
    assert (counts.rows, counts.distinct_rows, counts.copies) == (400, len(set(rows)), 400 - len(set(rows)))


def test_first_per_key_keeps_nulls_of_the_winner(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5)], "k string, n int, v int")
    assert rows_of(first_per_key(df, ["k"], ["n"])) == [("a", 1, None)]


def test_summary(spark):
    got = load_summary({"KR-1d": frame(spark, "KR-1d", BARS), "KR-1m": frame(spark, "KR-1m", TICKS)})
    assert [tuple(r)[2:] for r in got.orderBy("dataset").collect()] == [(3, 3), (5, 2)]


def test_narrow_profile(spark):
    df = spark.createDataFrame(
        [(127, -129, 2**31, 0.5, 0.1), (-128, 5, 1, float("nan"), 1.0), (None, None, None, None, None)],
        "a bigint, b bigint, c bigint, d double, e double",
    )
    got = {r.column: r.narrow_type for r in narrow_profile(df).collect()}
    assert got == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float", "e": "double"}
