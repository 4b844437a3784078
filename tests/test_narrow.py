"""Narrow storage, Bloom filters, time units of old files, and what loads report."""

from __future__ import annotations

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barhouse import compact_years, load_day_pages, load_minute_pages, read_range, write_days
from barhouse.plans.narrow import write_narrow
from barhouse.plans.writers import WRITE_OPTIONS
from tests.helpers import frame, rows_of


def bar(month, close, volume=5, symbol="A"):
    return (symbol, datetime(2024, month, 3), 1, 100, -3, close, volume)


def test_each_period_gets_its_own_types(spark, tmp_path):
    rows = [bar(1, 100), bar(2, 300), bar(3, 40_000), bar(4, 2**40), bar(5, 1, None), bar(1, -128, 2**31, "B")]
    kinds = {r["period"]: (r["open"], r["close"], r["volume"]) for r in write_narrow(frame(spark, "KR-1d", rows), "KR-1d", f"{tmp_path}/lake").collect()}
    assert kinds == {
        "2024-01": ("tinyint", "tinyint", "bigint"), "2024-02": ("tinyint", "smallint", "tinyint"), "2024-03": ("tinyint", "int", "tinyint"),
        "2024-04": ("tinyint", "bigint", "tinyint"), "2024-05": ("tinyint", "tinyint", "tinyint"),
    }
    (stored,) = (tmp_path / "lake").glob("year=2024/period=2024-02/part-*")
    assert str(pq.read_schema(stored).field("close").type) == "int16"
    assert rows_of(read_range(spark, "KR-1d", f"{tmp_path}/lake", "2024-01-01", "2024-12-31").fillna(-1)) == rows_of(frame(spark, "KR-1d", rows).fillna(-1))


def test_floats_narrow_only_where_nothing_is_lost(spark, tmp_path):
    rows = [("A", datetime(2024, m, 3, 9, 30), price, 1) for m, price in ((1, 1.5), (2, 0.1), (3, float("nan")), (3, 2.0**-140), (4, 1e300))]
    kinds = write_narrow(frame(spark, "US-5m", rows), "US-5m", f"{tmp_path}/lake")
    assert {r["period"][-2:]: r["price"] for r in kinds.collect()} == {"01": "float", "02": "double", "03": "float", "04": "double"}
    got = read_range(spark, "US-5m", f"{tmp_path}/lake", "2024-01-01", "2024-12-31")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, frame(spark, "US-5m", rows).collect()))


def test_narrow_and_wide_periods_compact_to_wide_ones(spark, tmp_path):
    root = f"{tmp_path}/lake"
    narrow, wide = [bar(m, 7 * m) for m in range(1, 7)], [bar(m, 2**40) for m in range(7, 13)]
    write_narrow(frame(spark, "KR-1d", narrow), "KR-1d", root)
    write_days(frame(spark, "KR-1d", wide), "KR-1d", root, grain="month")
    assert rows_of(read_range(spark, "KR-1d", root, "2024-01-01", "2024-12-31")) == sorted(narrow + wide)
    compact_years(spark, root, "KR-1d", "2025-02-01")
    assert rows_of(read_range(spark, "KR-1d", root, "2024-01-01", "2024-12-31")) == sorted(narrow + wide)


def test_nothing_to_write(spark, tmp_path):
    assert write_narrow(frame(spark, "KR-1d", []), "KR-1d", f"{tmp_path}/lake").count() == 0


def scanned(df):
    """Rows that the Parquet scan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(int(leaves.apply(i).metrics().apply("numOutputRows").value()) for i in range(leaves.size()))


@pytest.mark.parametrize("dictionary", [True, False])
def test_row_groups_without_a_symbol_are_passed_over(spark, tmp_path, dictionary):
    """By their dictionary, and by a Bloom filter where symbols don't fit one."""
    ticks = spark.range(60_000).select(
        F.format_string("S%06d", 2 * F.col("id")).alias("symbol"), F.lit("2024-01-02").cast("timestamp_ntz").alias("dt"), F.col("id").alias("price"), F.lit(1).cast("bigint").alias("volume")
    )
    options = WRITE_OPTIONS if dictionary else {**WRITE_OPTIONS, "parquet.enable.dictionary#symbol": "false"}
    ticks.coalesce(1).sortWithinPartitions("symbol").write.options(**options).parquet(f"{tmp_path}/with")
    stored = spark.read.parquet(f"{tmp_path}/with")
    with _no_reuse(spark):
        assert scanned(stored.where("symbol = 'S000101'")) == 0
        assert stored.where("symbol = 'S000102'").count() == 1
    if not dictionary:
        off = {k: v for k, v in options.items() if "bloom" not in k}
        ticks.coalesce(1).sortWithinPartitions("symbol").write.options(**off).parquet(f"{tmp_path}/without")
        with _no_reuse(spark):
            assert scanned(spark.read.parquet(f"{tmp_path}/without").where("symbol = 'S000101'")) > 0


class _no_reuse:
    """Without adaptive execution the executed plan is the one that is looked at."""

    def __init__(self, spark):
        self._conf = spark.conf

    def __enter__(self):
        self._conf.set("spark.sql.adaptive.enabled", "false")

    def __exit__(self, *_):
        self._conf.set("spark.sql.adaptive.enabled", "true")


def old_file(path, unit, hours, instant=False):
    moments = [datetime(2024, 1, 5, 9) + timedelta(hours=h) for h in hours]
    kind = pa.timestamp(unit, tz="UTC") if instant else pa.timestamp(unit)
    times = pa.array(moments, pa.timestamp("us")).cast(pa.timestamp(unit)).cast(kind)
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.table({"symbol": ["A"] * len(hours), "dt": times, "price": pa.array(hours, pa.int32()), "volume": pa.array(hours, pa.int64())})
    pq.write_table(table, path, version="2.6")


def test_a_folder_of_files_in_several_units(spark, tmp_path):
    """A period stored as one folder, each part in a unit of its own."""
    folder = tmp_path / "lake" / "2024" / "2024-01.parquet"
    for k, (unit, instant) in enumerate([("ns", False), ("us", False), ("ms", False), ("us", True), ("ns", False)]):
        old_file(folder / f"part-{k}.parquet", unit, [2 * k, 2 * k + 1], instant)
    old_file(tmp_path / "lake" / "2024" / "2024-02.parquet", "ms", [20])
    got = read_range(spark, "KR-1m", f"{tmp_path}/lake", "2024-01-05 09:00:00", "2024-01-05 18:00:00")
    assert rows_of(got) == [("A", datetime(2024, 1, 5, 9 + h), h, h) for h in range(10)]
    some = read_range(spark, "KR-1m", f"{tmp_path}/lake", "2024-01-05 10:00:00", "2024-01-05 12:30:00")
    assert [r["price"] for r in some.orderBy("dt").collect()] == [1, 2, 3]


def page(*cells):
    return ("<table class='type2'><tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>").encode()


@pytest.mark.parametrize("load, first", [(load_day_pages, "<span>2024.01.02</span>"), (load_minute_pages, "<span>09:01</span>")])
def test_pages_without_a_date_are_reported_and_the_rest_is_loaded(spark, tmp_path, load, first):
    good, bad = page(first, *"1234567"[:6]), page(first, *"x23456")
    pages = spark.createDataFrame([("A", datetime(2024, 1, 2).date(), 1, good), ("B", datetime(2024, 1, 2).date(), 1, bad), ("C", None, 1, good)], "symbol string, date date, page int, content binary")
    report = load(pages, f"{tmp_path}/lake").orderBy("date").collect()
    assert [(r["date"] and str(r["date"]), r["rows"], r["symbols"], r["rejected"]) for r in report] == [(None, 0, 0, 1), ("2024-01-02", 1, 1, 1)]


def test_pages_are_parsed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    one = ("A", datetime(2024, 1, 2).date(), 1, page("<span>2024.01.02</span>", *"123456"))
    pages = spark.createDataFrame([one], "symbol string, date date, page int, content binary")
    counted = pages.mapInArrow(count, pages.schema)
    report = load_day_pages(counted, f"{tmp_path}/lake")
    read = seen.value
    assert report.count() == 1 and read == 2  # the rows, and the days they are of
