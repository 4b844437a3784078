"""Quote pages, listings, routing."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barhouse import load_day_pages, load_minute_pages, read_range
from barhouse.functions.routing import market_of, market_of_text
from barhouse.operators.symbols import restrict_to_symbols
from barhouse.sources.listing import all_symbols, parse_listing, read_listing
from barhouse.sources.pages import day_bars, decode_pages, minute_ticks, page_gaps, page_rejects, parse_day_pages, parse_minute_pages
from tests.helpers import put, rows_of

DAY = date(2023, 12, 20)
PAGES = "symbol string, date date, page int, html string"


def day_row(day="2023.12.20", close="41,250", opened="40,900", volume="812,300"):
    cells = [f"<span>{day}</span>", close, "+1,000", opened, "42,050", "40,100", volume]
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def minute_row(time="09:00", price="41,250", volume="1,000"):
    cells = [f'<span class="x">{time}</span>', price, "1", "2", "3", "99,000", volume]
    return "<tr>" + "".join(f"<td class='num'>{c}</td>" for c in cells) + "</tr>"


def page(*rows, head="<table class='other'><tr><td>1</td></tr></table>"):
    return f'<html>{head}<TABLE summary="a" class="first type2"><tr><th>h</th></tr>{"".join(rows)}</TABLE></html>'


def pages(spark, *bodies, symbol="005930"):
    return spark.createDataFrame([(symbol, DAY, i + 1, b) for i, b in enumerate(bodies)], PAGES)


BAR = ("005930", datetime(2023, 12, 20), 40900, 42050, 40100, 41250, 812300)


def test_day_page(spark):
    got = day_bars(pages(spark, page(day_row("2023.12.19"), day_row()))).collect()
    assert [tuple(r) for r in got] == [BAR]


@pytest.mark.parametrize(
    "body",
    [
        "<html></html>",
        page("<tr><td><span>2023.12.20</span></td><td>41,250</td></tr>"),
        page(day_row("2023.12.19")),
        page(day_row(opened="0")),
        page(day_row("20.12.2023")),
        page(day_row().replace("<span>", "").replace("</span>", "")),
        page(day_row(close="n/a")),
        page(head="<!-- " + page(day_row()) + " -->"),
    ],
)
def test_pages_without_a_bar(spark, body):
    assert day_bars(pages(spark, body)).count() == 0


def test_day_page_rows_and_oddities(spark):
    odd = day_row(close=" <em>41,<b>250</b></em>&nbsp;\n").replace("<tr>", "<tr onmouseover='a>b'>".replace("a>b", "ab"))
    got = parse_day_pages(pages(spark, page(day_row("2023.12.19"), odd))).collect()
    assert [(r.row_date, r.close) for r in got] == [(date(2023, 12, 19), "41250"), (DAY, "41250")]
    cut_off = page(day_row())[: -len("</TABLE></html>")]
    assert day_bars(pages(spark, cut_off)).count() == 1


def test_first_traded_bar_wins(spark):
    body = page(day_row(opened="0"), day_row(close="1"), day_row(close="2"))
    assert [r.close for r in day_bars(pages(spark, body, page(day_row(close="3")))).collect()] == [1]


def test_minute_page(spark):
    got = rows_of(minute_ticks(pages(spark, page(minute_row(), minute_row("&nbsp;09:01 ", "70,100", "2,000")))))
    assert got == [
        ("005930", datetime(2023, 12, 20, 9, 0), 41250, 1000),
        ("005930", datetime(2023, 12, 20, 9, 1), 70100, 2000),
    ]
    assert parse_minute_pages(pages(spark, "<html></html>", page("<tr><td>1</td><td>2</td></tr>"))).count() == 0


def test_minute_keeps_first_in_page_order(spark):
    both = pages(spark, page(minute_row("09:01", "5")), page(minute_row("09:01", "6"), minute_row("09:00", "7"), minute_row("09:00", "8")))
    assert [r[2] for r in rows_of(minute_ticks(both.orderBy(F.desc("page"))))] == [7, 5]


def test_bad_number_drops_the_row_only(spark):
    both = pages(spark, page(minute_row("09:00", ""), minute_row("09:01", "5")))
    assert [r.price for r in minute_ticks(both).collect()] == [5]
    assert [r.time for r in page_rejects(parse_minute_pages(both)).collect()] == ["09:00"]


def test_page_gaps(spark):
    link = '<td class="pgRR"> <a href="?code=005930&amp;page=4">end</a></td>'
    landed = spark.createDataFrame(
        [("A", DAY, 1, link), ("A", DAY, 3, ""), ("B", DAY, 1, "<td class='pgL'><a href='?page=9'></a></td>"), ("C", DAY, 2, link)], PAGES
    )
    got = rows_of(page_gaps(landed).select("symbol", "page"))
    assert got == [("A", 2), ("A", 4), ("C", 1)]


def test_page_gaps_of_odd_links(spark):
    link = '<td class="pgRR"><a href="?page={}">end</a></td>'
    landed = spark.createDataFrame([("A", DAY, 1, link.format(0)), ("B", DAY, 1, link.format(250_000)), ("C", DAY, 1, link.format(10**12))], PAGES)
    gaps = page_gaps(landed)
    assert gaps.groupBy("symbol").count().collect() == [("B", 249_999)]
    ends = gaps.agg({"page": "min"}).first()[0], gaps.agg({"page": "max"}).first()[0]
    assert ends == (2, 250_000)


def test_decoding(spark):
    raw = [(1, "날짜 1".encode("euc-kr")), (2, "날짜 2".encode()), (3, "날".encode() + b"\xff" + "짜 3".encode()), (4, None)]
    got = decode_pages(spark.createDataFrame(raw, "id int, content binary")).orderBy("id").collect()
    assert [r.html for r in got] == ["날짜 1", "날짜 2", "날짜 3", None]


def test_loads_store_and_summarise(spark, tmp_path):
    raw = pages(spark, page(day_row())).withColumn("content", F.col("html").cast("binary")).drop("html")
    assert [tuple(r) for r in load_day_pages(raw, f"{tmp_path}/d").collect()] == [("KR-1d", DAY, 1, 1, 0)]
    assert rows_of(read_range(spark, "KR-1d", f"{tmp_path}/d", "2023-12-20")) == [BAR]
    raw = pages(spark, page(minute_row(), minute_row("09:01"))).withColumn("content", F.col("html").cast("binary")).drop("html")
    assert [tuple(r) for r in load_minute_pages(raw, f"{tmp_path}/m").collect()] == [("KR-1m", DAY, 2, 1, 0)]


def test_listing(spark, tmp_path):
    kospi = '{"data":[{"code":"KR7005930003","name":"a"},{"code":"KR7000660001"},{"code":"KR7035420009"}]}'
    put(tmp_path / "kospi.json", kospi)
    got = read_listing(spark, f"{tmp_path}/kospi.json")
    assert [r.symbol for r in got.collect()] == ["005930", "000660", "035420"]
    kosdaq = spark.createDataFrame([('{"data":[{"code":"KR7035420009"},{"code":"KR7001230001"}]}',), ('{"data":[]}',)], "value string")
    both = all_symbols(got, parse_listing(kosdaq)).collect()
    assert [r.symbol for r in both] == ["000660", "001230", "005930", "035420"]


def test_routing(spark):
    names = ["005930", "AAPL", "BRK.B", "12-3.4", "00593K", "", ".-"]
    df = spark.createDataFrame([(n,) for n in names], "symbol string")
    got = {r.symbol: r.m for r in df.select("symbol", market_of(F.col("symbol")).alias("m")).collect()}
    assert got == {n: market_of_text(n) for n in names}
    assert [got[n] for n in names] == ["KR", "US", "US", "KR", "US", "US", "US"]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_symbol_restriction_with_and_without_a_broadcast(spark, threshold):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = spark.range(100).selectExpr("cast(id % 10 as string) as symbol", "id")
    wanted = spark.createDataFrame([("3",), ("4",), ("4",)], "symbol string")
    assert restrict_to_symbols(df, wanted).count() == 20
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert restrict_to_symbols(df, ["3"]).count() == 10
