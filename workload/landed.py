"""Quote pages and symbol listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barhouse import load_day_pages, load_minute_pages, read_range
from barhouse.functions.routing import market_of
from barhouse.operators.symbols import restrict_to_symbols
from barhouse.session import scratch_dir
from barhouse.sources.listing import all_symbols, parse_listing, read_listing, read_symbols
from barhouse.sources.pages import day_bars, decode_pages, page_gaps, parse_day_pages
from workload import lakes, views as v
from workload.extracts import ALL_TICKS

# Fixed value: the word for "date" in the pages' own encoding.
EUC_KR_DAY = "B3AFC2A5"


def _commas(number: Column) -> Column:
    return F.format_number(number, 0)


def _row(*cells: Column) -> Column:
    tds = [F.concat(F.lit('<td class="num"> '), c, F.lit("&nbsp;</td>")) for c in cells]
    return F.concat(F.lit("<tr>"), *tds, F.lit("</tr>\n"))


def _span(text: Column) -> Column:
    return F.concat(F.lit('<span class="tah p10 gray03">'), text, F.lit("</span>"))


def _page(*rows: Column) -> Column:
    """Page bytes: a decoy table, the quote table with a Korean heading, rows."""
    before = F.lit('<html><table class="head"><tr><td>x</td></tr></table><table cellspacing="0" class="type2"><tr><th>')
    return F.concat(
        before.cast("binary"), F.unhex(F.lit(EUC_KR_DAY)), F.lit("</th></tr>\n").cast("binary"),
        *[r.cast("binary") for r in rows], F.lit("<tr><td></td></tr></table></html>").cast("binary"),
    )


def day_page_table(spark: SparkSession, sf: str) -> DataFrame:
    """One page per order: the bar of the day before, then the day's own."""
    return _day_pages(spark, sf, lambda cells: _row(*cells))


def _day_pages(spark: SparkSession, sf: str, own_row) -> DataFrame:
    key = _spread(v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    close = F.floor("o_totalprice").cast("bigint")
    number = F.col("o_orderkey")
    opened = F.when(number % 11 == 0, F.lit(0)).otherwise(close - number % 100).cast("bigint")
    dotted = lambda d: F.replace(d.cast("date").cast("string"), F.lit("-"), F.lit("."))

    def bar(day: Column, shift: int) -> list[Column]:
        values = [close + shift, F.lit(1), opened + shift, close + 100 + number % 50, close - 200, number % 100000]
        return [_span(dotted(day)), *[_commas(x) for x in values]]

    day = F.col("o_orderdate")
    return key.select(
        v.padded(F.col("o_custkey").cast("string")).alias("symbol"),
        day.cast("date").alias("date"),
        number.alias("page"),
        _page(_row(*bar(F.date_sub(day.cast("date"), 1), 1)), own_row(bar(day, 0))).alias("content"),
    )


def uneven_page_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages, the day's own bar with a table in its third cell, a comment full of tags, cells that don't close, or as it was."""

    def own_row(cells: list[Column]) -> Column:
        inner = F.lit("<table><tr><td>up</td><td>12</td></tr></table>")
        comment = F.lit("<!-- <td>9</td></tr></table> -->")
        nested = _row(*cells[:2], F.concat(inner, cells[2]), *cells[3:])
        hidden = _row(*cells[:3], F.concat(comment, cells[3]), *cells[4:])
        unclosed = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c) for c in cells], F.lit("</tr>\n"))
        kind = F.col("o_orderkey") % 4
        return F.when(kind == 1, nested).when(kind == 2, hidden).when(kind == 3, unclosed).otherwise(_row(*cells))

    return _day_pages(spark, sf, own_row)


def uneven_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return parse_day_pages(decode_pages(_landed(spark, sf, "uneven-pages", uneven_page_table)))


def _spread(rows: DataFrame) -> DataFrame:
    """Rows in no order, spread over all cores before pages, which are much larger, are made of them."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def landed_day_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _landed(spark, sf, "landed-day-pages", day_page_table)


def landed_minute_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _landed(spark, sf, "landed-minute-pages", minute_page_table)


def _landed(spark: SparkSession, sf: str, name: str, pages_of) -> DataFrame:
    """Pages as a landing zone holds them: many files in no order."""
    build = lambda root: pages_of(spark, sf).write.parquet(f"{root}/pages")
    return spark.read.parquet(f"{lakes.shared(spark, sf, name, build)}/pages")


def day_pages(spark: SparkSession, sf: str) -> DataFrame:
    return day_bars(decode_pages(landed_day_pages(spark, sf)))


def day_page_load(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the load job."""
    return load_day_pages(landed_day_pages(spark, sf), scratch_dir(spark, "day-pages"))


def day_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return parse_day_pages(decode_pages(landed_day_pages(spark, sf)))


def minute_page_table(spark: SparkSession, sf: str) -> DataFrame:
    """One page per event: its tick, then the same minute at another price."""
    price = F.floor(F.col("value") * 100).cast("bigint")
    clock = F.substring(F.col("ts").cast("string"), 12, 5)
    volume, nothing = F.col("event_id") % 1000, F.lit("")

    def tick(shift: int) -> Column:
        return _row(_span(clock), _commas(price + shift), nothing, nothing, nothing, F.lit("99,000"), _commas(volume))

    return _spread(v.table(spark, sf, "events").select("user_id", "ts", "event_id", "value")).select(
        v.padded(F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_id").alias("page"),
        _page(tick(0), tick(1)).alias("content"),
    )


def minute_pages_first(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "minute-pages")
    load_minute_pages(landed_minute_pages(spark, sf), root)
    return read_range(spark, "KR-1m", root, *ALL_TICKS)


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Symbol-days with up to six pages each, of which every third is lost."""
    number = F.col("symbol").cast("int")
    days = v.ticks(spark, sf).select("symbol", F.col("dt").cast("date").alias("date")).distinct()
    pages = days.withColumn("last", 1 + number % 6).withColumn("page", F.explode(F.sequence(F.lit(1), F.col("last"))))
    link = F.concat(F.lit('<td class="pgRR"><a href="?code=1&page='), F.col("last").cast("string"), F.lit('">&gt;</a></td>'))
    kept = pages.where((F.col("page") == 1) | ((F.col("page") + F.dayofmonth("date")) % 3 != 0))
    return page_gaps(kept.select("symbol", "date", "page", F.when(F.col("last") > 1, link).otherwise("").alias("html")))


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    """The same words in EUC-KR, UTF-8, and UTF-8 with a byte that fits neither."""
    key, word = F.col("o_orderkey"), F.lit(v.HANGUL_DAY).cast("binary")
    tail = key.cast("string").cast("binary")
    content = (
        F.when(key % 3 == 0, F.concat(F.unhex(F.lit(EUC_KR_DAY)), tail))
        .when(key % 3 == 1, F.concat(word, tail))
        .otherwise(F.concat(word, F.unhex(F.lit("FF")), tail))
    )
    pages = v.table(spark, sf, "orders").select("o_orderkey", content.alias("content"))
    return decode_pages(pages)


def listing_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Listing documents of two markets; some symbols are in both."""
    listed = v.listings(spark, sf)
    again = listed.where(F.col("code").endswith("0000")).withColumn("market", F.lit("KOSDAQ"))
    item = F.struct("code", F.concat(F.lit("name of "), F.col("code")).alias("name"))
    chunk = F.substring("code", 4, 4)
    documents = listed.unionAll(again).groupBy("market", chunk.alias("chunk")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("value")
    )
    path = scratch_dir(spark, "listings")
    documents.select("market", "value").write.partitionBy("market").text(path)
    landed = [parse_listing(spark.read.text(f"{path}/market={m}")) for m in ("KOSPI", "KOSDAQ")]
    return all_symbols(*landed)


def listing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Listing documents landed as files of their own."""
    listed = v.listings(spark, sf)
    item = F.struct("code", F.lit("a name\nof two lines").alias("name"))
    documents = listed.groupBy(F.substring("code", 4, 4).alias("chunk")).agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("value"))
    path = scratch_dir(spark, "listing-files")
    documents.repartition("chunk").write.partitionBy("chunk").text(path)
    return all_symbols(read_listing(spark, f"{path}/chunk=*"))


def symbol_semijoin(spark: SparkSession, sf: str) -> DataFrame:
    rich = v.table(spark, sf, "customer").where("c_acctbal > 5000")
    names = v.padded(F.col("c_custkey").cast("string"))
    path = scratch_dir(spark, "symbol-list")
    rich.select(F.concat(F.lit(" "), names, F.lit(" ")).alias("value")).write.text(path)
    return restrict_to_symbols(v.bars(spark, sf), read_symbols(spark, path))


def market_route(spark: SparkSession, sf: str) -> DataFrame:
    numbers = v.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("n"))
    forms = F.array(F.col("n"), F.concat("n", F.lit("-1.5")), F.concat(F.lit("BRK."), "n"), F.concat("n", F.lit("K")))
    symbols = numbers.select(F.explode(forms).alias("symbol"))
    return symbols.select("symbol", market_of(F.col("symbol")).alias("market"))


QUERIES = {
    "day_pages": day_pages,
    "day_page_load": day_page_load,
    "day_page_rows": day_page_rows,
    "uneven_page_rows": uneven_page_rows,
    "minute_pages_first": minute_pages_first,
    "page_gaps": gaps,
    "decode_pages": decoded,
    "listing_symbols": listing_symbols,
    "listing_files": listing_files,
    "symbol_semijoin": symbol_semijoin,
    "market_route": market_route,
}

ORACLES = {
    "day_pages": f"""with b as (
          select o_orderkey, lpad(cast(o_custkey as varchar), greatest(6, length(cast(o_custkey as varchar)))::int, '0') as symbol, o_orderdate as date,
            case when o_orderkey % 11 = 0 then 0 else cast(floor(o_totalprice) as bigint) - o_orderkey % 100 end as open,
            cast(floor(o_totalprice) as bigint) + 100 + o_orderkey % 50 as high, cast(floor(o_totalprice) as bigint) - 200 as low,
            cast(floor(o_totalprice) as bigint) as close, o_orderkey % 100000 as volume from orders),
        r as (select *, row_number() over (partition by symbol, date order by o_orderkey) as n from b where open <> 0)
        select symbol, date, open, high, low, close, volume from r where n = 1""",
    "day_page_rows": """with b as (
          select o_orderkey as page, lpad(cast(o_custkey as varchar), greatest(6, length(cast(o_custkey as varchar)))::int, '0') as symbol, cast(o_orderdate as date) as date,
            case when o_orderkey % 11 = 0 then 0 else cast(floor(o_totalprice) as bigint) - o_orderkey % 100 end as open,
            cast(floor(o_totalprice) as bigint) + 100 + o_orderkey % 50 as high, cast(floor(o_totalprice) as bigint) - 200 as low,
            cast(floor(o_totalprice) as bigint) as close, o_orderkey % 100000 as volume from orders),
        r as (select symbol, date, page, 1 as "row", date - 1 as row_date, close + 1 as close, open + 1 as open, high, low, volume from b
          union all select symbol, date, page, 2, date, close, open, high, low, volume from b)
        select symbol, date, page, cast("row" as integer) as "row", row_date, cast(close as varchar) as close, cast(open as varchar) as open,
          cast(high as varchar) as high, cast(low as varchar) as low, cast(volume as varchar) as volume from r""",
    "minute_pages_first": f"""with r as (
          select lpad(cast(user_id as varchar), greatest(6, length(cast(user_id as varchar)))::int, '0') as symbol, date_trunc('minute', ts) as dt, cast(floor(value * 100) as bigint) as price,
            event_id % 1000 as volume, row_number() over (partition by user_id, date_trunc('minute', ts) order by event_id) as n from events)
        select symbol, dt, price, volume from r where n = 1""",
    "page_gaps": f"""with {v.TICKS}, d as (select distinct symbol, cast(dt as date) as date from ticks),
        p as (select symbol, date, unnest(range(2, 2 + cast(symbol as integer) % 6)) as page from d)
        select symbol, date, cast(page as integer) as page from p where (page + day(date)) % 3 = 0""",
    "decode_pages": f"select o_orderkey, concat('{v.HANGUL_DAY}', o_orderkey) as html from orders",
    "listing_symbols": f"with {v.LISTINGS} select distinct substring(code, 4, 6) as symbol from listings",
    "symbol_semijoin": f"""with {v.BARS} select * from bars
        where symbol in (select lpad(cast(c_custkey as varchar), greatest(6, length(cast(c_custkey as varchar)))::int, '0') from customer where c_acctbal > 5000)""",
    "market_route": """with n as (select cast(c_custkey as varchar) as n from customer),
        s as (select n as symbol from n union all select concat(n, '-1.5') from n
          union all select concat('BRK.', n) from n union all select concat(n, 'K') from n)
        select symbol, case when regexp_matches(symbol, '^[0-9.-]*[0-9][0-9.-]*$') then 'KR' else 'US' end as market from s""",
}

ORACLES["day_page_load"] = f"""select 'KR-1d' as dataset, cast(date as date) as date, count(*) as rows,
    count(distinct symbol) as symbols, cast(0 as bigint) as rejected from ({ORACLES["day_pages"]}) group by 1, 2"""
ORACLES["uneven_page_rows"] = f"""select * from ({ORACLES["day_page_rows"]}) where not ("row" = 2 and page % 4 = 3)"""
ORACLES["listing_files"] = ORACLES["listing_symbols"]
