"""Text day files, bulk dumps, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse import convert_text, dataset, load_ticker_csv, pending_days, read_range, write_days, write_symbols, write_text, write_text_days
from barhouse.functions.exchange import exchange_hours
from barhouse.operators.dedup import drop_copies, first_per_key
from barhouse.operators.reconcile import conversion_check
from barhouse.plans.digests import Catalogue, digest_tree, text_stamps
from barhouse.session import scratch_dir
from barhouse.sources.listing import read_symbols
from barhouse.sources.periods import list_periods
from barhouse.sources.text_days import read_text
from barhouse.sources.ticker_csv import FIELDS, parse_ticker_fields, read_ticker_fields
from barhouse.streaming.arrivals import with_arrival
from barhouse.streaming.landing import stream_text
from barhouse.streaming.ticks import first_arrivals, land_first
from workload import lakes, views as v
from workload.extracts import ALL_TICKS

EARLIEST = "1996-01-01"


def text_minute(spark: SparkSession, sf: str) -> DataFrame:
    return drop_copies(read_text(spark, "KR-1m", lakes.tick_text(spark, sf)))


def text_day(spark: SparkSession, sf: str) -> DataFrame:
    return drop_copies(read_text(spark, "KR-1d", lakes.bar_text(spark, sf)))


def text_us(spark: SparkSession, sf: str) -> DataFrame:
    return drop_copies(read_text(spark, "US-5m", lakes.us_text(spark, sf)))


def _half_converted(spark: SparkSession, sf: str) -> str:
    """Stored ticks: days divisible by 7 absent, by 5 with other prices."""
    root = scratch_dir(spark, "half-converted")
    day = F.dayofmonth("dt")
    rows = v.ticks(spark, sf).distinct().where(day % 7 != 0)
    write_days(rows.withColumn("price", F.col("price") + F.when(day % 5 == 0, 1).otherwise(0)), "KR-1m", root)
    return root


def convert_pending(spark: SparkSession, sf: str) -> DataFrame:
    return pending_days(spark, lakes.tick_text(spark, sf), "KR-1m", _half_converted(spark, sf))


def converted(spark: SparkSession, sf: str) -> DataFrame:
    root = _half_converted(spark, sf)
    convert_text(spark, lakes.tick_text(spark, sf), "KR-1m", root)
    return read_range(spark, "KR-1m", root, *ALL_TICKS)


def _converted_inside(spark: SparkSession, sf: str, grain: str) -> DataFrame:
    """Ticks with other prices stored as coarse periods, corrected from text; a second run has nothing to do."""
    root = scratch_dir(spark, f"convert-into-{grain}")
    off = F.when(F.dayofmonth("dt") % 5 == 0, 1).otherwise(0)
    write_days(v.ticks(spark, sf).distinct().withColumn("price", F.col("price") + off), "KR-1m", root, grain=grain)
    text = lakes.tick_text(spark, sf)
    convert_text(spark, text, "KR-1m", root)
    again = convert_text(spark, text, "KR-1m", root).count()
    return read_range(spark, "KR-1m", root, *ALL_TICKS).where(F.lit(again == 0))


def converted_into_month(spark: SparkSession, sf: str) -> DataFrame:
    return _converted_inside(spark, sf, "month")


def converted_into_year(spark: SparkSession, sf: str) -> DataFrame:
    return _converted_inside(spark, sf, "year")


def _changed_after(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Text converted with digests kept, and after that more text of the 3rd, 13th and 23rd."""
    root = scratch_dir(spark, "convert-changed")
    ticks = v.ticks(spark, sf)
    write_text_days(ticks, "KR-1m", f"{root}/text/first")
    convert_text(spark, f"{root}/text", "KR-1m", f"{root}/lake", remember=True)
    more = ticks.where(F.dayofmonth("dt") % 10 == 3).withColumn("price", F.col("price") + 1)
    write_text_days(more, "KR-1m", f"{root}/text/more")
    return f"{root}/text", f"{root}/lake"


def convert_changed(spark: SparkSession, sf: str) -> DataFrame:
    text, lake = _changed_after(spark, sf)
    return pending_days(spark, text, "KR-1m", lake, remember=True)


def digest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Days, months, years and all of both sides, after some text has changed."""
    text, lake = _changed_after(spark, sf)
    known = Catalogue(spark, dataset("KR-1m"), lake)
    stored = known.stored_days(lake, [path for path, _, _ in list_periods(spark, lake)])
    return digest_tree(spark, text=known.text_days(text, text_stamps(spark, text)), stored=stored)


def checked(spark: SparkSession, sf: str) -> DataFrame:
    held = read_range(spark, "KR-1m", _half_converted(spark, sf), *ALL_TICKS)
    return conversion_check(read_text(spark, "KR-1m", lakes.tick_text(spark, sf)), held, "KR-1m")


def dump_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk dump lines on the source clock; every seventh line a field short.

    A line stays in the task that reads its row: a shuffle would move and sort the whole dump.
    """
    line = v.table(spark, sf, "lineitem")
    minutes = (F.col("l_partkey") % 24) * 60 + 5 * F.col("l_linenumber")
    at = F.timestamp_add("MINUTE", minutes, F.col("l_shipdate")).cast("string")
    digits = F.regexp_replace(at, "[^0-9]", "")
    price = F.col("l_extendedprice").cast("string")
    fields = [
        F.concat(F.lit("T"), F.col("l_partkey").cast("string"), F.lit(".US")), F.lit("5"),
        F.substring(digits, 1, 8), F.substring(digits, 9, 6), F.lit("1"), F.lit("3"), F.lit("1"),
        price, (F.col("l_quantity") / 2).cast("string"),
    ]
    rest = F.when(F.col("l_linenumber") == 7, "").otherwise(",0")
    lines = line.select(F.concat(F.concat_ws(",", *fields), rest).alias("value"))
    return spark.createDataFrame([(",".join(FIELDS),)], "value string").union(lines)


def _dump(spark: SparkSession, sf: str) -> str:
    return lakes.shared(spark, sf, "dump", lambda root: dump_lines(spark, sf).write.text(root))


def ticker_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "ticker-csv")
    load_ticker_csv(spark, _dump(spark, sf), root, EARLIEST)
    return read_range(spark, "US-5m", root, "1990-01-01", "2019-12-31")


def ticker_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_ticker_fields(read_ticker_fields(spark, _dump(spark, sf)))
    return parsed.where("verdict <> 'header'").groupBy("verdict").agg(F.count(F.lit(1)).alias("lines"))


def exchange_offset(spark: SparkSession, sf: str) -> DataFrame:
    days = v.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    return days.select("d", exchange_hours(F.col("d")).cast("bigint").alias("hours"))


def text_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "text-sink")
    write_text(v.bars(spark, sf), "KR-1d", f"{path}/lines")
    return spark.read.text(f"{path}/lines")


def symbols_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "symbols-sink")
    write_symbols(v.bars(spark, sf).select("symbol").distinct(), f"{path}/symbols")
    return read_symbols(spark, f"{path}/symbols")


def streamed_text(spark: SparkSession, sf: str) -> DataFrame:
    root, source = scratch_dir(spark, "stream-text"), lakes.tick_text(spark, sf)
    for _ in range(2):
        stream_text(spark, "KR-1m", source, f"{root}/lake", f"{root}/seen").awaitTermination()
    return read_range(spark, "KR-1m", f"{root}/lake", *ALL_TICKS)


def _first_ticks(spark: SparkSession, sf: str) -> DataFrame:
    rows = v.ticks(spark, sf)
    return first_per_key(rows, ["symbol", "dt"], ["price", "volume"])


def streamed_first(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "stream-first")
    rows = _first_ticks(spark, sf)
    for name in ("a", "b"):
        rows.write.mode("append").parquet(f"{root}/landed")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
    sink = first_arrivals(stream, "KR-1m", "60 days").writeStream.format("parquet")
    query = sink.option("checkpointLocation", f"{root}/seen").trigger(availableNow=True).start(f"{root}/out")
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def streamed_late(spark: SparkSession, sf: str) -> DataFrame:
    """First arrivals where the earlier half of each month lands after the later half, cheapest ticks of a minute first."""
    root = scratch_dir(spark, "stream-late")
    rows = v.ticks(spark, sf).repartition("symbol", "dt").sortWithinPartitions("price", "volume")
    for part in (F.dayofmonth("dt") > 15, F.dayofmonth("dt") <= 15):
        rows.where(part).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landed")
        land_first(stream, "KR-1m", f"{root}/lake", f"{root}/seen").awaitTermination()
    return read_range(spark, "KR-1m", f"{root}/lake", *ALL_TICKS)


def _landed_in_order(spark: SparkSession, sf: str, root: str):
    """Ticks as files whose names and rows follow event_id; the lower half of the ids lands first, then the rest."""
    events = v.table(spark, sf, "events")
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0]
    ticks = v.ticks(spark, sf, "event_id")
    for k, half in enumerate((F.col("event_id") <= middle, F.col("event_id") > middle)):
        ranged = ticks.where(half).repartitionByRange(4, "event_id").sortWithinPartitions("event_id")
        ranged.drop("event_id").write.parquet(f"{root}/landed/{k}")
        stream = spark.readStream.schema(v.ticks(spark, sf).schema).option("recursiveFileLookup", True)
        yield with_arrival(stream.parquet(f"{root}/landed"), by_name=True)


def streamed_order(spark: SparkSession, sf: str) -> DataFrame:
    """First arrivals, which aren't the smallest, of two batches, and the rows that came after them."""
    root = scratch_dir(spark, "stream-order")
    for ticks in _landed_in_order(spark, sf, root):
        land_first(ticks, "KR-1m", f"{root}/lake", f"{root}/seen", late=f"{root}/late").awaitTermination()
    first = read_range(spark, "KR-1m", f"{root}/lake", *ALL_TICKS).withColumn("late", F.lit(False))
    return first.unionByName(spark.read.schema(first.schema).parquet(f"{root}/late").withColumn("late", F.lit(True)))


def streamed_state(spark: SparkSession, sf: str) -> DataFrame:
    """The same by keyed state."""
    root = scratch_dir(spark, "stream-state")
    for ticks in _landed_in_order(spark, sf, root):
        told = first_arrivals(ticks, "KR-1m", "400 days", late=True).writeStream.format("parquet")
        told.option("checkpointLocation", f"{root}/seen").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.parquet(f"{root}/out")


QUERIES = {
    "convert_changed": convert_changed,
    "digest_nodes": digest_nodes,
    "stream_order": streamed_order,
    "stream_state": streamed_state,
    "convert_into_month": converted_into_month,
    "convert_into_year": converted_into_year,
    "stream_late": streamed_late,
    "text_minute": text_minute,
    "text_day": text_day,
    "text_us": text_us,
    "convert_pending": convert_pending,
    "convert_text": converted,
    "conversion_check": checked,
    "ticker_csv": ticker_csv,
    "ticker_verdicts": ticker_verdicts,
    "exchange_offset": exchange_offset,
    "text_sink": text_sink,
    "symbols_sink": symbols_sink,
    "stream_text": streamed_text,
    "stream_first": streamed_first,
}

# Sundays that switch the clocks, per calendar day (dayofweek: Sunday is 0).
_HOURS = """case when (d >= a + cast((7 - dayofweek(a)) % 7 + 7 as integer) and d < b - cast(dayofweek(b) as integer))
      or (d >= e - cast(dayofweek(e) as integer) and d < f + cast((7 - dayofweek(f)) % 7 as integer)) then 5 else 6 end"""
_EDGES = """make_date(year(d), 3, 1) as a, make_date(year(d), 3, 31) as b,
      make_date(year(d), 10, 31) as e, make_date(year(d), 11, 1) as f"""

_ARRIVALS = f"""with r as (
      select event_id, {v.TICK_COLUMNS}, row_number() over (partition by user_id, date_trunc('minute', ts) order by event_id) as n from events)
    select symbol, dt, price, volume, n > 1 as late from r"""

ORACLES = {
    "text_minute": f"with {v.TICKS} select distinct * from ticks",
    "text_day": f"with {v.BARS} select distinct * from bars",
    "text_us": f"""with {v.US} select distinct symbol, dt, price,
        case when cast(floor(price) as bigint) % 8 = 0 then 0 else volume end as volume from us""",
    "convert_pending": f"""with {v.TICKS}, d as (select distinct strftime(dt, '%Y-%m-%d') as day, day(dt) as n from ticks)
        select day, case when n % 7 = 0 then 'new' else 'stale' end as reason from d where n % 7 = 0 or n % 5 = 0""",
    "convert_text": f"with {v.TICKS} select distinct * from ticks",
    "convert_into_month": f"with {v.TICKS} select distinct * from ticks",
    "convert_into_year": f"with {v.TICKS} select distinct * from ticks",
    "stream_late": f"""with {v.TICKS}, r as (
          select *, row_number() over (partition by symbol, dt order by price, volume) as n from ticks)
        select symbol, dt, price, volume from r where n = 1""",
    "convert_changed": f"with {v.TICKS} select distinct strftime(dt, '%Y-%m-%d') as day, 'stale' as reason from ticks where day(dt) % 10 = 3",
    "digest_nodes": f"""with {v.TICKS}, s as (select distinct * from ticks),
        t as (select * from s union select symbol, dt, price + 1, volume from s where day(dt) % 10 = 3),
        b as (select dt, 1 as n_text, 0 as n_stored from t union all select dt, 0, 1 from s),
        n as (select strftime(dt, '%Y') as y, strftime(dt, '%Y-%m') as m, strftime(dt, '%Y-%m-%d') as d, * from b)
        select coalesce(d, m, y, 'all') as node, cast(sum(n_text) as bigint) as rows_text, cast(sum(n_stored) as bigint) as rows_stored,
          count(*) filter (day(dt) % 10 = 3) = 0 as same from n group by rollup (y, m, d)""",
    "stream_order": _ARRIVALS,
    "stream_state": _ARRIVALS,
    "conversion_check": f"""with {v.TICKS}, t as (select distinct * from ticks),
        p as (select symbol, dt, case when day(dt) % 5 = 0 then price + 1 else price end as price, volume from t where day(dt) % 7 <> 0),
        b as (select *, 1 as n_t, 0 as n_p from t union all select *, 0, 1 from p),
        g as (select symbol, dt, price, volume, sum(n_t) as n_t, sum(n_p) as n_p from b group by all)
        select strftime(dt, '%Y-%m-%d') as day, cast(sum(n_t) as bigint) as text_rows, cast(sum(n_p) as bigint) as parquet_rows,
          count(*) filter (n_t <> n_p) as differing, count(*) filter (n_t <> n_p) = 0 as converted from g group by 1""",
    "ticker_csv": f"""with l as (
          select concat('T', l_partkey) as symbol, l_shipdate + to_minutes(cast((l_partkey % 24) * 60 + 5 * l_linenumber as integer)) as src,
                 l_extendedprice as price, cast(round_even(l_quantity / 2, 0) as bigint) as volume
          from lineitem where l_linenumber <> 7),
        y as (select *, cast(src as date) as d from l), z as (select *, {_EDGES} from y),
        s as (select symbol, src - to_hours({_HOURS}) as dt, price, volume, src from z)
        select symbol, dt, price, volume from s
        where src >= timestamp '{EARLIEST}' and dt >= timestamp '{EARLIEST}'""",
    "ticker_verdicts": """select case when l_linenumber = 7 then 'short' else 'ok' end as verdict, count(*) as lines
        from lineitem group by 1""",
    "exchange_offset": f"""with y as (select d, {_EDGES} from (select distinct cast(l_shipdate as date) as d from lineitem))
        select d, cast({_HOURS} as bigint) as hours from y""",
    "text_sink": f"""with {v.BARS} select concat_ws(chr(9), symbol, open, high, low, close, volume) as value from bars""",
    "symbols_sink": f"with {v.BARS} select distinct symbol from bars",
    "stream_text": f"with {v.TICKS} select distinct * from ticks",
    "stream_first": f"""with {v.TICKS}, r as (
          select *, row_number() over (partition by symbol, dt order by price, volume) as n from ticks)
        select symbol, dt, price, volume from r where n = 1""",
}
