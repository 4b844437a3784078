"""Extraction, tiers and compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse import compact_months, compact_years, extract_day, extract_minute, extract_us, query, read_range, write_days
from barhouse.datasets import GRAINS
from barhouse.operators.reports import month_groups
from barhouse.plans.compact import due_months
from barhouse.plans.narrow import write_narrow
from barhouse.session import scratch_dir
from barhouse.sources.periods import period_manifest, resolve_tiers
from workload import lakes, views as v

# The ranges asked for.
MINUTES = ("2024-01-05 06:30:00", "2024-01-20")
DAYS = ("1996-01-01", "1999-12-31")
US_RANGE = ("1997-03-01 09:40:00", "2000-06-30 09:55:00")
TIER_RANGE = ("1996-06-15", "2001-03-10")
ALL_BARS, ALL_TICKS = ("1990-01-01", "2019-12-31"), ("2023-01-01", "2025-12-31")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return v.table(spark, sf, "customer").select(v.padded(key).alias("symbol"))


def minute_rows(spark: SparkSession, sf: str) -> DataFrame:
    return extract_minute(spark, lakes.tick_days(spark, sf), customers(spark, sf), *MINUTES)


def one_symbol(spark: SparkSession, sf: str) -> DataFrame:
    return extract_minute(spark, lakes.tick_days(spark, sf), "000008", *ALL_TICKS)


def day_rows(spark: SparkSession, sf: str) -> DataFrame:
    return extract_day(spark, lakes.bar_months(spark, sf), customers(spark, sf), *DAYS)


def us_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = v.table(spark, sf, "part").select(F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("symbol"))
    return extract_us(spark, lakes.us_years(spark, sf), parts, *US_RANGE)


def mixed_case(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols asked for in lower case."""
    return extract_us(spark, lakes.us_years(spark, sf), ["t1", "T2", "t3"], *US_RANGE)


def routed(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset is told from the symbol."""
    build = lambda root: write_days(v.us_ticks(spark, sf), "US-5m", f"{root}/US-5m", grain="year")
    return query(spark, lakes.shared(spark, sf, "routed", build), "min", "t7", *US_RANGE)


def mixed_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return read_range(spark, "KR-1d", lakes.mixed_bars(spark, sf), *ALL_BARS)


def _shadowed(spark: SparkSession, sf: str) -> str:
    """All bars as years, and the bars of 2000 once more as days, altered."""

    def build(root: str) -> None:
        bars = v.bars(spark, sf)
        write_days(bars, "KR-1d", root, grain="year")
        altered = bars.where(F.year("date") == 2000).withColumn("volume", F.col("volume") + 1)
        write_days(altered, "KR-1d", root)

    return lakes.shared(spark, sf, "shadowed", build)


def shadowed(spark: SparkSession, sf: str) -> DataFrame:
    return read_range(spark, "KR-1d", _shadowed(spark, sf), *ALL_BARS)


def every_tier(spark: SparkSession, sf: str) -> DataFrame:
    return read_range(spark, "KR-1d", _shadowed(spark, sf), *ALL_BARS, policy="union")


def tiers(spark: SparkSession, sf: str) -> DataFrame:
    chosen = resolve_tiers(period_manifest(spark, lakes.mixed_bars(spark, sf)), *TIER_RANGE)
    names = F.array(*[F.lit(g) for g in GRAINS])
    return chosen.select("period", F.element_at(names, F.col("grain") + 1).alias("grain"))


def groups(spark: SparkSession, sf: str) -> DataFrame:
    return month_groups(period_manifest(spark, lakes.mixed_bars(spark, sf)), "month").select("period", "members")


def due(spark: SparkSession, sf: str) -> DataFrame:
    manifest = period_manifest(spark, lakes.mixed_bars(spark, sf))
    return due_months(manifest, "2001-06-05").select("period", "members")


def compacted_month(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "compact-month")
    rows = v.ticks(spark, sf)
    write_days(rows.unionAll(rows), "KR-1m", root)
    compact_months(spark, root, "KR-1m", "2024-03-01")
    return read_range(spark, "KR-1m", root, *ALL_TICKS)


def compacted_late(spark: SparkSession, sf: str) -> DataFrame:
    return _compacted_late(spark, sf, scratch_dir(spark, "compact-late"))


def compacted_late_uri(spark: SparkSession, sf: str) -> DataFrame:
    """The same lake named by a URI and with a doubled slash."""
    root = scratch_dir(spark, "compact-late")
    head, _, tail = (root if ":" in root else f"file://{root}").rpartition("/")
    return _compacted_late(spark, sf, f"{head}//{tail}")


def _compacted_late(spark: SparkSession, sf: str, root: str) -> DataFrame:
    rows, late = v.ticks(spark, sf), F.dayofmonth("dt") > 20
    write_days(rows.where(~late), "KR-1m", root)
    compact_months(spark, root, "KR-1m", "2024-03-01")
    write_days(rows.where(late), "KR-1m", root)
    compact_months(spark, root, "KR-1m", "2024-03-01")
    return read_range(spark, "KR-1m", root, *ALL_TICKS)


def year_report(spark: SparkSession, sf: str) -> DataFrame:
    """What the job says of years of which March isn't stored and the first of May lies beside the months."""
    root, rows, month = scratch_dir(spark, "year-report"), v.bars(spark, sf), F.month("date")
    write_days(rows.where(month != 3), "KR-1d", root, grain="month")
    write_days(rows.where((month == 5) & (F.dayofmonth("date") == 1)), "KR-1d", root)
    report = compact_years(spark, root, "KR-1d", "2001-05-01")
    lists = [F.array_join(c, ",").alias(c) for c in ("missing", "leftover")]
    return report.select("period", "inputs", "merged_existing", "rows", "published", *lists)


def compacted_year(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "compact-year")
    rows = v.bars(spark, sf)
    write_days(rows.unionAll(rows), "KR-1d", root, grain="month")
    compact_years(spark, root, "KR-1d", "2001-05-01")
    return read_range(spark, "KR-1d", root, *ALL_BARS)


def narrow_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Bars to 1998 in months as narrow as they allow, those after in wide ones."""

    def build(root: str) -> None:
        bars, early = v.bars(spark, sf), F.year("date") <= 1998
        write_narrow(bars.where(early), "KR-1d", root)
        write_days(bars.where(~early), "KR-1d", root, grain="month")

    return read_range(spark, "KR-1d", lakes.shared(spark, sf, "narrow-bars", build), *ALL_BARS)


QUERIES = {
    "extract_narrow": narrow_rows,
    "extract_minute": minute_rows,
    "extract_symbol": one_symbol,
    "extract_day": day_rows,
    "extract_us": us_rows,
    "extract_mixed_case": mixed_case,
    "query_routed": routed,
    "compact_year_report": year_report,
    "extract_mixed_tiers": mixed_tiers,
    "extract_shadowed": shadowed,
    "extract_union": every_tier,
    "tier_resolution": tiers,
    "month_groups": groups,
    "mergeable_months": due,
    "compact_month": compacted_month,
    "compact_late": compacted_late,
    "compact_late_uri": compacted_late_uri,
    "compact_year": compacted_year,
}

_CUSTOMERS = "(select lpad(cast(c_custkey as varchar), greatest(6, length(cast(c_custkey as varchar)))::int, '0') from customer)"
# compact_year leaves months of the unfinished last year as they are, copies included.
_UNFINISHED = "select * from bars where year(date) >= 2001"

ORACLES = {
    "extract_narrow": f"with {v.BARS} select * from bars",
    "extract_minute": f"""with {v.TICKS} select * from ticks where symbol in {_CUSTOMERS}
        and dt between timestamp '2024-01-05 06:30:00' and timestamp '2024-01-20 23:59:59'""",
    "extract_symbol": f"with {v.TICKS} select * from ticks where symbol = '000008'",
    "extract_day": f"""with {v.BARS} select * from bars where symbol in {_CUSTOMERS}
        and date between timestamp '1996-01-01' and timestamp '1999-12-31'""",
    "extract_mixed_case": f"""with {v.US} select * from us where symbol in ('T1', 'T2', 'T3')
        and dt between '1997-03-01 09:40:00' and '2000-06-30 09:55:00'""",
    "query_routed": f"with {v.US} select * from us where symbol = 'T7' and dt between '1997-03-01 09:40:00' and '2000-06-30 09:55:00'",
    "compact_year_report": f"""with {v.BARS}, b as (select distinct *, strftime(date, '%Y') as period, strftime(date, '%Y-%m') as m from bars where year(date) < 2001),
        y as (select period, count(distinct m) filter (month(date) <> 3) as inputs, count(*) filter (month(date) <> 3) as rows,
          string_agg(distinct strftime(date, '%Y-%m-%d'), ',') filter (month(date) = 5 and day(date) = 1) as leftover from b group by 1),
        want as (select period, period || '-' || lpad(cast(i as varchar), 2, '0') as m from (select distinct period from b), range(1, 13) as t(i)),
        miss as (select period, string_agg(m, ',' order by m) as missing from want
          where substr(m, 6) = '03' or m not in (select m from b) group by 1)
        select period, cast(inputs as integer) as inputs, false as merged_existing, rows, true as published,
          coalesce(missing, '') as missing, coalesce(leftover, '') as leftover from y left join miss using (period)""",
    "extract_us": f"""with {v.US} select * from us where symbol in (select concat('T', p_partkey) from part)
        and dt between timestamp '1997-03-01 09:40:00' and timestamp '2000-06-30 09:55:00'""",
    "extract_mixed_tiers": f"with {v.BARS} select * from bars",
    "extract_shadowed": f"with {v.BARS} select * from bars",
    "extract_union": f"""with {v.BARS} select * from bars union
        select symbol, date, open, high, low, close, volume + 1 from bars where year(date) = 2000""",
    "tier_resolution": f"""with {v.BARS}
        select distinct strftime(date, '%Y') as period, 'year' as grain from bars where year(date) between 1996 and 1999
        union all select distinct strftime(date, '%Y-%m'), 'month' from bars where year(date) = 2000
        union all select distinct strftime(date, '%Y-%m-%d'), 'day' from bars
        where date between timestamp '2001-01-01' and timestamp '2001-03-10'""",
    "month_groups": f"""with {v.BARS} select strftime(date, '%Y-%m') as period, count(distinct date) as members
        from bars where year(date) >= 2001 group by 1""",
    "mergeable_months": f"""with {v.BARS}, m as (select date_trunc('month', date) as first, date from bars where year(date) >= 2001)
        select strftime(first, '%Y-%m') as period, count(distinct date) as members from m
        where cast(first + interval 1 month as date) + 5 <= date '2001-06-05' group by 1""",
    "compact_month": f"with {v.TICKS} select distinct * from ticks",
    "compact_late": f"with {v.TICKS} select distinct * from ticks",
    "compact_late_uri": f"with {v.TICKS} select distinct * from ticks",
    "compact_year": f"""with {v.BARS} select distinct * from bars where year(date) < 2001
        union all {_UNFINISHED} union all {_UNFINISHED}""",
}
