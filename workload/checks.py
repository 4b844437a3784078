"""Dedup, reconciliation, fingerprints and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse import write_days
from barhouse.operators import reconcile as rec
from barhouse.operators.dedup import copy_counts, drop_copies, first_per_key
from barhouse.operators.fingerprint import BASES, PRIMES, fingerprint, ordered_fingerprint
from barhouse.operators.reports import SKETCH_ERROR, day_sketches, load_summary, merged_summary, narrow_profile
from barhouse.plans.audit import reconcile_months, reconcile_years
from barhouse.sources.text_days import read_text
from workload import lakes, views as v


def _twice(df: DataFrame) -> DataFrame:
    return df.unionAll(df)


def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return drop_copies(_twice(v.ticks(spark, sf)))


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = v.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return first_per_key(rows, ["user_id", "event_type"], ["event_id"])


def copies(spark: SparkSession, sf: str) -> DataFrame:
    return copy_counts(_twice(v.ticks(spark, sf)))


def altered_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Stored side: other closes and volumes here and there, some bars absent."""
    volume = F.col("volume")
    kept = v.bars(spark, sf).where(volume % 13 != 0)
    return kept.withColumn("close", F.col("close") + F.when(volume % 7 == 0, 1).otherwise(0)).withColumn(
        "high", F.when(volume % 17 == 0, 999).otherwise(F.col("high")).cast("bigint")
    )


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    return rec.align(read_text(spark, "KR-1d", lakes.bar_text(spark, sf)), altered_bars(spark, sf), "KR-1d")


def reconciled(spark: SparkSession, sf: str) -> DataFrame:
    return rec.reconcile_columns(_aligned(spark, sf), "KR-1d", "year")


def summarised(spark: SparkSession, sf: str) -> DataFrame:
    return rec.reconcile_summary(_aligned(spark, sf), "KR-1d", "year")


def mismatched(spark: SparkSession, sf: str) -> DataFrame:
    return rec.mismatching_rows(_aligned(spark, sf), "KR-1d")


def reconciled_floats(spark: SparkSession, sf: str) -> DataFrame:
    """Prices off within tolerance, and some beyond it."""
    rows = v.us_ticks(spark, sf)
    off = F.when(F.col("volume") % 10 == 3, 0.01).otherwise(0.0)
    other = rows.withColumn("price", F.col("price") * (1 + 1e-7) * (1 + off))
    report = rec.reconcile_columns(rec.align(rows, other, "US-5m"), "US-5m", "year")
    return report.select("period", "column", "mismatches")


def missing(spark: SparkSession, sf: str) -> DataFrame:
    return rec.missing_rows(v.bars(spark, sf), altered_bars(spark, sf), "KR-1d")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rec.matched_pairs(v.bars(spark, sf), altered_bars(spark, sf), "KR-1d")


def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return rec.duplicate_key_rows(_twice(v.bars(spark, sf)), "KR-1d")


def _altered_tiers(spark: SparkSession, sf: str) -> str:
    """The altered bars: years to 1998, months to 2000, days after."""

    def build(root: str) -> None:
        bars, year = altered_bars(spark, sf), F.year("date")
        write_days(bars.where(year <= 1998), "KR-1d", root, grain="year")
        write_days(bars.where((year > 1998) & (year <= 2000)), "KR-1d", root, grain="month")
        write_days(bars.where(year > 2000), "KR-1d", root)

    return lakes.shared(spark, sf, "altered", build)


_REPORT = ["period", "status", "text_keys", "parquet_keys", "matched", "missing_in_parquet", "missing_in_text", "duplicate_keys", "mismatches"]


def months(spark: SparkSession, sf: str) -> DataFrame:
    report = reconcile_months(spark, lakes.bar_text(spark, sf), "KR-1d", _altered_tiers(spark, sf))
    return report.select(*_REPORT)


def years(spark: SparkSession, sf: str) -> DataFrame:
    report = reconcile_years(spark, lakes.bar_text(spark, sf), "KR-1d", _altered_tiers(spark, sf))
    return report.select(*_REPORT)


def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per event-month, and whether a reshuffle keeps the digest."""
    rows = v.us_ticks(spark, sf).withColumn("period", rec.period_of(rec.dataset("US-5m"), "month"))
    narrow = rows.withColumn("volume", F.col("volume").cast("int")).repartition(5, "symbol")
    one = fingerprint(rows, "US-5m", "period")
    two = fingerprint(narrow, "US-5m", "period").select("period", F.col("digest").alias("other"))
    return one.join(two, "period").select("period", "rows", (F.col("digest") == F.col("other")).alias("same"))


def ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the ticks in the order of their events: as they lie, dealt out anew, and with the first and the last one swapped."""
    number = F.col("event_id")
    ticks = v.ticks(spark, sf, "event_id")
    text = F.concat_ws("|", "symbol", F.date_format("dt", "yyyy-MM-dd HH:mm:ss"), "price", "volume")
    row = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    least, most = v.table(spark, sf, "events").agg(F.min("event_id"), F.max("event_id")).first()
    swapped = ticks.withColumn("event_id", F.when(number == least, most).when(number == most, least).otherwise(number))
    parts = {"as it lies": ticks, "dealt out anew": ticks.repartition(5, "symbol"), "two swapped": swapped}
    out = [ordered_fingerprint(df, ["event_id"], row).withColumn("variant", F.lit(name)) for name, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return rec.mismatch_samples(_aligned(spark, sf), "KR-1d", "year", 3)


def rolled_up(spark: SparkSession, sf: str) -> DataFrame:
    return rec.reconcile_rollup(_aligned(spark, sf), "KR-1d")


def sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Months from sketches of days, beside the exact counts."""
    ticks, bars = v.ticks(spark, sf), v.bars(spark, sf)
    tables = {"KR-1d": bars, "KR-1m": ticks}
    month = F.date_format("date", "yyyy-MM").alias("month")
    merged = merged_summary(day_sketches(tables), month).withColumnRenamed("symbols", "estimate")
    days = [df.select(F.lit(n).alias("dataset"), F.date_format(rec.dataset(n).time, "yyyy-MM").alias("month"), "symbol") for n, df in tables.items()]
    exact = days[0].unionByName(days[1]).groupBy("dataset", "month").agg(F.countDistinct("symbol").alias("symbols"))
    near = F.abs(F.col("estimate") - F.col("symbols")) <= F.greatest(F.col("symbols") * 3 * SKETCH_ERROR, F.lit(1))
    return merged.join(exact, ["dataset", "month"]).select("dataset", "month", "rows", "symbols", near.alias("near"))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"KR-1d": v.bars(spark, sf), "KR-1m": v.ticks(spark, sf), "US-5m": v.us_ticks(spark, sf)}
    return load_summary(tables)


def profile_bars(spark: SparkSession, sf: str) -> DataFrame:
    return narrow_profile(v.bars(spark, sf))


def profile_us(spark: SparkSession, sf: str) -> DataFrame:
    return narrow_profile(v.us_ticks(spark, sf))


QUERIES = {
    "dedup_exact": dedup_exact,
    "dedup_first": dedup_first,
    "copy_counts": copies,
    "reconcile": reconciled,
    "reconcile_summary": summarised,
    "reconcile_rows": mismatched,
    "reconcile_floats": reconciled_floats,
    "reconcile_missing": missing,
    "reconcile_pairs": pairs,
    "duplicate_keys": duplicates,
    "reconcile_months": months,
    "reconcile_years": years,
    "fingerprint": fingerprints,
    "ordered_fingerprint": ordered,
    "mismatch_samples": samples,
    "reconcile_rollup": rolled_up,
    "sketched_summary": sketched,
    "load_summary": summary,
    "narrow_profile": profile_bars,
    "narrow_profile_us": profile_us,
}

_ALTERED = """altered as (
  select symbol, date, open, case when volume % 17 = 0 then 999 else high end as high, low,
         close + case when volume % 7 = 0 then 1 else 0 end as close, volume from bars where volume % 13 <> 0)"""
# Keys with one distinct row on a side, or several ("mixed").
_SIDES = f"""{v.BARS}, {_ALTERED},
  dt as (select distinct * from bars), dp as (select distinct * from altered),
  kt as (select symbol, date, count(*) as n from dt group by all), kp as (select symbol, date, count(*) as n from dp group by all),
  keys as (select symbol, date, kt.n as n_t, kp.n as n_p from kt full join kp using (symbol, date)),
  pair as (select k.symbol, k.date, t.open as open_txt, p.open as open_pq, t.high as high_txt, p.high as high_pq, t.low as low_txt,
      p.low as low_pq, t.close as close_txt, p.close as close_pq, t.volume as volume_txt, p.volume as volume_pq
    from keys k join dt t using (symbol, date) join dp p using (symbol, date) where k.n_t = 1 and k.n_p = 1)"""
_VALUES = ["open", "high", "low", "close", "volume"]
_CELLS = " union all ".join(
    f"select symbol, date, '{c}' as \"column\", {c}_txt as txt, {c}_pq as pq from pair" for c in _VALUES
)


def _status(first: int, last: int, pattern: str) -> str:
    inside = f"year(date) between {first} and {last}"
    return f"""k as (select strftime(date, '{pattern}') as period, count(*) filter (n_t > 0) as text_keys,
        count(*) filter (n_p > 0) as parquet_keys, count(*) filter (n_p > 0 and n_t is null) as missing_in_text,
        count(*) filter (n_t = 1 and n_p = 1) as matched, count(*) filter (n_t > 0 and n_p is null) as missing_in_parquet,
        count(*) filter (n_t > 0 and n_p > 0 and (n_t > 1 or n_p > 1)) as duplicate_keys from keys where {inside} group by 1),
      m as (select strftime(date, '{pattern}') as period, count(*) filter (txt <> pq) as mismatches from ({_CELLS}) where {inside} group by 1),
      j as (select period, text_keys, parquet_keys, matched, missing_in_parquet, missing_in_text, duplicate_keys, coalesce(mismatches, 0) as mismatches
        from k left join m using (period))"""


_JUDGED = """select period, case when missing_in_parquet + duplicate_keys + mismatches = 0 then 'ok' else 'failed' end as status,
      text_keys, parquet_keys, matched, missing_in_parquet, missing_in_text, duplicate_keys, mismatches from j"""
_BLANK = "cast(null as bigint)"

ORACLES = {
    "dedup_exact": f"with {v.TICKS} select distinct * from ticks",
    "dedup_first": """with r as (select *, row_number() over (partition by user_id, event_type order by event_id) as n from events)
        select user_id, event_type, event_id, ts, value from r where n = 1""",
    "copy_counts": f"""with {v.TICKS}, d as (select distinct * from ticks)
        select 2 * (select count(*) from ticks) as rows, (select count(*) from d) as distinct_rows,
          2 * (select count(*) from ticks) - (select count(*) from d) as copies""",
    "reconcile": f"""with {_SIDES}, c as ({_CELLS}),
        g as (select strftime(date, '%Y') as period, "column", count(*) as mismatches, arg_min(symbol, (symbol, date)) as sample_symbol,
            cast(arg_min(txt, (symbol, date)) as varchar) as sample_txt, cast(arg_min(pq, (symbol, date)) as varchar) as sample_pq
          from c where txt <> pq group by 1, 2),
        grid as (select * from (select distinct strftime(date, '%Y') as period from keys), (select distinct "column" from c))
        select period, "column", coalesce(mismatches, 0) as mismatches, sample_symbol, sample_txt, sample_pq from grid left join g using (period, "column")""",
    "reconcile_summary": f"""with {_SIDES}, c as ({_CELLS}),
        k as (select strftime(date, '%Y') as period, count(*) filter (n_t > 0) as text_keys, count(*) filter (n_p > 0) as parquet_keys,
            count(*) filter (n_t > 0 and n_p is null) as missing_in_parquet, count(*) filter (n_p > 0 and n_t is null) as missing_in_text,
            count(*) filter (n_t > 0 and n_p > 0 and (n_t > 1 or n_p > 1)) as duplicate_keys, count(*) filter (n_t = 1 and n_p = 1) as matched
          from keys group by 1),
        m as (select strftime(date, '%Y') as period, count(*) as mismatches from c where txt <> pq group by 1)
        select k.*, coalesce(mismatches, 0) as mismatches,
          missing_in_parquet + duplicate_keys + coalesce(mismatches, 0) = 0 as ok from k left join m using (period)""",
    "reconcile_rows": f"""with {_SIDES}, c as ({_CELLS})
        select symbol, date, "column", cast(txt as varchar) as txt, cast(pq as varchar) as pq from c where txt <> pq""",
    "reconcile_floats": f"""with {v.US}, d as (select distinct * from us),
        u as (select symbol, dt from d group by all having count(*) = 1),
        c as (select strftime(dt, '%Y') as period, price as a, volume, price * (1 + 1e-7) * (1 + case when volume % 10 = 3 then 0.01::double else 0.0::double end) as b
          from d join u using (symbol, dt)),
        n as (select period, count(*) filter (abs(a - b) > 1e-8 + 1e-5 * abs(b)) as bad from c group by 1)
        select y.period, 'price' as "column", coalesce(bad, 0) as mismatches
        from (select distinct strftime(dt, '%Y') as period from d) y left join n using (period)
        union all select distinct strftime(dt, '%Y'), 'volume', 0 from d""",
    "reconcile_missing": f"""with {v.BARS}, {_ALTERED} select distinct * from bars b
        where not exists (select 1 from altered a where a.symbol = b.symbol and a.date = b.date)""",
    "reconcile_pairs": f"with {_SIDES} select * from pair",
    "duplicate_keys": f"""with {v.BARS} select symbol, date, count(*) as distinct_rows from (select distinct * from bars)
        group by all having count(*) > 1""",
    "reconcile_months": f"""with {_SIDES}, {_status(1999, 2000, '%Y-%m')} {_JUDGED}
        union all select distinct strftime(date, '%Y-%m'), 'not stored', {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}
        from bars where year(date) not between 1999 and 2000""",
    "reconcile_years": f"""with {_SIDES}, {_status(1900, 1998, '%Y')} {_JUDGED}
        union all select distinct strftime(date, '%Y'), 'not stored', {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}, {_BLANK}
        from bars where year(date) > 1998""",
    "fingerprint": f"with {v.US} select strftime(dt, '%Y-%m') as period, count(*) as rows, true as same from us group by 1",
    "load_summary": f"""with {v.BARS}, {v.TICKS}, {v.US}
        select 'KR-1d' as dataset, cast(date as date) as date, count(*) as rows, count(distinct symbol) as symbols from bars group by 1, 2
        union all select 'KR-1m', cast(dt as date), count(*), count(distinct symbol) from ticks group by 1, 2
        union all select 'US-5m', cast(dt as date), count(*), count(distinct symbol) from us group by 1, 2""",
}

_KIND = """case when least >= -128 and largest <= 127 then 'tinyint' when least >= -32768 and largest <= 32767 then 'smallint'
    when least >= -2147483648 and largest <= 2147483647 then 'int' else 'bigint' end"""
_RANGES = " union all ".join(
    f"select '{c}' as \"column\", cast(min({c}) as double) as least, cast(max({c}) as double) as largest from bars" for c in _VALUES
)
ORACLES["narrow_profile"] = f"with {v.BARS}, r as ({_RANGES}) select *, {_KIND} as narrow_type from r"
ORACLES["narrow_profile_us"] = f"""with {v.US}, r as (select 'volume' as "column", cast(min(volume) as double) as least, cast(max(volume) as double) as largest from us)
    select *, {_KIND} as narrow_type from r
    union all select 'price', min(price), max(price), case when bool_and(cast(cast(price as float) as double) = price) then 'float' else 'double' end from us"""

_POLYNOMIAL = " + ".join(
    f"list_reduce(list(h % {p} order by event_id desc), lambda a, x: (a * {b} + x) % {p}) {'* 2147483648' if k == 0 else ''}"
    for k, (p, b) in enumerate(zip(PRIMES, BASES))
)
ORACLES["ordered_fingerprint"] = f"""with t as (select event_id, {v.TICK_COLUMNS} from events),
      h as (select event_id, ('0x' || substr(md5(concat_ws('|', symbol, strftime(dt, '%Y-%m-%d %H:%M:%S'), price, volume)), 1, 15))::bigint as h from t),
      e as (select min(event_id) as a, max(event_id) as b from h),
      s as (select case when event_id = a then b when event_id = b then a else event_id end as event_id, h from h, e),
      d as (select 'as it lies' as variant, * from h union all select 'dealt out anew', * from h union all select 'two swapped', * from s)
    select variant, count(*) as rows, cast({_POLYNOMIAL} as bigint) as digest from d group by 1"""
ORACLES["mismatch_samples"] = f"""with {_SIDES}, c as ({_CELLS}),
      r as (select strftime(date, '%Y') as period, *, cast(row_number() over (partition by year(date), "column" order by symbol, date) as integer) as place from c where txt <> pq)
    select period, "column", place, symbol, date, cast(txt as varchar) as txt, cast(pq as varchar) as pq from r where place <= 3"""
ORACLES["reconcile_rollup"] = f"""with {_SIDES}, c as ({_CELLS}),
      w as (select symbol, date, count(*) filter (txt <> pq) as bad from c group by 1, 2),
      k as (select strftime(date, '%Y') as y, strftime(date, '%Y-%m') as m, strftime(date, '%Y-%m-%d') as d, n_t, n_p, coalesce(bad, 0) as bad
        from keys left join w using (symbol, date)),
      g as (select case when d is not null then 'day' when m is not null then 'month' when y is not null then 'year' else 'all' end as grain, coalesce(d, m, y, 'all') as period,
          count(*) filter (n_t > 0) as text_keys, count(*) filter (n_p > 0) as parquet_keys,
          count(*) filter (n_t > 0 and n_p is null) as missing_in_parquet, count(*) filter (n_p > 0 and n_t is null) as missing_in_text,
          count(*) filter (n_t > 0 and n_p > 0 and (n_t > 1 or n_p > 1)) as duplicate_keys, count(*) filter (n_t = 1 and n_p = 1) as matched,
          cast(sum(bad) as bigint) as mismatches from k group by rollup (y, m, d))
    select *, missing_in_parquet + duplicate_keys + mismatches = 0 as ok from g"""
ORACLES["sketched_summary"] = f"""with {v.BARS}, {v.TICKS},
      a as (select 'KR-1d' as dataset, strftime(date, '%Y-%m') as month, symbol from bars union all select 'KR-1m', strftime(dt, '%Y-%m'), symbol from ticks)
    select dataset, month, count(*) as rows, count(distinct symbol) as symbols, true as near from a group by 1, 2"""
