"""Text day files, conversion, bulk dumps, sinks."""

from __future__ import annotations

from datetime import datetime

import pytest

from barhouse import compact_months, compact_years, convert_text, load_ticker_csv, pending_days, read_range, write_days, write_symbols, write_text, write_text_days
from barhouse.operators.reconcile import conversion_check
from barhouse.sources.listing import read_symbols, symbol_list
from barhouse.sources.text_days import read_text, read_text_rejects, text_days
from barhouse.sources.ticker_csv import FIELDS, read_ticker_csv
from tests.helpers import BARS, TICKS, US, frame, put, rows_of
from workload.texts import dump_lines

DAY = datetime(2024, 1, 2)


def test_minute_text(spark, tmp_path):
    put(tmp_path / "2024" / "2024-01-02.txt", "005930\t70000\t10\t09:00\n005930\t70000\t10\t09:00\nNA\t5\t0\t15:30\n")
    put(tmp_path / "2024" / "notes.txt", "not a day\n")
    put(tmp_path / ".hidden" / "2024-01-03.txt", "X\t1\t1\t09:00\n")
    got = rows_of(read_text(spark, "KR-1m", str(tmp_path)))
    tick = ("005930", datetime(2024, 1, 2, 9), 70000, 10)
    assert got == [tick, tick, ("NA", datetime(2024, 1, 2, 15, 30), 5, 0)]
    assert text_days(spark, str(tmp_path)) == ["2024-01-02"]


def test_day_text(spark, tmp_path):
    put(tmp_path / "2024-01-02.txt", "005930\t1\t2\t3\t4\t5\n")
    assert rows_of(read_text(spark, "KR-1d", str(tmp_path))) == [("005930", DAY, 1, 2, 3, 4, 5)]


def test_us_volume_is_filled_and_rounded_half_even(spark, tmp_path):
    lines = [("A", "", 0), ("B", "10.5", 10), ("C", "11.5", 12), ("D", "7", 7), ("E", "0.49", 0)]
    put(tmp_path / "2024-01-02.txt", "".join(f"{s}\t1.5\t{v}\t09:30\n" for s, v, _ in lines))
    got = {r.symbol: r.volume for r in read_text(spark, "US-5m", str(tmp_path)).collect()}
    assert got == {s: n for s, _, n in lines}


def test_malformed_lines_are_listed_or_dropped(spark, tmp_path):
    bad = ["B\tx\t2\t09:01", "C\t3\t4\t9h", "D\t1", "E\t1\t\t09:01", "F\t1\t2\t09:01\tz"]
    put(tmp_path / "2024-01-02.txt", "A\t1\t2\t09:00\n" + "\n".join(bad) + "\n")
    rejects = read_text_rejects(spark, "KR-1m", str(tmp_path))
    assert rejects.count() == len(bad)
    assert rows_of(rejects) == [("2024-01-02", line) for line in bad]
    kept = read_text(spark, "KR-1m", str(tmp_path), mode="DROPMALFORMED")
    assert kept.count() == 1 and rows_of(kept) == [("A", datetime(2024, 1, 2, 9), 1, 2)]


@pytest.mark.parametrize("line", ["B\tx\t2\t09:01", "C\t3\t4\t9h", "D\t1", "E\t1\t\t09:01"])
def test_malformed_line_fails_the_read(spark, tmp_path, line):
    put(tmp_path / "2024-01-02.txt", f"A\t1\t2\t09:00\n{line}\n")
    with pytest.raises(Exception):
        read_text(spark, "KR-1m", str(tmp_path)).collect()


@pytest.mark.parametrize(("which", "rows"), [("KR-1d", BARS), ("KR-1m", TICKS), ("US-5m", US)])
def test_text_days_round_trip(spark, tmp_path, which, rows):
    write_text_days(frame(spark, which, rows), which, str(tmp_path))
    assert rows_of(read_text(spark, which, str(tmp_path))) == sorted(rows)


def test_text_sink_is_sorted(spark, tmp_path):
    write_text(frame(spark, "KR-1m", TICKS), "KR-1m", f"{tmp_path}/out")
    lines = [line for f in sorted((tmp_path / "out").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[0] == "000660\t51000\t50000\t09:00" and lines == sorted(lines) and len(lines) == 5


def test_symbol_lists(spark, tmp_path):
    put(tmp_path / "list.txt", " 005930 \n\n000660\n   \n")
    assert rows_of(read_symbols(spark, str(tmp_path / "list.txt"))) == [("000660",), ("005930",)]
    assert symbol_list(" 005930, ,000660 ") == ["005930", "000660"]
    write_symbols(spark.createDataFrame([("b",), ("a",)], "symbol string"), f"{tmp_path}/out")
    assert [r.symbol for r in read_symbols(spark, f"{tmp_path}/out").collect()] == ["a", "b"]


def _text(tmp_path):
    for day, price in (("2024-01-02", 1), ("2024-01-03", 2), ("2024-01-04", 3)):
        line = f"A\t{price}\t5\t09:00\n"
        put(tmp_path / "text" / f"{day}.txt", line + f"B\t{price}\t5\t09:01\n" + line)
    return str(tmp_path / "text"), str(tmp_path / "lake")


def test_conversion_skips_what_is_converted(spark, tmp_path):
    text, lake = _text(tmp_path)
    assert rows_of(convert_text(spark, text, "KR-1m", lake)) == [(f"2024-01-0{d}", "new") for d in (2, 3, 4)]
    assert convert_text(spark, text, "KR-1m", lake).count() == 0
    put(tmp_path / "text" / "2024-01-03.txt", "A\t9\t5\t09:00\n")
    put(tmp_path / "text" / "sub" / "2024-01-05.txt", "A\t9\t5\t09:00\n")
    assert rows_of(pending_days(spark, text, "KR-1m", lake)) == [("2024-01-03", "stale"), ("2024-01-05", "new")]
    convert_text(spark, text, "KR-1m", lake)
    stored = read_range(spark, "KR-1m", lake, "2024-01-01", "2024-01-31")
    assert rows_of(stored) == sorted(set(rows_of(read_text(spark, "KR-1m", text))))
    assert pending_days(spark, text, "KR-1m", lake).count() == 0


def test_days_inside_a_stored_month_count_as_converted(spark, tmp_path):
    text, lake = _text(tmp_path)
    write_days(read_text(spark, "KR-1m", text).distinct(), "KR-1m", lake, grain="month")
    assert pending_days(spark, text, "KR-1m", lake).count() == 0


def test_extra_or_repeated_stored_rows_make_a_day_stale(spark, tmp_path):
    text, lake = _text(tmp_path)
    convert_text(spark, text, "KR-1m", lake)
    write_days(frame(spark, "KR-1m", [("A", datetime(2024, 1, 2, 9), 1, 5)]), "KR-1m", lake, mode="append")
    assert rows_of(pending_days(spark, text, "KR-1m", lake)) == [("2024-01-02", "stale")]


def _us(spark, price, volume=5, times=1):
    return frame(spark, "US-5m", [("A", datetime(2024, 1, 2, 9, 30), price, volume)] * times)


def test_float_tolerance_in_conversion_check(spark):
    check = lambda a, b, **o: conversion_check(a, b, "US-5m", **o).first().converted
    assert check(_us(spark, 100.0), _us(spark, 100.0005))
    assert not check(_us(spark, 100.0), _us(spark, 100.1))
    assert not check(_us(spark, 100.0), _us(spark, 100.0, 6))
    assert not check(_us(spark, 100.0), _us(spark, 100.0, times=2))
    assert check(_us(spark, 100.0, times=2), _us(spark, 100.0))
    assert check(_us(spark, 1.0, 1_000_000), _us(spark, 1.0, 1_000_001), int_tolerance=True)
    assert not check(_us(spark, 1.0, 1_000_000), _us(spark, 1.0, 1_000_001))


def test_dump(spark, tmp_path):
    tail = "1,2,3,4.5,100,0"
    lines = [
        f"AAPL.US,5,20211012,153000,{tail}",
        f"AAPL.US,5,20210315,143000,{tail}",
        f"AAPL.US,5,20211102,143000,{tail}",
        "BRK.us,5,20211201,160000,1,2,3,7,10.5,,\"extra",
        "AAPL.US,5,20211012,153000,1,2,3,4.5,100",
        "AAPL.US,5,20211012,153000,1,2,3,x,100,0",
        "AAPL.US,5,20211312,153000,1,2,3,4.5,100,0",
    ]
    put(tmp_path / "in" / "a" / "aapl.us.txt", ",".join(FIELDS) + "\r\n" + "\r\n".join(lines) + "\r\n")
    (tmp_path / "in" / "b.txt").write_bytes(b"<TICKER>,<PER>,<DATE>\n\xffMS\xfeFT.US,5,20211012,153000,1,2,3,9,,0\n")
    put(tmp_path / "in" / ".skip.txt", lines[0] + "\n")
    verdicts = load_ticker_csv(spark, f"{tmp_path}/in", f"{tmp_path}/lake")
    assert rows_of(verdicts) == [("bad", 2), ("header", 1), ("ok", 5), ("short", 2)]
    got = rows_of(read_range(spark, "US-5m", f"{tmp_path}/lake", "2021-01-01", "2021-12-31"))
    assert got == sorted([
        ("AAPL", datetime(2021, 10, 12, 9, 30), 4.5, 100),
        ("AAPL", datetime(2021, 3, 15, 9, 30), 4.5, 100),
        ("AAPL", datetime(2021, 11, 2, 9, 30), 4.5, 100),
        ("BRK.us", datetime(2021, 12, 1, 10, 0), 7.0, 10),
        ("MSFT", datetime(2021, 10, 12, 9, 30), 9.0, 0),
    ])


@pytest.mark.parametrize("mode", ["rule", "zone"])
def test_earliest_holds_before_and_after_the_shift(spark, tmp_path, mode):
    times = [("20211130", "235959"), ("20211201", "030000"), ("20211201", "055959"), ("20211201", "060000"), ("20211201", "153000")]
    put(tmp_path / "a.txt", "".join(f"A.US,5,{d},{t},1,2,3,4.5,1,0\n" for d, t in times))
    got = sorted(r.dt for r in read_ticker_csv(spark, str(tmp_path), "2021-12-01", mode).collect())
    assert got == [datetime(2021, 12, 1), datetime(2021, 12, 1, 9, 30)]


def test_years_go_to_their_own_folder(spark, tmp_path):
    put(tmp_path / "in" / "a.txt", "A.US,5,20211231,160000,1,2,3,4,1,0\nA.US,5,20220103,160000,1,2,3,4,1,0\n")
    load_ticker_csv(spark, f"{tmp_path}/in", f"{tmp_path}/lake", "2021-12-01")
    assert read_range(spark, "US-5m", f"{tmp_path}/lake", "2022-01-01", "2022-12-31").count() == 1


@pytest.mark.parametrize("grains", [["month"], ["year"], ["month", "year"], ["day", "month"], ["day", "month", "year"]])
def test_correction_of_a_day_inside_coarser_periods(spark, tmp_path, grains):
    """Whatever tiers hold the day, the text wins, once, and compaction doesn't bring old rows back."""
    root, old = str(tmp_path / "lake"), [("A", datetime(2024, 1, 2, 9), 1, 1), ("B", datetime(2024, 1, 3, 9), 2, 2)]
    for grain in grains:
        write_days(frame(spark, "KR-1m", old), "KR-1m", root, grain=grain)
    put(tmp_path / "text" / "2024-01-02.txt", "A\t7\t1\t09:00\nA\t7\t1\t09:00\n")
    want = [("A", datetime(2024, 1, 2, 9), 7, 1), old[1]]
    report = [tuple(r) for r in convert_text(spark, str(tmp_path / "text"), "KR-1m", root).collect()]
    assert report == [("2024-01-02", "stale")]
    assert rows_of(read_range(spark, "KR-1m", root, "2024-01-01", "2024-01-31")) == want
    assert convert_text(spark, str(tmp_path / "text"), "KR-1m", root).count() == 0
    compact_months(spark, root, "KR-1m", "2025-03-01")
    compact_years(spark, root, "KR-1m", "2025-03-01")
    assert rows_of(read_range(spark, "KR-1m", root, "2024-01-01", "2024-12-31", policy="union")) == want


def test_rows_without_a_time_fail_the_write(spark, tmp_path):
    with pytest.raises(Exception, match="no time"):
        write_days(frame(spark, "KR-1m", [("A", None, 1, 1), ("A", DAY, 1, 1)]), "KR-1m", str(tmp_path / "lake"))


def test_days_are_listed_once_however_many_files_they_have(spark, tmp_path):
    for k in range(30):
        put(tmp_path / str(k) / "2024-01-02.txt", f"A\t{k}\t1\t09:00\n")
        put(tmp_path / str(k) / f"2024-01-{k % 3 + 3:02d}.txt", f"A\t{k}\t1\t09:00\n")
    days = text_days(spark, str(tmp_path))
    assert days == ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]
    assert read_text(spark, "KR-1m", str(tmp_path), days=days[1:3]).count() == 20
    assert read_text(spark, "KR-1m", str(tmp_path), days=[]).count() == 0


def test_lines_of_a_dump_are_not_shuffled(spark, tmp_path):
    row = "1L as l_partkey, int(id % 7 + 1) as l_linenumber, timestamp_ntz'2024-01-02 00:00:00' as l_shipdate, 9.5D as l_extendedprice, 3D as l_quantity"
    spark.range(14).selectExpr(*row.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = dump_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan
    assert lines.count() == 15
    assert lines.where("value like 'T1.US,5,20240102,01%,1,3,1,9.5,1.5%'").count() == 14
