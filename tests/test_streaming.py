"""Incremental landing and keep-first streams."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException

from barhouse import compact_months, read_range, write_days
from barhouse.files import Files
from barhouse.streaming.arrivals import with_arrival
from barhouse.streaming.landing import new_rows, stored_rows, stream_text
from barhouse.streaming.ledger import Ledger
from barhouse.streaming.ticks import dropped_rows, first_arrivals, land_first
from tests.helpers import frame, put, rows_of

JANUARY = ("2024-01-01", "2024-01-31")


def _run(spark, tmp_path):
    stream_text(spark, "KR-1m", f"{tmp_path}/text", f"{tmp_path}/lake", f"{tmp_path}/seen").awaitTermination()
    return rows_of(read_range(spark, "KR-1m", f"{tmp_path}/lake", *JANUARY, policy="union"))


def test_second_run_adds_nothing_and_new_files_are_taken(spark, tmp_path):
    put(tmp_path / "text" / "2024-01-02.txt", "A\t1\t2\t09:00\nA\t1\t2\t09:00\nB\t1\t2\t09:00\n")
    two = [("A", datetime(2024, 1, 2, 9), 1, 2), ("B", datetime(2024, 1, 2, 9), 1, 2)]
    assert _run(spark, tmp_path) == two
    assert _run(spark, tmp_path) == two
    put(tmp_path / "text" / "2024-01-03.txt", "A\t5\t2\t09:00\n")
    put(tmp_path / "text" / "late" / "2024-01-02.txt", "A\t1\t2\t09:00\nC\t1\t2\t09:00\n")
    assert _run(spark, tmp_path) == sorted([*two, ("C", datetime(2024, 1, 2, 9), 1, 2), ("A", datetime(2024, 1, 3, 9), 5, 2)])


def test_redelivered_batch_is_harmless_also_after_compaction(spark, tmp_path):
    put(tmp_path / "text" / "2024-01-02.txt", "A\t1\t2\t09:00\nB\t1\t2\t09:00\n")
    _run(spark, tmp_path)
    batch = frame(spark, "KR-1m", [("A", datetime(2024, 1, 2, 9), 1, 2), ("D", datetime(2024, 1, 2, 9), 1, None)])
    assert rows_of(new_rows(batch, "KR-1m", f"{tmp_path}/lake")) == [("D", datetime(2024, 1, 2, 9), 1, None)]
    compact_months(spark, f"{tmp_path}/lake", "KR-1m", "2024-03-01")
    assert new_rows(batch, "KR-1m", f"{tmp_path}/lake").count() == 1
    assert new_rows(batch.limit(0), "KR-1m", f"{tmp_path}/lake").count() == 0


def test_first_arrival_wins_across_batches(spark, tmp_path):
    schema = frame(spark, "KR-1m", []).schema
    batches = [
        [("A", datetime(2024, 1, 2, 9, 0), 1, 1), ("B", datetime(2024, 1, 2, 9, 0), 2, 1)],
        [("A", datetime(2024, 1, 2, 9, 0), 7, 7), ("A", datetime(2024, 1, 2, 9, 1), 3, 1)],
    ]
    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = first_arrivals(stream, "KR-1m").writeStream.format("parquet")
        query = query.option("checkpointLocation", f"{tmp_path}/seen").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()

    for rows in batches:
        frame(spark, "KR-1m", rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(got) == sorted([*batches[0], batches[1][1]])
    assert dict(got.dtypes)["dt"] == "timestamp_ntz"


def test_only_periods_of_the_batch_are_read(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_days(frame(spark, "KR-1m", [("A", datetime(y, 1, 2, 9), y, 1) for y in range(2000, 2020)]), "KR-1m", root)
    batch = frame(spark, "KR-1m", [("A", datetime(y, 1, 2, 9), y, 1) for y in (2000, 2019)] + [("B", datetime(2019, 1, 2, 9), 1, 1)])
    assert {p.rsplit("/", 2)[-2] for p in stored_rows(batch, "KR-1m", root).inputFiles()} == {"period=2000-01-02", "period=2019-01-02"}
    assert rows_of(new_rows(batch, "KR-1m", root)) == [("B", datetime(2019, 1, 2, 9), 1, 1)]


def test_late_arrivals_are_not_lost(spark, tmp_path):
    def land(rows):
        frame(spark, "KR-1m", rows).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("symbol string, dt timestamp_ntz, price long, volume long").parquet(f"{tmp_path}/in")
        land_first(stream, "KR-1m", f"{tmp_path}/lake", f"{tmp_path}/seen").awaitTermination()
        return rows_of(read_range(spark, "KR-1m", f"{tmp_path}/lake", "2000-01-01", "2030-01-01"))

    new, late = ("A", datetime(2024, 1, 2, 9), 5, 1), ("A", datetime(2001, 1, 2, 9), 7, 1)
    assert land([new]) == [new]
    assert land([late, ("A", datetime(2024, 1, 2, 9), 6, 1)]) == [late, new]


def at(hour, minute, price, symbol="A", day=2):
    return (symbol, datetime(2024, 1, day, hour, minute), price, 1)


def land(spark, tmp_path, rows, name, how=land_first, **options):
    """One file of rows in this order, taken by the stream."""
    frame(spark, "KR-1m", rows).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    stream = spark.readStream.schema(frame(spark, "KR-1m", []).schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    ticks = with_arrival(stream, by_name=True)
    if how is land_first:
        query = land_first(ticks, "KR-1m", f"{tmp_path}/lake", f"{tmp_path}/seen", late=f"{tmp_path}/late")
    else:
        sink = first_arrivals(ticks, "KR-1m", late=True, **options).writeStream.format("parquet").trigger(availableNow=True)
        query = sink.option("checkpointLocation", f"{tmp_path}/seen").start(f"{tmp_path}/out")
    query.awaitTermination()
    return query


@pytest.mark.parametrize("how", [land_first, first_arrivals])
def test_first_row_of_a_file_wins_not_the_smallest(spark, tmp_path, how):
    land(spark, tmp_path, [at(9, 0, 90), at(9, 0, 10), at(9, 1, 5), at(9, 0, 50)], "b", how)
    land(spark, tmp_path, [at(9, 1, 1), at(9, 2, 7), at(9, 2, 3), at(9, 0, 90)], "c", how)
    first = [at(9, 0, 90), at(9, 1, 5), at(9, 2, 7)]
    late = sorted([at(9, 0, 10), at(9, 0, 50), at(9, 1, 1), at(9, 2, 3), at(9, 0, 90)])
    if how is land_first:
        assert rows_of(read_range(spark, "KR-1m", f"{tmp_path}/lake", *JANUARY)) == first
        assert rows_of(spark.read.parquet(f"{tmp_path}/late")) == late
    else:
        out = spark.read.parquet(f"{tmp_path}/out")
        assert rows_of(out.where("not late").drop("late")) == first
        assert rows_of(out.where("late").drop("late")) == late


def test_files_of_one_batch_count_by_name(spark, tmp_path):
    for name, price in (("z", 1), ("a", 9), ("m", 5)):
        frame(spark, "KR-1m", [at(9, 0, price)]).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    land(spark, tmp_path, [at(9, 5, 2)], "b")
    assert rows_of(read_range(spark, "KR-1m", f"{tmp_path}/lake", *JANUARY)) == [at(9, 0, 9), at(9, 5, 2)]


def test_state_is_cleared_behind_the_watermark_and_drops_are_counted(spark, tmp_path):
    land(spark, tmp_path, [at(9, 0, 1, day=2)], "a", first_arrivals, delay="1 hour")
    land(spark, tmp_path, [at(9, 0, 2, day=9)], "b", first_arrivals, delay="1 hour")
    query = land(spark, tmp_path, [at(9, 0, 3, day=2), at(9, 0, 4, day=9)], "c", first_arrivals, delay="1 hour")
    assert dropped_rows(query) == 1
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").where("not late").drop("late")) == [at(9, 0, 1, day=2), at(9, 0, 2, day=9)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1


def test_state_is_kept_by_day_and_bucket_not_by_key(spark, tmp_path):
    rows = [at(9 + m // 60, m % 60, m, symbol=f"S{k}", day=day) for k in range(3) for m in range(200) for day in (2, 3)]
    query = land(spark, tmp_path, rows, "a", first_arrivals, delay="40 days")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6
    land(spark, tmp_path, [at(9, 0, 7, symbol="S0"), at(8, 0, 7, symbol="S0")], "b", first_arrivals, delay="40 days")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(out.where("not late").drop("late")) == sorted([*rows, at(8, 0, 7, symbol="S0")])
    assert rows_of(out.where("late").drop("late")) == [at(9, 0, 7, symbol="S0")]


def test_late_rows_are_told_with_few_calls_whatever_parts_a_batch_comes_in(spark, tmp_path):
    again = [at(9, m, 1000 * n + m, symbol=s) for n in range(4) for m in range(50) for s in ("A", None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        land(spark, tmp_path, again, "a", first_arrivals)
        query = land(spark, tmp_path, again[:100], "b", first_arrivals)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(map(tuple, out.where("not late").drop("late").collect())) == Counter(again[:100])
    assert Counter(map(tuple, out.where("late").drop("late").collect())) == Counter([*again[100:], *again[:100]])
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_a_day_of_many_symbols_takes_few_calls(spark, tmp_path):
    symbols = [f"S{k}" for k in range(150)]
    rows = [at(9, m, 100 * n + m, symbol=s, day=day) for s in symbols for n in range(2) for m in range(2) for day in (2, 3)]
    query = land(spark, tmp_path, rows, "a", first_arrivals, delay="40 days")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * 8
    land(spark, tmp_path, [at(9, 2, 7, symbol=s) for s in symbols] + [at(9, 0, 8, symbol=s) for s in symbols], "b", first_arrivals, delay="40 days")
    out = spark.read.parquet(f"{tmp_path}/out")
    first = [r for r in rows if r[2] < 100] + [at(9, 2, 7, symbol=s) for s in symbols]
    assert Counter(map(tuple, out.where("not late").drop("late").collect())) == Counter(first)
    late = [r for r in rows if r[2] >= 100] + [at(9, 0, 8, symbol=s) for s in symbols]
    assert Counter(map(tuple, out.where("late").drop("late").collect())) == Counter(late)


def _dies(monkeypatch, method, after):
    """The ``after``-th call of a folder operation from now on fails."""
    calls, real = [], getattr(Files, method)

    def step(self, *args, **kwargs):
        calls.append(args)
        if len(calls) > after:
            raise OSError("the driver dies here")
        return real(self, *args, **kwargs)

    monkeypatch.setattr(Files, method, step)


@pytest.mark.parametrize(
    "method, after, compacted",
    [("touch", 0, False), ("rename", 0, False), ("rename", 2, False), ("rename", 2, True), ("rename", 5, False), ("rename", 5, True), ("delete", 2, True)],
)
def test_a_crash_between_write_and_commit_loses_and_copies_nothing(spark, tmp_path, monkeypatch, method, after, compacted):
    rows = [at(9, m, 100 + m, day=d) for d in range(2, 7) for m in range(3)]
    land(spark, tmp_path, rows[:3], "a")
    with monkeypatch.context() as patch:
        _dies(patch, method, after)
        with pytest.raises(StreamingQueryException):
            land(spark, tmp_path, rows[3:] + [at(9, 0, 1, day=2)], "b")
    if compacted:
        compact_months(spark, f"{tmp_path}/lake", "KR-1m", "2024-03-01")
    land(spark, tmp_path, [at(10, 0, 7, day=6), at(9, 0, 2, day=6)], "c")
    assert rows_of(read_range(spark, "KR-1m", f"{tmp_path}/lake", *JANUARY, policy="union")) == sorted([*rows, at(10, 0, 7, day=6)])
    assert rows_of(spark.read.parquet(f"{tmp_path}/late")) == sorted([at(9, 0, 1, day=2), at(9, 0, 2, day=6)])
    days = spark.read.schema("symbol string, dt timestamp_ntz, price long, volume long").option("basePath", f"{tmp_path}/lake").parquet(f"{tmp_path}/lake/year=*")
    assert days.count() == len(rows) + 1


def test_a_noted_batch_reads_and_writes_nothing(spark, tmp_path):
    land(spark, tmp_path, [at(9, 0, 1)], "a")
    (home,) = (tmp_path / "lake" / "_batches").iterdir()
    ledger = Ledger(spark, f"{tmp_path}/lake", home.name)
    assert ledger.last() == 0
    assert ledger.publish(0, lambda folder: pytest.fail("written again")) is False
    assert [p.name for p in home.iterdir() if not p.name.startswith(".")] == ["done-0"]
