"""Compaction: due periods, late data, failures at each step."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from barhouse import compact_months, compact_years, read_range, write_days
from barhouse.files import Files
from barhouse.operators.fingerprint import fingerprint
from barhouse.plans import compact
from barhouse.plans.compact import CompactionError, due_months, due_years, recover
from barhouse.sources.periods import period_manifest
from tests.helpers import frame, rows_of

THREE = [(s, datetime(2020, 1, d), 1, 2, 1, c, 9) for d, s, c in ((1, "B", 5), (2, "A", 6), (3, "A", 7))]
SPAN = ("2019-01-01", "2021-12-31")


def _periods(spark, root):
    return sorted(r.period for r in period_manifest(spark, root).collect())


def _days(spark, root, rows=THREE, **options):
    write_days(frame(spark, "KR-1d", rows), "KR-1d", root, **options)


def _all(spark, root):
    return rows_of(read_range(spark, "KR-1d", root, *SPAN))


@pytest.mark.parametrize(
    ("as_of", "due"), [("2020-02-05", False), ("2020-02-06", True), ("2020-01-15", False), ("2020-06-01", True)]
)
def test_month_waits_five_days(spark, tmp_path, as_of, due):
    _days(spark, str(tmp_path))
    assert due_months(period_manifest(spark, str(tmp_path)), as_of).count() == int(due)


@pytest.mark.parametrize(("as_of", "due"), [("2020-12-31", False), ("2021-01-01", True), ("2019-12-31", False)])
def test_only_past_years_are_due(spark, tmp_path, as_of, due):
    _days(spark, str(tmp_path), grain="month")
    assert due_years(period_manifest(spark, str(tmp_path)), as_of).count() == int(due)


def test_days_become_a_month_then_a_year(spark, tmp_path):
    root = str(tmp_path)
    _days(spark, root)
    _days(spark, root, THREE[:1], mode="append")  # an exact copy
    report = compact_months(spark, root, "KR-1d", "2020-03-01").collect()
    assert [(r.period, r.inputs, r.rows, r.merged_existing) for r in report] == [("2020-01", 3, 3, False)]
    assert _periods(spark, root) == ["2020-01"]
    assert _all(spark, root) == sorted(THREE)
    _days(spark, root, [("A", datetime(2020, 3, 2), 1, 1, 1, 1, 1)])
    report = compact_years(spark, root, "KR-1d", "2021-01-01").collect()
    assert report[0].period == "2020" and report[0].leftover == ["2020-03-02"]
    assert report[0].missing == [f"2020-{m:02d}" for m in range(2, 13)]
    assert _periods(spark, root) == ["2020", "2020-03-02"]


def test_one_pass_is_enough_to_validate(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compact, "_agreeing", None)
    _days(spark, str(tmp_path), THREE + [("A", datetime(2020, 2, 3), 1, 1, 1, 1, 1)])
    assert compact_months(spark, str(tmp_path), "KR-1d", "2020-06-01").count() == 2


def test_nothing_due(spark, tmp_path):
    assert compact_months(spark, str(tmp_path), "KR-1d", "2020-03-01").count() == 0


def test_stored_month_is_sorted_by_key(spark, tmp_path):
    root = str(tmp_path)
    _days(spark, root)
    compact_months(spark, root, "KR-1d", "2020-03-01")
    files = sorted((tmp_path / "year=2020" / "period=2020-01").glob("*.parquet"))
    keys = [tuple(r) for f in files for r in spark.read.parquet(str(f)).select("symbol", "date").collect()]
    assert keys == sorted(keys)


def test_late_day_is_added_not_swapped_in(spark, tmp_path):
    root = str(tmp_path)
    _days(spark, root)
    compact_months(spark, root, "KR-1d", "2020-03-01")
    late = ("C", datetime(2020, 1, 9), 1, 1, 1, 1, 1)
    _days(spark, root, [late, THREE[0]])
    report = compact_months(spark, root, "KR-1d", "2020-03-01").collect()
    assert report[0].merged_existing and report[0].rows == 4
    assert _all(spark, root) == sorted([*THREE, late])


def test_rows_of_one_key_with_other_values_all_stay(spark, tmp_path):
    root = str(tmp_path)
    other = (*THREE[0][:-1], 10)
    _days(spark, root, [*THREE, other])
    compact_months(spark, root, "KR-1d", "2020-03-01")
    assert _all(spark, root) == sorted([*THREE, other])


def test_single_day_files_are_compacted_too(spark, tmp_path):
    root = str(tmp_path)
    pdf = frame(spark, "KR-1d", THREE[:2]).toPandas()
    (tmp_path / "2020").mkdir()
    for day, rows in pdf.groupby("date"):
        rows.to_parquet(tmp_path / "2020" / f"{day:%Y-%m-%d}.parquet", index=False)
    _days(spark, root, THREE[2:])
    compact_months(spark, root, "KR-1d", "2020-03-01")
    assert _periods(spark, root) == ["2020-01"]
    assert _all(spark, root) == sorted(THREE)


def test_single_month_file_is_replaced_when_late_days_come(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "2020").mkdir()
    frame(spark, "KR-1d", THREE[:2]).toPandas().to_parquet(tmp_path / "2020" / "2020-01.parquet", index=False)
    _days(spark, root, THREE[2:])
    compact_months(spark, root, "KR-1d", "2020-03-01")
    assert not (tmp_path / "2020" / "2020-01.parquet").exists()
    assert _all(spark, root) == sorted(THREE)


def test_copies_of_one_row_are_spread(spark, tmp_path):
    same = spark.range(4000, numPartitions=16).selectExpr(
        "'A' as symbol", "timestamp_ntz'2020-01-05 09:00:00' as dt", "cast(1 as bigint) as price", "cast(2 as bigint) as volume"
    )
    write_days(same, "KR-1m", str(tmp_path))
    counts = [spark.read.parquet(str(f)).count() for f in tmp_path.rglob("*.parquet")]
    assert sum(counts) == 4000 and max(counts) < 1500


def test_bad_read_back_keeps_the_inputs(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    february = [("A", datetime(2020, 2, 3), 1, 1, 1, 1, 1)]
    _days(spark, root, THREE + february)
    real = compact.read_back

    def spoilt(*args):
        saved = real(*args)
        rows, mark = saved["2020-01"]
        return {**saved, "2020-01": (rows, mark + 1)}

    monkeypatch.setattr(compact, "read_back", spoilt)
    with pytest.raises(CompactionError, match="2020-01"):
        compact_months(spark, root, "KR-1d", "2020-06-01")
    assert _periods(spark, root) == ["2020-01-01", "2020-01-02", "2020-01-03", "2020-02"]
    assert _all(spark, root) == sorted(THREE + february)
    assert not Files(spark, root).glob(f"{root}/_staging-*")


@pytest.mark.parametrize("dies_at", [1, 2, 3, 4])
def test_dying_while_publishing_loses_nothing(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    _days(spark, root)
    compact_months(spark, root, "KR-1d", "2020-03-01")
    late = ("C", datetime(2020, 1, 9), 1, 1, 1, 1, 1)
    _days(spark, root, [late])
    steps = iter(range(1, 100))

    def mortal(real):
        def step(self, *args):
            if next(steps) == dies_at:
                raise KeyboardInterrupt
            return real(self, *args)

        return step

    with monkeypatch.context() as patch:
        patch.setattr(Files, "rename", mortal(Files.rename))
        patch.setattr(Files, "delete", mortal(Files.delete))
        try:
            compact_months(spark, root, "KR-1d", "2020-03-01")
        except KeyboardInterrupt:
            pass
    recover(spark, root)
    compact_months(spark, root, "KR-1d", "2020-03-01")
    assert _all(spark, root) == sorted([*THREE, late])
    assert _periods(spark, root) == ["2020-01"]
    left = [p.name for p in tmp_path.iterdir() if p.name.startswith("_staging")]
    assert not left


def test_fingerprint_ignores_order_and_width(spark):
    rows = frame(spark, "KR-1d", THREE)
    narrow = rows.withColumn("close", rows.close.cast("int")).repartition(3).orderBy("close", ascending=False)
    changed = frame(spark, "KR-1d", [*THREE[:2], (*THREE[2][:-1], 8)])
    one, two, other = (rows_of(fingerprint(d, "KR-1d")) for d in (rows, narrow, changed))
    assert one == two and one != other
    doubled = rows_of(fingerprint(rows.union(rows), "KR-1d"))
    assert doubled[0][0] == 6 and doubled[0][1] == 2 * one[0][1]


@pytest.mark.parametrize("layout", ["range", "rebalance"])
def test_hot_symbol_and_day_are_cut_into_several_files(spark, tmp_path, layout):
    root = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    hot = spark.range(4000).selectExpr(
        "if(id % 3 < 2, 'HOT', concat('S', id)) as symbol",
        "timestamp_ntz'2020-01-05' + make_dt_interval(0, 0, cast(id % 600 as int)) as dt",
        "id as price", "id % 7 as volume",
    )
    write_days(hot, "KR-1m", root, layout=layout)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "year=2020" / "period=2020-01-05").glob("*.parquet"))
    counts = [spark.read.parquet(str(f)).count() for f in files]
    assert sum(counts) == 4000 and max(counts) < 1500


def _spellings(path):
    relative = os.path.relpath(path)
    return {"uri": f"file://{path}", "short": f"file:{path}", "relative": relative, "doubled": f"{path.parent}//{path.name}"}


@pytest.mark.parametrize("grain", ["month", "year"])
@pytest.mark.parametrize("spelling", ["uri", "short", "relative", "doubled"])
def test_late_data_under_any_spelling_of_the_root(spark, tmp_path, spelling, grain):
    root = _spellings(tmp_path)[spelling]
    late = [("C", datetime(2020, 1, 9), 1, 2, 1, 8, 9)]
    _days(spark, root)
    compact_months(spark, root, "KR-1d", "2021-03-01")
    if grain == "year":
        compact_years(spark, root, "KR-1d", "2021-03-01")
    _days(spark, root, late)
    report = compact_months(spark, root, "KR-1d", "2021-03-01").collect()
    if grain == "year":
        report = compact_years(spark, root, "KR-1d", "2021-03-01").collect()
    assert [r.rows for r in report] == [4]
    assert rows_of(read_range(spark, "KR-1d", root, *SPAN, policy="union")) == sorted(THREE + late)


def test_refuses_to_delete_what_holds_the_result(spark, tmp_path):
    files, place = Files(spark, str(tmp_path)), f"{tmp_path}/year=2020/period=2020"
    for path in (place, f"file://{place}", f"{tmp_path}/year=2020", str(tmp_path)):
        with pytest.raises(ValueError, match="refusing"):
            files.delete_all([path], keep=place)
