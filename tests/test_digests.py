"""Digests kept beside the lake: what is read again, and what isn't."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from barhouse import compact_months, convert_text, dataset, pending_days, read_range, write_days
from barhouse.plans import convert, digests
from tests.helpers import frame, put, rows_of

DAYS = ("2024-01-02", "2024-01-03", "2024-02-01")


@pytest.fixture
def lake(spark, tmp_path):
    """Three text days, converted with their digests kept."""
    for d in DAYS:
        put(tmp_path / "text" / f"{d}.txt", "A\t1\t2\t09:00\nA\t1\t2\t09:00\nB\t1\t2\t09:00\n")
    assert convert_text(spark, f"{tmp_path}/text", "KR-1m", f"{tmp_path}/lake", remember=True).count() == 3
    return tmp_path


def pending(spark, at, **options):
    return rows_of(pending_days(spark, f"{at}/text", "KR-1m", f"{at}/lake", remember=True, **options))


def read_days(monkeypatch):
    """Which text days and stored periods are opened from now on."""
    seen = {"text": [], "stored": []}
    text, periods = digests.read_text, digests.read_periods

    def reads_text(spark, ds, root, *, days):
        seen["text"] += days
        return text(spark, ds, root, days=days)

    def reads_periods(spark, ds, root, paths):
        seen["stored"] += [p.rsplit("=", 1)[-1] for p in paths]
        return periods(spark, ds, root, paths)

    monkeypatch.setattr(digests, "read_text", reads_text)
    monkeypatch.setattr(digests, "read_periods", reads_periods)
    return seen


def test_second_run_opens_no_data_file(spark, lake, monkeypatch):
    for file in [*lake.glob("text/*.txt"), *lake.glob("lake/year=*/period=*/part-*")]:
        held = file.stat()
        file.write_bytes(b"?" * held.st_size)  # any reader would fail
        os.utime(file, ns=(held.st_atime_ns, held.st_mtime_ns))
    seen = read_days(monkeypatch)
    assert pending(spark, lake) == []
    assert convert_text(spark, f"{lake}/text", "KR-1m", f"{lake}/lake", remember=True).count() == 0
    assert seen == {"text": [], "stored": []}


def test_only_a_changed_day_is_read(spark, lake, monkeypatch):
    put(lake / "text" / "2024-01-03.txt", "A\t1\t2\t09:00\nB\t7\t2\t09:00\n")
    put(lake / "text" / "2024-01-09.txt", "A\t1\t2\t09:00\n")
    seen = read_days(monkeypatch)
    assert pending(spark, lake) == [("2024-01-03", "stale"), ("2024-01-09", "new")]
    assert seen == {"text": ["2024-01-03"], "stored": []}
    convert_text(spark, f"{lake}/text", "KR-1m", f"{lake}/lake", remember=True)
    seen["text"].clear(), seen["stored"].clear()
    assert pending(spark, lake) == [] and seen == {"text": [], "stored": []}
    assert read_range(spark, "KR-1m", f"{lake}/lake", "2024-01-03", "2024-01-03").count() == 2


def test_rewritten_text_with_the_same_rows_is_read_once(spark, lake, monkeypatch):
    put(lake / "text" / "2024-01-02.txt", "B\t1\t2\t09:00\nA\t1\t2\t09:00\n")
    seen = read_days(monkeypatch)
    assert pending(spark, lake) == [] and pending(spark, lake) == []
    assert seen["text"] == ["2024-01-02"]


def test_stored_rows_that_change_behind_the_text_are_noticed(spark, lake):
    write_days(frame(spark, "KR-1m", [("A", datetime(2024, 1, 2, 9), 1, 2)]), "KR-1m", f"{lake}/lake")
    assert pending(spark, lake) == [("2024-01-02", "stale")]
    write_days(frame(spark, "KR-1m", [(s, datetime(2024, 1, 2, 9), 1, 2) for s in "AAB"]), "KR-1m", f"{lake}/lake")
    assert pending(spark, lake) == [("2024-01-02", "stale")]  # a copy too many


def test_a_compacted_month_is_read_once_and_its_days_stay_converted(spark, lake, monkeypatch):
    compact_months(spark, f"{lake}/lake", "KR-1m", "2024-03-01")
    seen = read_days(monkeypatch)
    assert pending(spark, lake) == [] and pending(spark, lake) == []
    assert seen == {"text": [], "stored": ["2024-01"]}


def test_agreement_within_tolerance_is_remembered(spark, tmp_path, monkeypatch):
    put(tmp_path / "text" / "2024-01-02.txt", "A\t100.0\t2\t09:30\n")
    write_days(frame(spark, "US-5m", [("A", datetime(2024, 1, 2, 9, 30), 100.0000001, 2)]), "US-5m", f"{tmp_path}/lake")
    calls = []
    monkeypatch.setattr(convert, "conversion_check", lambda *a, f=convert.conversion_check: calls.append(1) or f(*a))
    for _ in range(2):
        assert rows_of(pending_days(spark, f"{tmp_path}/text", "US-5m", f"{tmp_path}/lake", remember=True)) == []
    assert len(calls) == 1


def test_conversion_notices_days_that_do_not_read_back(spark, tmp_path, monkeypatch):
    put(tmp_path / "text" / "2024-01-02.txt", "A\t1\t2\t09:00\n")
    monkeypatch.setattr(convert.Catalogue, "stored_days", lambda *_: {"2024-01-02": (1, 5)})
    with pytest.raises(convert.ConversionError):
        convert_text(spark, f"{tmp_path}/text", "KR-1m", f"{tmp_path}/lake", remember=True)


def test_a_run_that_dies_before_it_saves_has_remembered_nothing(spark, lake, monkeypatch):
    put(lake / "text" / "2024-01-03.txt", "A\t9\t2\t09:00\n")
    with monkeypatch.context() as patch:
        patch.setattr(digests.Catalogue, "save", lambda _: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            pending(spark, lake)
    assert pending(spark, lake) == [("2024-01-03", "stale")]


def test_tree_adds_up(spark, lake):
    known = digests.Catalogue(spark, dataset("KR-1m"), f"{lake}/lake")
    text = known.text_days(f"{lake}/text", digests.text_stamps(spark, f"{lake}/text"))
    other = {**text, "2024-01-03": (2, 1)}
    nodes = {r["node"]: (r["rows_text"], r["rows_stored"], r["same"]) for r in digests.digest_tree(spark, text=text, stored=other).collect()}
    assert nodes == {
        "2024-01-02": (2, 2, True), "2024-01-03": (2, 2, False), "2024-02-01": (2, 2, True),
        "2024-01": (4, 4, False), "2024-02": (2, 2, True), "2024": (6, 6, False), "all": (6, 6, False),
    }
