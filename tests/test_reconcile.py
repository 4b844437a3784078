"""Reconciliation against hand-made cases and a brute-force comparison."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime

import numpy as np
import pytest

from barhouse import write_days, write_text_days
from barhouse.operators.reconcile import (
    align, conversion_check, duplicate_key_rows, is_close, matched_pairs, mismatching_rows, missing_rows,
    reconcile_columns, reconcile_summary,
)
from barhouse.plans.audit import reconcile_months, reconcile_years
from tests.helpers import frame, put, rows_of

ROWS = [
    ("005930", datetime(2020, 1, 1), 100, 110, 90, 105, 1000),
    ("005930", datetime(2020, 2, 1), 105, 115, 95, 110, 1100),
]


def _summary(spark, txt, pq, which="KR-1d", grain="year"):
    aligned = align(frame(spark, which, txt), frame(spark, which, pq), which)
    return [r.asDict() for r in reconcile_summary(aligned, which, grain).orderBy("period").collect()]


def test_same_rows(spark):
    got = _summary(spark, ROWS + ROWS[:1], ROWS)
    assert got == [{
        "period": "2020", "text_keys": 2, "parquet_keys": 2, "missing_in_parquet": 0, "missing_in_text": 0,
        "duplicate_keys": 0, "matched": 2, "mismatches": 0, "ok": True,
    }]


def test_one_differing_close(spark):
    stored = [(*ROWS[0][:5], 999, 1000)]
    aligned = align(frame(spark, "KR-1d", ROWS[:1]), frame(spark, "KR-1d", stored), "KR-1d")
    got = {r.column: (r.mismatches, r.sample_symbol, r.sample_txt, r.sample_pq) for r in reconcile_columns(aligned, "KR-1d", "month").collect()}
    assert got["close"] == (1, "005930", "105", "999")
    assert all(v == (0, None, None, None) for c, v in got.items() if c != "close")
    assert rows_of(mismatching_rows(aligned, "KR-1d")) == [("005930", datetime(2020, 1, 1), "close", "105", "999")]
    assert _summary(spark, ROWS[:1], stored)[0]["ok"] is False


def test_missing_on_either_side(spark):
    extra = ("000001", datetime(2020, 1, 5), 1, 1, 1, 1, 1)
    got = _summary(spark, ROWS, [ROWS[0], extra], grain="month")
    assert [(r["period"], r["missing_in_parquet"], r["missing_in_text"], r["ok"]) for r in got] == [
        ("2020-01", 0, 1, True), ("2020-02", 1, 0, False)
    ]
    txt, pq = frame(spark, "KR-1d", ROWS + ROWS), frame(spark, "KR-1d", [ROWS[0], extra])
    assert rows_of(missing_rows(txt, pq, "KR-1d")) == [ROWS[1]]
    assert rows_of(missing_rows(pq, txt, "KR-1d")) == [extra]


def test_keys_with_several_rows_fail_without_pairing(spark):
    other = (*ROWS[0][:6], 1)
    got = _summary(spark, [ROWS[0], other], [ROWS[0], other])
    assert (got[0]["duplicate_keys"], got[0]["matched"], got[0]["ok"]) == (1, 0, False)
    df = frame(spark, "KR-1d", [ROWS[0], other, other, ROWS[1]])
    assert rows_of(duplicate_key_rows(df, "KR-1d")) == [("005930", datetime(2020, 1, 1), 2)]
    assert matched_pairs(df, df, "KR-1d").count() == 1


def test_null_beside_value_is_mixed(spark):
    half = (*ROWS[0][:6], None)
    assert _summary(spark, [ROWS[0], half], ROWS[:1])[0]["duplicate_keys"] == 1
    assert _summary(spark, [half], [half])[0]["ok"] is True
    assert _summary(spark, [half], ROWS[:1])[0]["mismatches"] == 1


def test_is_close_is_numpys(spark):
    values = [0.0, 1e-9, 1e-8, 2e-8, 1.0, 1.000009, 1.00001, 1.0000101, -1.0, 1e300, math.inf, -math.inf, math.nan]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(pairs, "a double, b double")
    for r in df.select("a", "b", is_close(df.a, df.b).alias("ok")).collect():
        assert r.ok == bool(np.isclose(r.a, r.b, equal_nan=True)), (r.a, r.b)


def _brute(txt, pq):
    def side(rows):
        keys = defaultdict(set)
        for r in rows:
            keys[r[:2]].add(r[2:])
        return keys

    a, b = side(txt), side(pq)
    single = [k for k in a if k in b and len(a[k]) == 1 == len(b[k])]
    wrong = sum(
        int(not np.isclose(x[0], y[0])) + int(x[1] != y[1]) for k in single for x, y in [(next(iter(a[k])), next(iter(b[k])))]
    )
    return {
        "text_keys": len(a), "parquet_keys": len(b), "missing_in_parquet": len(set(a) - set(b)),
        "missing_in_text": len(set(b) - set(a)), "matched": len(single),
        "duplicate_keys": sum(1 for k in a if k in b and (len(a[k]) > 1 or len(b[k]) > 1)), "mismatches": wrong,
    }


@pytest.mark.parametrize("seed", range(3))
def test_summary_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        out = []
        for _ in range(n):
            price = rng.choice([1.0, 1.000001, 2.0])
            out.append((rng.choice("ABCDEFGH"), datetime(2020, 1, rng.randrange(1, 20), 9), price, rng.randrange(2)))
        return out

    txt, pq = rows(150), rows(150)
    got = _summary(spark, txt, pq, "US-5m")[0]
    assert {k: got[k] for k in _brute(txt, pq)} == _brute(txt, pq)


def test_hot_key_does_not_fan_out(spark):
    hot = spark.range(60000).selectExpr(
        "'HOT' as symbol", "timestamp_ntz'2020-01-01 09:00:00' as dt", "id % 50 as price", "cast(1 as bigint) as volume"
    )
    aligned = align(hot, hot, "KR-1m")
    row = aligned.first()
    assert (row.rows_txt, row.rows_pq, row.mixed_txt, row.mixed_pq) == (60000, 60000, True, True)
    assert conversion_check(hot, hot.distinct(), "KR-1m").first().converted


def test_reports_over_tiers(spark, tmp_path):
    march = ("000660", datetime(2020, 3, 2), 1, 2, 3, 4, 5)
    old = ("000660", datetime(2019, 3, 2), 1, 2, 3, 4, 5)
    write_text_days(frame(spark, "KR-1d", [*ROWS, march]), "KR-1d", f"{tmp_path}/text")
    lake = f"{tmp_path}/lake"
    stored = [ROWS[0], (*ROWS[1][:5], 999, 1100)]
    write_days(frame(spark, "KR-1d", stored), "KR-1d", lake, grain="month")
    write_days(frame(spark, "KR-1d", [march]), "KR-1d", lake)
    months = reconcile_months(spark, f"{tmp_path}/text", "KR-1d", lake).select("period", "status", "mismatches")
    assert rows_of(months)[:2] == [("2020-01", "ok", 0), ("2020-02", "failed", 1)]
    assert {(r.period, r.status) for r in months.collect()} >= {("2020-03", "not stored")}
    write_days(frame(spark, "KR-1d", [*stored, march]), "KR-1d", lake, grain="year")
    write_days(frame(spark, "KR-1d", [old]), "KR-1d", lake, grain="year")
    years = reconcile_years(spark, f"{tmp_path}/text", "KR-1d", lake).select("period", "status", "matched")
    assert {tuple(r) for r in years.collect()} == {("2020", "failed", 3), ("2019", "no text", None)}


def test_reports_without_common_periods(spark, tmp_path):
    put(tmp_path / "text" / "2020-01-02.txt", "A\t1\t2\t3\t4\t5\n")
    got = reconcile_months(spark, f"{tmp_path}/text", "KR-1d", f"{tmp_path}/lake")
    assert [(r.period, r.status) for r in got.collect()] == [("2020-01", "not stored")]
