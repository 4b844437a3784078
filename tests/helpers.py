"""Small inputs shared by the tests."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

from barhouse import dataset

BARS = [
    ("005930", datetime(2026, 1, 15), 120000, 125000, 119000, 124000, 10000000),
    ("000660", datetime(2026, 1, 15), 50000, 52000, 49000, 51000, 5000000),
    ("035720", datetime(2026, 1, 15), 80000, 82000, 79000, 81000, 3000000),
]
TICKS = [
    ("005930", datetime(2026, 1, 15, 9, 0), 124000, 100000),
    ("005930", datetime(2026, 1, 15, 9, 1), 124500, 150000),
    ("005930", datetime(2026, 1, 15, 9, 2), 124200, 120000),
    ("000660", datetime(2026, 1, 15, 9, 0), 51000, 50000),
    ("000660", datetime(2026, 1, 15, 9, 1), 51200, 60000),
]
US = [
    ("AAPL", datetime(2025, 12, 15, 9, 30), 180.50, 1000000),
    ("AAPL", datetime(2025, 12, 15, 9, 35), 180.75, 1200000),
    ("AAPL", datetime(2025, 12, 15, 9, 40), 180.60, 1100000),
    ("TSLA", datetime(2025, 12, 15, 9, 30), 250.00, 800000),
    ("TSLA", datetime(2025, 12, 15, 9, 35), 251.50, 900000),
]


def frame(spark, which, rows):
    return spark.createDataFrame(rows, dataset(which).schema)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def put(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
