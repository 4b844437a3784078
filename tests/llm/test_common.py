from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barhouse.llm import common


def test_ranks_count_from_one_in_each_group(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("g"))
    got = common.ranked(rows, ["g"], ["id"], "r").toPandas()
    for _, part in got.groupby("g"):
        assert sorted(part["r"]) == list(range(1, len(part) + 1))


@pytest.mark.parametrize("sizes", [[], [0, 0], [5], [9, 1, 1, 9, 20, 1]])
def test_chunks_cover_all_in_order(sizes):
    spans = list(common.chunks(sizes, 10))
    assert [i for a, b in spans for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 10 or b - a == 1 for a, b in spans if b - a > 1)


def test_settled_reads_back(spark):
    df = spark.range(10).select("id", F.lit(None).cast("string").alias("nothing"))
    assert sorted(common.settled(df, "test").collect()) == sorted(df.collect())


def test_library_does_not_import_this_package():
    root = Path(__file__).resolve().parent.parent.parent
    code = "import sys, barhouse, workload.texts; sys.exit(any(m.startswith('barhouse.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
