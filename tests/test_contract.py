"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_queries import TABLES, rows_of, types_differ

SF = "/root/testdata/sf0.001"
PARTS = (contract.extracts, contract.texts, contract.landed, contract.checks)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables here")


ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("also", ["", "corpus_pipeline.py"])
def test_imports_without_the_text_operators(tmp_path, also):
    """With their folder gone, with or without the pipeline, every other query is there."""
    gone = {"llm", "__pycache__", ".git", also}
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda _, names: gone & set(names))
    code = "import __spark_entry__ as c; print(*sorted(c.queries()), sep='\\n'); assert set(c.oracle_sql()) <= set(c.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert set(done.stdout.split()) == set(QUERIES)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    cursor = oracle.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert not types_differ(df, cursor.description)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert ours and repr(ours) == repr(rows_of(columns, cursor.fetchall()))
