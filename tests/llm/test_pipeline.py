from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from barhouse.llm import packing, queries
from barhouse.llm.common import settled, table
from tests.llm.cases import awkward, clashing, empty
from tools.check_queries import TABLES, rows_of, types_differ

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_of_queries(spark, oracle, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = oracle.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert not types_differ(df, cursor.description)
    assert repr(rows_of(df.columns, [tuple(r) for r in df.collect()])) == repr(rows_of(columns, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("make", [awkward, clashing, empty])
def test_stages_take_awkward_documents(spark, make):
    docs = make(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "test")
        if name != "pack":
            assert docs.columns == columns
    assert (docs.count() == 0) == (make is empty)


def test_what_each_stage_decides(spark):
    docs = table(spark, SF, "documents")
    stage = dict(corpus_pipeline.STAGES)
    known = settled(stage["language"](spark, docs, SF), "test")
    assert known.count() == docs.where("text rlike '\\\\p{L}'").count()
    lines = settled(stage["lines"](spark, known, SF), "test")
    assert lines.where("n_chars != length(text)").count() == 0
    before = {r["doc_id"]: (r["text"] or "").split("\n") for r in known.collect()}
    for r in lines.collect():
        rest = iter(before[r["doc_id"]])
        assert all(line in rest for line in r["text"].split("\n"))
    single = settled(stage["near_duplicates"](spark, lines, SF), "test")
    assert single.count() <= lines.count() and single.join(lines, lines.columns, "left_anti").count() == 0
    mixed = settled(stage["mix"](spark, single, SF), "test")
    times = mixed.groupBy("doc_id").count().toPandas()["count"]
    assert times.max() <= 2 and mixed.select("doc_id").distinct().join(single, "doc_id", "left_anti").count() == 0
    pieces = stage["pack"](spark, mixed, SF).toPandas()
    assert (pieces["start"] == 0).sum() == mixed.count()
    assert pieces.groupby("sequence_id")["length"].sum().max() <= packing.WINDOW
