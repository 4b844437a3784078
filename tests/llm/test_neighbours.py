from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barhouse.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, leaf bigint, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "x") for i, v in rows], SCHEMA)


def brute(rows, query_ids, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = []
    for q in query_ids:
        score = np.cumsum(vectors * vectors[ids == q][0], axis=1)[:, -1]
        other = np.flatnonzero(ids != q)
        top = other[np.lexsort((ids[other], -score[other]))[:k]]
        out += [(q, r, int(ids[t]), float(score[t])) for r, t in enumerate(top, 1)]
    return out


def clusters(n=3000, size=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (30, size))
    return [(int(i), (centres[rng.integers(30)] + rng.normal(0, 0.4, size)).astype(np.float32).tolist()) for i in rng.permutation(n)]


def test_recall_and_exact_scores(spark):
    rows = clusters()
    got = neighbours.search(frame(spark, rows).repartition(7), F.col("vec_id") % 20 == 0).toPandas()
    want = pd.DataFrame(brute(rows, range(0, 3000, 20), 20), columns=["query_id", "rank", "vec_id", "score"])
    both = got.merge(want, on=["query_id", "vec_id"])
    assert len(both) / len(want) >= 0.9
    assert (both["score_x"] == both["score_y"]).all()
    assert (got.groupby("query_id").size() == 20).all() and got["query_id"].nunique() == 150
    for _, part in got.sort_values("rank").groupby("query_id"):
        assert part["rank"].tolist() == list(range(1, 21))
        assert list(zip(-part["score"], part["vec_id"], strict=True)) == sorted(zip(-part["score"], part["vec_id"], strict=True))


def test_all_leaves_give_the_exact_answer(spark, monkeypatch):
    """With small blocks, so that one vector's many copies and many queries lie in several."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    rows = clusters(800, 8)
    rows += [(i, rows[0][1]) for i in range(800, 1200)]
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0, recall=2.0)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, range(0, 1200, 20), 20))


def test_exact_scan(spark):
    rows = clusters(500, 8)
    vectors = {i: v for i, v in rows}
    queries = np.array([vectors[i] for i in (3, 4)], np.float32).astype(float)
    got = neighbours.exact(neighbours.usable(frame(spark, rows)), np.array([3, 4]), queries, 5)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(brute(rows, [3, 4], 5))


def test_vectors_that_take_no_part(spark):
    bad = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [1.0, float("nan")]), (100, [float("inf"), 1.0]), (None, [1.0, 1.0]), (140, [])]
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (160, [0.0, 1.0])]
    got = neighbours.search(frame(spark, bad + good), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(brute(good, [0, 160], 20))


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0])]
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 3.0)] * 2


def test_an_id_stored_more_often_than_there_are_answers(spark):
    """Rows with the query's own id don't crowd out equal vectors of others."""
    rows = [(0, [1.0, 0.0])] * 30 + [(i, [1.0, 0.0]) for i in range(100, 130)] + [(i, [0.5, 0.0]) for i in range(200, 230)]
    rows += [(1, [1.0, 0.0])] * 45 + [(40, [0.0, 2.0])] * 70 + [(41, [0.0, 1.0])]
    docs = frame(spark, rows).repartition(3)
    got = neighbours.search(docs, F.col("vec_id") % 20 == 0, recall=2.0)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, [0, 40, 100, 120, 200, 220], 20))


def test_every_length_is_searched(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(100)]
    more = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(100, 160)]
    got = neighbours.search(frame(spark, rows + more), F.col("vec_id") % 20 == 0, recall=2.0)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, range(0, 100, 20), 20) + brute(more, range(100, 160, 20), 20))


def test_an_id_of_two_lengths_is_one_query(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (0, [1.0, 1.0, 1.0]), (2, [1.0, 0.0, 0.0])]
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0)]


def test_a_repeated_id_is_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    rows = [(7, [1.0, float(i)]) for i in range(500)] + [(20, [1.0, 1.0])]
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0, recall=2.0).collect()
    assert [r["score"] for r in got] == [500.0 - i for i in range(20)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(1, [1.0, 2.0])], [(0, [1.0, 2.0])]])
def test_tables_with_no_answers(spark, rows):
    assert neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0).count() == 0


def test_walk_reaches_every_leaf_once():
    points = np.array([v for _, v in clusters(2000, 8)])
    tree = neighbours.grow(points)
    assert sorted(tree.walk(points[0])) == list(range(tree.leaves))
    assert set(tree.file(points)) == set(range(tree.leaves))
