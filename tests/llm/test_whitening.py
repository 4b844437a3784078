from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from barhouse.llm import spectrum, whitening

KIND = "vec_id bigint, embedding array<float>"


def polynomial(matrix):
    """det(x - matrix) by Faddeev and LeVerrier, in fractions."""
    d = len(matrix)
    c, m = [Fraction(0)] * d + [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(sum(matrix[i][t] * m[t][i] for t in range(d)) for i in range(d)) / k
    return [int(x) for x in c]


def gram(seed, d, rank, size=50):
    rng = random.Random(seed)
    rows = [[rng.randint(-size, size) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (5, 9), (6, 2), (9, 9)])
def test_characteristic_polynomial(spark, d, rank):
    matrix = gram(d, d, rank, 10**9 if d == 5 else 50)
    assert spectrum.characteristic_polynomial(spark, matrix) == polynomial(matrix)


def test_primes():
    assert spectrum.primes_below(100, 10**6) == [97, 89, 83, 79]
    assert spectrum.primes_below(2**31, 1) == [2**31 - 1]


def test_roots_are_counted_with_multiplicity():
    c = [1]
    for root in (3, 3, 3, 7, 0, 12):
        c = [x - root * y for x, y in zip([0, *c], [*c, 0])]
    assert [spectrum.roots_above(c, 2 * a + 1, 1) for a in (-1, 0, 2, 3, 6, 7, 11, 12)] == [6, 5, 5, 2, 2, 1, 1, 0]
    found = spectrum.largest_roots(c, 5, 28)
    assert [(round((2 * low + 1) / 2 ** (bits + 1)), n) for low, bits, n in found] == [(12, 1), (7, 1), (3, 3)]


@pytest.mark.parametrize("d, rank", [(1, 3), (4, 8), (12, 30), (12, 3)])
def test_eigenvectors(spark, d, rank):
    matrix = gram(d + rank, d, rank)
    found = spectrum.principal(spark, matrix, 4)
    values, vectors = np.linalg.eigh(np.array(matrix, float))
    assert len(found) == min(4, d, rank)
    for k, (value, vector) in enumerate(found):
        assert float(value) == pytest.approx(values[-1 - k], rel=1e-10)
        assert abs(np.dot(vector, vectors[:, -1 - k])) == pytest.approx(1, abs=1e-10)


def test_equal_eigenvalues_have_orthonormal_vectors(spark):
    matrix = [[5 if i == j else 0 for j in range(6)] for i in range(6)]
    found = spectrum.principal(spark, matrix, 4)
    v = np.array([x for _, x in found])
    assert [float(e) for e, _ in found] == [5.0] * 4 and np.allclose(v @ v.T, np.eye(4), atol=1e-14)


def test_nearly_equal_eigenvalues_are_told_apart(spark):
    big = 10**30
    matrix = [[big + 1, 0, 1], [0, big, 0], [1, 0, big + 1]]  # eigenvalues big + 2, big, big
    (_, first), *rest = spectrum.principal(spark, matrix, 3)
    assert np.allclose(np.abs(first), [0.5**0.5, 0, 0.5**0.5], atol=1e-14) and len(rest) == 2


@pytest.mark.parametrize("size", [100, 40_000, 2**40, 2**62])
def test_products_are_exact(size):
    rng = random.Random(size)
    x = np.array([[rng.randint(-size, size) for _ in range(3)] for _ in range(50)], np.int64)
    want = x.astype(object).T @ x.astype(object)
    assert (whitening.exact_products(x) == want).all()


def plain(rows, k=4):
    """(vec_id, component) to (n, deviation, absolute whitened value, explained), by numpy."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for d in {len(x) for _, x in kept} - {0}:
        fit = np.array(sorted({tuple(x) for _, x in kept if len(x) == d}), object)
        n, sums = len(fit), fit.sum(axis=0)
        centred = fit.astype(float) - fit.astype(float).mean(axis=0)
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        for i, x in kept:
            if len(x) == d:
                for c in range(min(k, d)):
                    y = (np.array(x, float) - centred_mean(fit)) @ vectors[:, -1 - c] / values[-1 - c] ** 0.5
                    out[i, c + 1] = (n, int(((n * np.array(x, object) - sums) ** 2).sum()), abs(y), values[-1 - c] / values.sum())
    return out


def centred_mean(fit):
    return fit.astype(float).mean(axis=0)


def test_same_as_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 7)) * [3, 2, 1, 0.7, 0.5, 0.1, 0.05]
    rows = [(i, v) for i, v in enumerate(base.tolist())] + [(i + 1000, v) for i, v in enumerate(base[:20].tolist())]
    rows += [(5000, [float("nan")] * 7), (5001, None), (5002, [1.0] * 6 + [float("inf")]), (5003, [0.5] * 3 + [None] * 4)]
    got = whitening.whiten(spark.createDataFrame(rows, KIND).repartition(4)).collect()
    want = plain(rows)
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == 4 * 170
    for r in got:
        n, deviation, y, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(y, abs=1e-9) and r["explained"] == pytest.approx(explained, rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    sides = {(r["component"], np.sign(r["whitened"])) for r in got if r["vec_id"] in (0, 1000)}
    assert len(sides) == 4  # a copy has the same sign


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, -1.0]), (3, []), (4, [0.0, 0.0, 1.0]), (5, [7.5, 0.25]), (6, [1.0]), (7, [2.0]), (8, None)]
    docs = spark.createDataFrame(rows, KIND).withColumns({"n": F.lit("x"), "component": F.lit(0), "x": F.lit(None)})
    got = sorted(whitening.whiten(docs).collect(), key=str)
    assert len(got) == 4 * 2 + 3 + 2
    assert {(r["vec_id"], r["n"]) for r in got} == {(1, 3), (None, 3), (5, 3), (4, 1), (6, 2), (7, 2)}
    alone = [r for r in got if r["vec_id"] == 4]
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in alone)
    assert {r["whitened"] for r in got if r["vec_id"] in (6, 7)} in ({1.0, -1.0},)
    empty = whitening.whiten(docs.limit(0))
    assert empty.count() == 0 and empty.columns == [*(c.split()[0] for c in whitening.OUT.split(", ")), "identity_error"]


def test_components_without_variance(spark):
    rows = [(i, [float(i), 3.0 * i, 1.0]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame(rows, KIND)).collect()
    assert sorted({(r["component"], r["whitened"] is None, round(r["explained"], 9)) for r in got}) == [(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)]


def test_huge_entries(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [2.0**50, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, KIND)).collect()
    assert all(r["deviation"] is None for r in got) and len(got) == 6


def test_one_long_vector_per_row(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(90, 64)).tolist())]
    got = whitening.whiten(spark.createDataFrame(rows, KIND)).collect()
    want = plain(rows)
    assert all(abs(r["whitened"]) == pytest.approx(want[r["vec_id"], r["component"]][2], abs=1e-8) for r in got)
