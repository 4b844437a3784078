"""Largest eigenvalues and their vectors of a symmetric integer matrix, by its exact characteristic polynomial.

The polynomial is found modulo many primes, each in a Spark task of its own, and put
together by the Chinese remainder theorem. All its roots are real, so by Descartes' rule
the signs of the polynomial shifted by ``a`` count the roots above ``a`` exactly, with
their multiplicity. Vectors come from the null space of the matrix less the root.

Everything here grows with the matrix, not with the rows that it was made from.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Bits to which roots are found, below a bound of all roots, and decimal digits of the null-space arithmetic.
ROOT_BITS = 120
DIGITS = 90
# Solves per vector; each gains as many digits as the root has beyond its distance to the next one.
SOLVES = 3


def primes_below(limit: int, product: int) -> list[int]:
    """The largest primes below ``limit`` (at most 2^31), until they multiply to more than ``product``."""
    found, n, total = [], limit | 1, 1
    while total <= product:
        n -= 2
        # These four bases decide primality below 3,215,031,751.
        if all(_strong(n, a) for a in (2, 3, 5, 7)):
            found.append(n)
            total *= n
    return found


def _strong(n: int, base: int) -> bool:
    odd = n - 1
    while odd % 2 == 0:
        odd //= 2
    x = pow(base, odd, n)
    while odd < n - 1 and x not in (1, n - 1):
        x, odd = x * x % n, odd * 2
    return x == n - 1 or odd % 2 == 1


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a prime below 2^31, that of x^0 first."""
    h, d = (matrix % p).astype(np.int64), len(matrix)
    # Similar matrices with nothing below the first subdiagonal.
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if len(below) == 0:
            continue
        i = k + int(below[0])
        h[[k, i]] = h[[i, k]]
        h[:, [k, i]] = h[:, [i, k]]
        times = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - times[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * times % p).sum(axis=1)) % p
    # Polynomials of the leading blocks.
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, d + 1):
        polys[m, 1:] = polys[m - 1, :-1]
        weight, product = np.zeros(m, np.int64), 1
        for i in range(m - 1, -1, -1):
            weight[i] = int(h[i, m - 1]) * product % p
            product = product * int(h[i, i - 1]) % p if i else product
        polys[m] = (polys[m] - (weight[:, None] * polys[:m] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - matrix) for a positive semidefinite matrix, that of x^0 first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The k-th symmetric function of roots that add up to the trace is largest if all are equal.
    bound = max([1, *(comb(d, k) * trace**k // d**k + 1 for k in range(1, d + 1))])
    primes = primes_below(2**31, 2 * bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(matrix, object).reshape(d, d)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_modulo(whole, p).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([found], pa.list_(pa.int64()))], ["p", "found"])

    tasks = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    rows = tasks.mapInArrow(residues, "p bigint, found array<bigint>").collect()
    product = 1
    for p in primes:
        product *= p
    coefficients = [0] * (d + 1)
    for row in rows:
        rest = product // row["p"]
        unit = rest * pow(rest, -1, row["p"])
        for k, r in enumerate(row["found"]):
            coefficients[k] += r * unit
    coefficients = [c % product for c in coefficients]
    return [c - product if 2 * c > product else c for c in coefficients]


def _scaled(coefficients: list[int], at: int, bits: int) -> tuple[list[int], int]:
    """The polynomial of 2^bits x, with integer coefficients, and a place ``at`` / 2^bits as a whole number."""
    while bits and at % 2 == 0:
        at, bits = at // 2, bits - 1
    d = len(coefficients) - 1
    return [c << bits * (d - k) for k, c in enumerate(coefficients)], at


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """How many roots of a real-rooted polynomial are above ``at`` / 2^bits, multiple ones several times."""
    c, a = _scaled(coefficients, at, bits)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(coefficients: list[int], at: int, bits: int) -> int:
    c, a = _scaled(coefficients, at, bits)
    value = 0
    for x in reversed(c):
        value = value * a + x
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], count: int, bound: int) -> list[tuple[int, int, int]]:
    """The ``count`` largest positive roots: (low, bits, how many) from the largest on.

    Between ``low`` / 2^bits and 2^-bits more lie so many roots, which are equal to ``ROOT_BITS`` bits below ``bound``.
    """
    bits = max(0, ROOT_BITS - bound.bit_length())
    out, todo = [], [(0, bound + 1 << bits, roots_above(coefficients, 0, bits), 0)]
    while todo and sum(n for *_, n in out) < count:
        low, high, over_low, over_high = todo.pop()  # roots in (low, high]
        n = over_low - over_high
        if n == 0:
            continue
        if n == 1 and _sign(coefficients, high, bits):
            # One simple root inside: the sign tells its side.
            above = _sign(coefficients, high, bits)
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if _sign(coefficients, middle, bits) in (0, above) else (middle, high)
        if high - low <= 1:
            out.append((low, bits, n))
            continue
        middle = (low + high) // 2
        over = roots_above(coefficients, middle, bits)
        todo += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return out


def _orthogonal(y: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for v in others:
        y = y - v * sum(y * v)
    return y / sum(y * y).sqrt()


def null_vectors(matrix: list[list[int]], low: int, bits: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors that the matrix less the root at ``low`` / 2^bits maps nearly to nothing."""
    with localcontext(Context(prec=DIGITS)):
        root = (2 * Decimal(low) + 1) / (2 * Decimal(2) ** bits)
        d = len(matrix)
        a = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(d, d)
        a[np.arange(d), np.arange(d)] -= root
        least = max(abs(a).max(), Decimal(1)) * Decimal(10) ** (5 - DIGITS)
        order = np.arange(d)
        for k in range(d):  # lower factors stay where they have made zeros
            best = k + int(np.argmax(abs(a[k:, k])))
            a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, k + 1 :]
        random, found = np.random.default_rng(12), []
        for _ in range(count):
            y = np.array([Decimal(int(x)) for x in random.integers(1, 1000, d)], object)
            for _ in range(SOLVES):
                y = y[order]
                for k in range(1, d):
                    y[k] -= sum(a[k, :k] * y[:k])
                for k in range(d - 1, -1, -1):
                    y[k] = (y[k] - sum(a[k, k + 1 :] * y[k + 1 :])) / a[k, k]
                y = _orthogonal(y / abs(y).max(), found)
            found.append(y)
        return [[float(x) for x in y] for y in found]


def principal(spark: SparkSession, matrix: list[list[int]], count: int) -> list[tuple[Decimal, list[float]]]:
    """(eigenvalue, unit vector) of the ``count`` largest eigenvalues of a positive semidefinite matrix, zeros left out."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if trace == 0:
        return []
    out: list[tuple[Decimal, list[float]]] = []
    for low, bits, n in largest_roots(characteristic_polynomial(spark, matrix), count, trace):
        with localcontext(Context(prec=DIGITS)):
            value = (2 * Decimal(low) + 1) / (2 * Decimal(2) ** bits)
        out += [(value, v) for v in null_vectors(matrix, low, bits, n)]
    return out[:count]
