"""Whitening of embeddings on the principal components of their exact integer scatter.

Components become whole numbers, 256 to a unit. Tasks add up exact sums and products of
the different vectors; what reaches the driver is one scatter matrix for each length of
vectors. Its eigenvectors come from its exact characteristic polynomial (``spectrum``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barhouse.llm.common import settled
from barhouse.llm.spectrum import DIGITS, principal

COMPONENTS = 4
SCALE = 256
# Rows multiplied at a time: products of two 16-bit limbs add up exactly in a double over so many.
BLOCK = 1 << 16
LIMB_BITS, LIMBS = 16, 4
# Sums travel as high * 2^60 + low.
LOW_BITS = 60

SUMS = "length int, i int, j int, high decimal(38,0), low decimal(38,0)"
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"


@dataclass(frozen=True)
class Fit:
    """What one length of vectors needs: rows, sums, and eigenvalues and vectors of the scatter times the rows."""

    n: int
    sums: list[int]
    values: list[Decimal]
    vectors: np.ndarray
    trace: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x less the sums, exactly: 64-bit numbers where they fit."""
        most = max([self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))), *map(abs, self.sums)])
        kind = np.int64 if most < 2**61 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Rows on the components: their scatter over n^2 is the covariance, so n cancels out."""
        return centred.astype(np.float64) @ self.vectors.T / np.array([float(v.sqrt()) for v in self.values])

    def deviation(self, centred: np.ndarray) -> pa.Array:
        """Sum of squares of each row; null where it doesn't fit 64 bits."""
        if centred.dtype != object and float(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 2.0**62:
            return pa.array((centred**2).sum(axis=1))
        sums = [sum(int(v) ** 2 for v in row) for row in centred]
        return pa.array([s if s < 2**63 else None for s in sums], pa.int64())


def whole_numbers(vector: Column) -> Column:
    """floor(256 c) of each component as a long; null if the vector or one of its entries is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(vector, lambda c: F.floor(SCALE * c.cast("double"))))


def _matrix(lists: pa.ListArray, length: int) -> np.ndarray:
    return lists.values[lists.offsets[0].as_py() :][: len(lists) * length].to_numpy(zero_copy_only=False).reshape(-1, length)


def _by_length(lists: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of that length, their numbers); empty vectors have no components."""
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        if length:
            taken = lists.take(pa.array(rows))
            for a in range(0, len(rows), BLOCK):
                yield length, rows[a : a + BLOCK], _matrix(taken.slice(a, BLOCK), length)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """16-bit parts as doubles, the last one signed, up to the highest that is needed."""
    out = []
    for k in range(LIMBS):
        fits = x.size == 0 or (int(x.min()) >= -(2 ** (LIMB_BITS - 1)) and int(x.max()) < 2 ** (LIMB_BITS - 1))
        if fits or k == LIMBS - 1:
            return [*out, x.astype(np.float64)]
        out.append((x & (2**LIMB_BITS - 1)).astype(np.float64))
        x = x >> LIMB_BITS
    return out


def exact_products(x: np.ndarray) -> np.ndarray:
    """x^T x of 64-bit numbers as Python numbers; the parts of at most ``BLOCK`` rows add up exactly as doubles."""
    limbs, total = _limbs(x), 0
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB_BITS * (i + j))
    return total


def scatter_sums(fit_list: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """Length of vectors to their number, sums and sums of products, all exact."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch.column(0)):
                ones = np.ones((len(x), 1), np.int64)  # one more column makes the sums and the count
                totals[length] = totals.get(length, 0) + exact_products(np.hstack([x, ones]))
        for length, total in totals.items():
            i, j = np.triu_indices(length + 1)
            values = [int(v) for v in total[i, j]]
            parts = [[Decimal(v >> LOW_BITS) for v in values], [Decimal(v & (1 << LOW_BITS) - 1) for v in values]]
            columns = [pa.array(np.full(len(i), length, np.int32)), *(pa.array(k.astype(np.int32)) for k in (i, j)), *(pa.array(p, pa.decimal128(38)) for p in parts)]
            yield pa.RecordBatch.from_arrays(columns, ["length", "i", "j", "high", "low"])

    rows = fit_list.mapInArrow(partial, SUMS).groupBy("length", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    found: dict[int, list[list[int]]] = {}
    for r in rows:
        table = found.setdefault(r["length"], [[0] * (r["length"] + 1) for _ in range(r["length"] + 1)])
        table[r["i"]][r["j"]] = table[r["j"]][r["i"]] = (int(r["high"]) << LOW_BITS) + int(r["low"])
    return {d: (t[d][d], t[d][:d], [row[:d] for row in t[:d]]) for d, t in found.items()}


def fits_of(fit_list: DataFrame, components: int) -> dict[int, Fit]:
    fits = {}
    for length, (n, sums, products) in scatter_sums(fit_list).items():
        scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(length)] for i in range(length)]
        found = principal(fit_list.sparkSession, scatter, components)
        vectors = np.array([v for _, v in found]).reshape(len(found), length)
        fits[length] = Fit(n, sums, [e for e, _ in found], vectors, sum(scatter[i][i] for i in range(length)))
    return fits


def identity_error(fit_list: DataFrame, fits: dict[int, Fit]) -> float:
    """Largest absolute entry, over all fits, of the covariance of whitened rows less the identity; 0 without components."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch.column(0)):
                fit = fits[length]
                y = np.hstack([fit.whitened(fit.centred(x)), np.ones((len(x), 1))])
                totals[length] = totals.get(length, 0) + y.T @ y
        for length, total in totals.items():
            i, j = np.indices(total.shape)
            columns = [pa.array(np.full(total.size, length, np.int32)), *(pa.array(k.ravel().astype(np.int32)) for k in (i, j)), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["length", "i", "j", "value"])

    rows = fit_list.mapInArrow(partial, "length int, i int, j int, value double").groupBy("length", "i", "j").agg(F.sum("value").alias("value")).collect()
    error = 0.0
    for length, fit in fits.items():
        k = len(fit.values)
        sums = np.zeros((k + 1, k + 1))
        for r in rows:
            if r["length"] == length:
                sums[r["i"], r["j"]] = r["value"] / fit.n
        # The rows are centred exactly before they are multiplied; what is left of the means is rounding.
        covariance = sums[:k, :k] - np.outer(sums[:k, k], sums[k, :k])
        error = max(error, float(np.abs(covariance - np.eye(k)).max(initial=0)))
    return error


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, embedding) on the principal components of the different vectors.

    Returns a row for each kept vector and component, at most ``components`` and as many as
    a vector has entries: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold a null or non-finite entry are left out; empty ones have no
    component. Repeated rows each give their rows, but count once in the fit. Vectors of
    different lengths are fitted apart, each length with its own n; identity_error is the
    largest of all. A component without variance has whitened null, explained 0, or null if no
    component has any. A deviation beyond 64 bits is null. An empty table gives no rows.
    """
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")).where("x is not null")
    fit_list = settled(kept.select("x").distinct(), "whitening")
    fits = fits_of(fit_list, components)
    error = identity_error(fit_list, fits)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _by_length(batch.column(1)):
                fit, ids = fits[length], batch.column(0).take(pa.array(rows))
                centred = fit.centred(x)
                deviation, whitened = fit.deviation(centred), fit.whitened(centred)
                for k in range(min(components, length)):
                    known = k < len(fit.values)
                    share = float(fit.values[k] / fit.trace) if known else 0.0 if fit.trace else None
                    columns = [
                        ids,
                        pa.array(np.full(len(x), k + 1, np.int32)),
                        pa.array(np.full(len(x), fit.n, np.int64)),
                        deviation,
                        pa.array(whitened[:, k]) if known else pa.nulls(len(x), pa.float64()),
                        pa.array([share] * len(x), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])

    return kept.mapInArrow(project, OUT).withColumn("identity_error", F.lit(error))
