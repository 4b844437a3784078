"""Content fingerprints that don't depend on file layout, with and without the order of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barhouse.datasets import Dataset, dataset


def row_hash(*columns: str) -> Column:
    """64-bit row hash, as a decimal so that sums can't overflow."""
    return F.xxhash64(*columns).cast("decimal(20,0)")


def digest(ds: Dataset, *extra: str) -> list[Column]:
    """The two aggregates that make up a fingerprint."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash(*ds.columns, *extra)), F.lit(0).cast("decimal(30,0)")).alias("digest"),
    ]


def fingerprint(df: DataFrame, which: str | Dataset, by: str | None = None, below: list[str] | None = None) -> DataFrame:
    """(rows, digest) of a table, or of each of its groups; with ``below``, of the groups inside other ones.

    Columns are cast to the stored types first: the hash of an INT differs
    from that of the same BIGINT, and FLOAT from DOUBLE. A group's name is
    part of its digest, so the digests of all groups add up to one that also
    tells where each row belongs. Names of the groups in ``below`` aren't.
    """
    ds, outer = dataset(which), below or []
    extra = [by] if by else []
    return ds.canonical(df, *outer, *extra).groupBy(*outer, *extra).agg(*digest(ds, *extra))


# Two primes whose products fit a BIGINT, and the bases of their polynomials.
PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 1_664_525)

# Rows of a task are numbered by 33 bits, which powers take 8 at a time.
_ROW_BITS, _DIGIT_BITS = 33, 8


def _power(base: int, exponent: Column, prime: int) -> Column:
    """base^exponent modulo a prime, from a table for each digit of the exponent."""
    factors = []
    for low in range(0, _ROW_BITS, _DIGIT_BITS):
        step = pow(base, 1 << low, prime)
        table = F.lit([pow(step, k, prime) for k in range(1 << _DIGIT_BITS)]).cast("array<bigint>")
        factors.append(F.get(table, F.shiftright(exponent, low).bitwiseAND(F.lit((1 << _DIGIT_BITS) - 1)).cast("int")))
    return reduce(lambda a, b: a * b % prime, factors)


def ordered_fingerprint(df: DataFrame, order: list[str], row: Column | None = None) -> DataFrame:
    """(rows, digest) of a table's rows in an order: one BIGINT that a swap of two rows changes.

    The digest is the polynomial whose coefficients are the rows' hashes, at two bases
    modulo two primes. Rows are dealt to tasks by ranges of the order; each sums up its
    own stretch, and the sums are put together by the number of rows before them, so
    any partitioning gives the same digest, no task sees all rows, and a row for each
    task reaches the driver.

    ``row`` is a row's hash, xxhash64 of all columns unless given. Rows that are equal in
    ``order`` go by their hash; a stretch of equal ones is spread over tasks.
    """
    hashed = df.select(*order, F.coalesce(F.xxhash64(*df.columns) if row is None else row, F.lit(0)).alias("_hash"))
    spread = hashed.withColumn("_from", F.spark_partition_id()).repartitionByRange(*order, "_hash", "_from")
    placed = spread.sortWithinPartitions(*order, "_hash").select("_hash", F.monotonically_increasing_id().alias("_at"))
    at = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    terms = [F.sum(F.pmod("_hash", F.lit(p)) * _power(b, at, p) % p).alias(f"_{p}") for p, b in zip(PRIMES, BASES, strict=True)]
    parts = placed.groupBy(F.shiftright("_at", _ROW_BITS).alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), *terms).collect()
    before, sums = 0, [0] * len(PRIMES)
    for part in sorted(parts, key=lambda r: r["_part"]):
        sums = [(s + part[f"_{p}"] * pow(b, before, p)) % p for s, p, b in zip(sums, PRIMES, BASES, strict=True)]
        before += part["_rows"]
    return df.sparkSession.createDataFrame([(before, (sums[0] << 31) + sums[1])], "rows bigint, digest bigint")
