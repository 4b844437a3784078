"""Comparing text originals with stored Parquet.

Both sides are laid on top of each other and grouped by key once, instead of
being deduplicated and joined: copies collapse on the map side, keys missing on
either side show up in the same pass, and a key with many rows never fans out
into pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barhouse.datasets import GRAINS, NAME_LENGTH, Dataset, dataset

# Tolerances within which two floats count as equal.
RELATIVE, ABSOLUTE = 1e-5, 1e-8

SIDES = ("txt", "pq")


def is_close(a: Column, b: Column) -> Column:
    """Equal within tolerance of ``b``; NaN equals NaN, NULL equals NULL."""
    near = F.abs(a - b) <= ABSOLUTE + RELATIVE * F.abs(b)
    finite = ~a.isin(float("inf"), float("-inf")) & ~b.isin(float("inf"), float("-inf"))
    return a.eqNullSafe(b) | F.coalesce(near & finite & ~F.isnan(a) & ~F.isnan(b), F.lit(False))


def period_of(ds: Dataset, grain: str) -> Column:
    """The name of the period a row falls in."""
    day = F.col(ds.time).cast("date").cast("string")
    return F.substring(day, 1, NAME_LENGTH[grain])


def align(txt: DataFrame, pq: DataFrame, which: str | Dataset) -> DataFrame:
    """One row per key with the values of both sides.

    ``rows_<side>`` counts rows, copies included; ``mixed_<side>`` marks a key
    whose rows on that side differ from each other. Where a side isn't mixed,
    ``<column>_<side>`` is its value.
    """
    ds = dataset(which)
    tagged = ds.canonical(txt).withColumn("_pq", F.lit(False)).unionByName(
        ds.canonical(pq).withColumn("_pq", F.lit(True))
    )
    aggs, outputs = [], []
    for side in SIDES:
        here = F.col("_pq") if side == "pq" else ~F.col("_pq")
        aggs.append(F.count(F.when(here, 1)).alias(f"rows_{side}"))
        mixed = F.lit(False)
        for c in ds.values:
            value = F.when(here, F.col(c))
            least, most, known = (f"{c}_{side}", f"_{c}_{side}_max", f"_{c}_{side}_known")
            aggs += [F.min(value).alias(least), F.max(value).alias(most), F.count(value).alias(known)]
            some_null = (F.col(known) > 0) & (F.col(known) < F.col(f"rows_{side}"))
            mixed = mixed | some_null | ~F.col(least).eqNullSafe(F.col(most))
            outputs.append(F.col(least))
        outputs += [F.col(f"rows_{side}"), mixed.alias(f"mixed_{side}")]
    return tagged.groupBy(*ds.key).agg(*aggs).select(*ds.key, *outputs)


def _flags(ds: Dataset) -> dict[str, Column]:
    in_txt, in_pq = F.col("rows_txt") > 0, F.col("rows_pq") > 0
    mixed = F.col("mixed_txt") | F.col("mixed_pq")
    return {
        "text_keys": in_txt,
        "parquet_keys": in_pq,
        "missing_in_parquet": in_txt & ~in_pq,
        "missing_in_text": in_pq & ~in_txt,
        "duplicate_keys": in_txt & in_pq & mixed,
        "matched": in_txt & in_pq & ~mixed,
    }


def _differs(ds: Dataset, column: str) -> Column:
    a, b = F.col(f"{column}_txt"), F.col(f"{column}_pq")
    same = is_close(a, b) if column in ds.floats else a.eqNullSafe(b)
    return _flags(ds)["matched"] & ~same


def _count(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def reconcile_summary(aligned: DataFrame, which: str | Dataset, grain: str) -> DataFrame:
    """Per period: keys on each side, missing ones, mismatches, verdict.

    A period is ``ok`` when every text key is stored, no compared key is mixed
    and no value differs. Keys only in Parquet are counted but don't fail it.
    """
    ds = dataset(which)
    counts = [_count(flag).alias(name) for name, flag in _flags(ds).items()]
    wrong = [_count(_differs(ds, c)) for c in ds.values]
    total = wrong[0]
    for w in wrong[1:]:
        total = total + w
    per_period = aligned.groupBy(period_of(ds, grain).alias("period")).agg(*counts, total.alias("mismatches"))
    failures = F.col("missing_in_parquet") + F.col("duplicate_keys") + F.col("mismatches")
    return per_period.withColumn("ok", failures == 0)


def reconcile_columns(aligned: DataFrame, which: str | Dataset, grain: str) -> DataFrame:
    """Per period and value column: mismatches, and the first one by key."""
    ds = dataset(which)
    aggs = []
    for c in ds.values:
        pair = F.struct(*ds.key, F.col(f"{c}_txt").alias("txt"), F.col(f"{c}_pq").alias("pq"))
        aggs += [
            _count(_differs(ds, c)).alias(f"{c}_n"),
            F.min(F.when(_differs(ds, c), pair)).alias(f"{c}_first"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_n").alias("mismatches"),
            F.col(f"{c}_first.symbol").alias("sample_symbol"),
            F.col(f"{c}_first.txt").cast("string").alias("sample_txt"),
            F.col(f"{c}_first.pq").cast("string").alias("sample_pq"),
        )
        for c in ds.values
    ]
    per_period = aligned.groupBy(period_of(ds, grain).alias("period")).agg(*aggs)
    return per_period.select("period", F.inline(F.array(*lines)))


def reconcile_rollup(aligned: DataFrame, which: str | Dataset) -> DataFrame:
    """The summary of every day, month and year and of all (``all``), from one pass: (grain, period, counts..., ok)."""
    days = reconcile_summary(aligned, which, "day")
    counts = [c for c in days.columns if c not in ("period", "ok")]
    # Only the calendar is rolled up, not the keys.
    parts = [F.substring("period", 1, NAME_LENGTH[g]).alias(g) for g in GRAINS]
    rolled = days.select(*parts, *counts).rollup(*GRAINS).agg(*[F.sum(c).alias(c) for c in counts])
    grain = F.when(F.col("day").isNotNull(), "day").when(F.col("month").isNotNull(), "month").when(F.col("year").isNotNull(), "year")
    failures = F.col("missing_in_parquet") + F.col("duplicate_keys") + F.col("mismatches")
    period = F.coalesce("day", "month", "year", F.lit("all"))
    return rolled.select(F.coalesce(grain, F.lit("all")).alias("grain"), period.alias("period"), *counts, (failures == 0).alias("ok"))


def mismatch_samples(aligned: DataFrame, which: str | Dataset, grain: str, n: int) -> DataFrame:
    """The first ``n`` mismatches by key of each period and column: (period, column, place, key, txt, pq).

    Each task keeps only the first ``n`` of a period and column before the shuffle, so what
    is ranked at last is bounded by tasks, whatever the number of mismatches.
    """
    ds = dataset(which)
    period = period_of(ds, grain).alias("period")
    found = mismatching_rows(aligned, ds).select(period, "column", *ds.key, "txt", "pq")
    first = Window.partitionBy("period", "column").orderBy(*ds.key)
    ranked = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n)
    return ranked.select("period", "column", "place", *ds.key, "txt", "pq")


def mismatching_rows(aligned: DataFrame, which: str | Dataset) -> DataFrame:
    """Every differing value: key, column, both values as text."""
    ds = dataset(which)
    cells = [
        F.when(
            _differs(ds, c),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}_txt").cast("string").alias("txt"),
                F.col(f"{c}_pq").cast("string").alias("pq"),
            ),
        )
        for c in ds.values
    ]
    return aligned.select(*ds.key, F.inline(F.array_compact(F.array(*cells))))


def matched_pairs(txt: DataFrame, pq: DataFrame, which: str | Dataset) -> DataFrame:
    """Keys on both sides with both sides' values, ``_txt`` and ``_pq``.

    Keys with several different rows can't be paired one to one; they are in
    :func:`duplicate_key_rows`.
    """
    ds = dataset(which)
    values = [f"{c}_{side}" for c in ds.values for side in SIDES]
    return align(txt, pq, ds).where(_flags(ds)["matched"]).select(*ds.key, *values)


def missing_rows(have: DataFrame, lack: DataFrame, which: str | Dataset) -> DataFrame:
    """Distinct rows of one side whose key the other side doesn't have."""
    ds = dataset(which)
    known = lack.select(*ds.key).dropDuplicates()
    return ds.canonical(have).dropDuplicates().join(known, ds.key, "left_anti")


def duplicate_key_rows(df: DataFrame, which: str | Dataset) -> DataFrame:
    """(key, distinct_rows) of keys that hold several different rows."""
    ds = dataset(which)
    distinct = ds.canonical(df).dropDuplicates()
    counted = distinct.groupBy(*ds.key).agg(F.count(F.lit(1)).alias("distinct_rows"))
    return counted.where("distinct_rows > 1")


def conversion_check(
    txt: DataFrame, pq: DataFrame, which: str | Dataset, int_tolerance: bool = False
) -> DataFrame:
    """Per day: does Parquet hold exactly the distinct rows of the text?

    (day, text_rows, parquet_rows, differing, converted). Floats are compared
    within tolerance, whole numbers exactly unless ``int_tolerance``. Groups
    with several rows must agree exactly in their close columns: at worst such
    a day is converted once more.
    """
    ds = dataset(which)
    close = ds.values if int_tolerance else ds.floats
    exact = [c for c in ds.columns if c not in close]
    both = ds.canonical(txt).withColumn("_pq", F.lit(False)).unionByName(
        ds.canonical(pq).withColumn("_pq", F.lit(True))
    )
    groups = both.groupBy(*ds.columns).agg(
        F.max(F.when(F.col("_pq"), 0).otherwise(1)).cast("bigint").alias("rows_txt"),
        _count(F.col("_pq")).alias("rows_pq"),
    )
    same = F.col("rows_txt") == F.col("rows_pq")
    if close:
        groups, agrees = _close_groups(groups, exact, close)
        same = same & agrees
    per_day = groups.groupBy(F.col(ds.time).cast("date").cast("string").alias("day")).agg(
        F.sum("rows_txt").alias("text_rows"),
        F.sum("rows_pq").alias("parquet_rows"),
        _count(~same).alias("differing"),
    )
    return per_day.withColumn("converted", F.col("differing") == 0)


def _close_groups(groups: DataFrame, exact: list[str], close: list[str]) -> tuple[DataFrame, Column]:
    """Groups of rows alike in their exact columns, and whether the close
    columns of both sides agree."""
    aggs, near = [], F.lit(True)
    hashed = F.xxhash64(*close).cast("decimal(20,0)")
    for side in SIDES:
        rows = F.col(f"rows_{side}")
        aggs.append(F.sum(rows).alias(f"rows_{side}"))
        aggs.append(F.sum(F.when(rows > 0, hashed * rows.cast("decimal(18,0)"))).alias(f"digest_{side}"))
        aggs += [F.min(F.when(rows > 0, F.col(c))).alias(f"{c}_{side}") for c in close]
    for c in close:
        near = near & is_close(F.col(f"{c}_txt").cast("double"), F.col(f"{c}_pq").cast("double"))
    one = (F.col("rows_txt") == 1) & (F.col("rows_pq") == 1)
    alike = F.when(one, near).otherwise(F.col("digest_txt").eqNullSafe(F.col("digest_pq")))
    return groups.groupBy(*exact).agg(*aggs), alike
