"""Stored periods with columns as narrow as their values allow.

Readers always ask for the wide schema, so narrow and wide periods lie side by side.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from barhouse.datasets import Dataset, dataset
from barhouse.operators.reports import INTEGER_TYPES
from barhouse.plans.writers import with_period, write_rows


def narrow_types(rows: DataFrame, which: str | Dataset) -> DataFrame:
    """(period, column -> type...) of rows that carry their period: one pass over the rows.

    Whole numbers get the narrowest integer type that holds them, doubles ``float`` where
    every value comes back from it unchanged. Nulls fit anywhere.
    """
    ds = dataset(which)
    aggs, kinds = [], []
    for name in ds.values:
        value = F.col(name)
        if name in ds.floats:
            kept = value.isNull() | value.cast("float").cast("double").eqNullSafe(value)
            aggs.append(F.min(kept).alias(f"{name}_kept"))
            kinds.append(F.when(F.col(f"{name}_kept"), "float").otherwise("double").alias(name))
        else:
            aggs += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
            kinds.append(_integer(F.col(f"{name}_min"), F.col(f"{name}_max")).alias(name))
    return rows.groupBy("period").agg(*aggs).select("period", *kinds)


def _integer(low: Column, high: Column) -> Column:
    kind = F.lit("bigint")
    for name, least, largest in reversed(INTEGER_TYPES):
        kind = F.when((low >= least) & (high <= largest), name).otherwise(kind)
    return F.when(low.isNull(), INTEGER_TYPES[0][0]).otherwise(kind)


def write_narrow(df: DataFrame, which: str | Dataset, root: str, *, grain: str = "month") -> DataFrame:
    """Store rows as periods, each column as narrow as the period's values allow; returns (period, column -> type...).

    Periods that have the same types are written by one job; how many jobs there are
    depends on the types, not on the calendar. Only the periods that occur are replaced.
    """
    ds = dataset(which)
    rows = with_period(df, ds, grain)
    found = narrow_types(rows, ds).collect()
    alike: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for r in found:
        alike[tuple(r[c] for c in ds.values)].append(r["period"])
    for kinds, periods in sorted(alike.items()):
        typed = {c: F.col(c).cast(kind) for c, kind in zip(ds.values, kinds, strict=True)}
        write_rows(rows.where(F.col("period").isin(periods)).withColumns(typed), ds, root)
    schema = ", ".join(["period string", *(f"{c} string" for c in ds.values)])
    return df.sparkSession.createDataFrame([tuple(r) for r in found], schema)
