"""Exact-row and keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def drop_copies(df: DataFrame) -> DataFrame:
    """Exact-row dedup; rows of one key with other values all stay.

    Copies collapse before the shuffle, so a row repeated very often costs one
    record per task.
    """
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    A minimum over (order, other columns) instead of a ranking window: it is
    reduced on the map side, so one hot key never becomes one big sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_first")
    grouped = df.groupBy(*keys).agg(least)
    return grouped.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def copy_counts(df: DataFrame) -> DataFrame:
    """(rows, distinct_rows, copies) of a table."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return per_row.agg(
        total.alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("copies"),
    )
