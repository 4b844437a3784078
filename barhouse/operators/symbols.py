"""Restricting rows to a list of symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def restrict_to_symbols(df: DataFrame, symbols: DataFrame | list[str]) -> DataFrame:
    """Keep the rows whose symbol is listed.

    A Python list becomes an IN filter that reaches the scan. A table of
    symbols takes the ordinary semi join: Spark broadcasts it if its bytes allow,
    and AQE splits hot symbols if they don't.
    """
    if isinstance(symbols, list):
        return df.where(F.col("symbol").isin(symbols))
    return df.join(symbols.select("symbol"), "symbol", "left_semi")
