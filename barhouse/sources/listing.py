"""Symbol lists: JSON listings of a market, and plain text lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barhouse.functions.clean import short_code

LISTING = "struct<data: array<struct<code: string, name: string>>>"


def listing_codes(document: Column) -> Column:
    """The array of ISINs in a listing document."""
    return F.from_json(document, LISTING).getField("data").getField("code")


def parse_listing(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per listed symbol, as short codes."""
    codes = documents.select(F.explode(listing_codes(F.col(column))).alias("code"))
    return codes.select(short_code(F.col("code")).alias("symbol"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of landed listing documents, one document per file."""
    return parse_listing(spark.read.text(path, wholetext=True))


def all_symbols(*markets: DataFrame) -> DataFrame:
    """Distinct symbols of several markets, sorted."""
    both = reduce(DataFrame.unionByName, [m.select("symbol") for m in markets])
    return both.distinct().orderBy("symbol")


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """A text list, one symbol per line; blanks around and blank lines dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias("symbol"))
    return lines.where("symbol <> ''")


def symbol_list(text: str) -> list[str]:
    """A comma-separated list as given on a command line."""
    return [s for s in (part.strip() for part in text.split(",")) if s]
