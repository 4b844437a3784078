"""Stored periods: which exist, which of them answer a request, their rows.

A period is a year, a month or a day. Our own jobs store it as a folder
``year=2024/period=2024-01-05``; single files named after the period
(``2024.parquet``, ``2024/2024-01.parquet``...), as older tools write them,
are read as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barhouse.datasets import Dataset, dataset
from barhouse.files import Files
from barhouse.functions.routing import TimeBounds

# Period names as a pattern, and the grain numbers in manifests.
PERIOD_NAME = r"^\d{4}(?:-\d{2}){0,2}$"
YEAR, MONTH, DAY = 0, 1, 2

# How a single file stores its times: as Spark reads them, naive or as instants, or as whole micro- or nanoseconds.
_NAIVE, _INSTANT, _MICROS, _NANOS = "timestamp_ntz", "timestamp", "micros", "nanos"
# Files whose schema is asked for at one time.
_AT_ONCE = 16

_MANIFEST = pa.schema([("path", pa.string()), ("period", pa.string()), ("layout", pa.int32())])
_FOLDER, _TOP_FILE, _YEAR_FILE = 0, 1, 2


def list_periods(spark: SparkSession, root: str, years: Iterable[int] | None = None) -> list[tuple[str, str, int]]:
    """(path, name, layout) of what is stored under names that look like periods.

    Folder names are listed, not the data files in them, so the list is
    bounded by the calendar. ``years`` narrows the listing.
    """
    files, base = Files(spark, root), root.rstrip("/")
    year = "{" + ",".join(f"{y:04d}" for y in years) + "}" if years else "[0-9]" * 4
    stem = lambda e: e.name.removesuffix(".parquet")
    folders = files.glob(f"{base}/year={year}/period=*")
    found = [(e.path, e.name.removeprefix("period="), _FOLDER) for e in folders]
    found += [(e.path, stem(e), _TOP_FILE) for e in files.glob(f"{base}/{year}.parquet")]
    nested = [e for e in files.glob(f"{base}/{year}/[0-9]*.parquet") if stem(e)[:4] == e.parent]
    return found + [(e.path, stem(e), _YEAR_FILE) for e in nested]


def period_manifest(spark: SparkSession, root: str, years: Iterable[int] | None = None) -> DataFrame:
    """One row per stored period: path, period, year, month, grain, layout."""
    return manifest_of(spark, list_periods(spark, root, years))


def manifest_of(spark: SparkSession, found: list[tuple[str, str, int]]) -> DataFrame:
    """The manifest of listed names; those that aren't periods are left out."""
    table = pa.table([list(c) for c in zip(*found)] or [[], [], []], schema=_MANIFEST)
    named = spark.createDataFrame(table).where(F.col("period").rlike(PERIOD_NAME))
    length = F.length("period")
    return named.select(
        "path",
        "period",
        F.substring("period", 1, 4).alias("year"),
        F.when(length > 4, F.substring("period", 1, 7)).alias("month"),
        F.when(length == 4, YEAR).when(length == 7, MONTH).otherwise(DAY).alias("grain"),
        "layout",
    )


def resolve_tiers(
    manifest: DataFrame, first_day: str, last_day: str, policy: str = "coarsest"
) -> DataFrame:
    """The manifest rows that answer a request for a range of days.

    ``coarsest``: a stored year hides its months and days, a stored month its
    days. ``union``: everything in range counts, whatever its layout.
    """
    size = F.length("period")
    inside = F.col("period").between(
        F.left(F.lit(first_day), size), F.left(F.lit(last_day), size)
    )
    chosen = manifest.where(inside)
    if policy == "union":
        return chosen
    if policy != "coarsest":
        raise ValueError(f"unknown policy {policy!r}")
    # One period stored in two layouts: the folder wins, then the top file.
    best = F.min("layout").over(Window.partitionBy("period"))
    chosen = chosen.withColumn("_best", best).where("layout = _best").drop("_best")
    of_year = F.min("grain").over(Window.partitionBy("year"))
    of_month = F.min("grain").over(Window.partitionBy("year", "month"))
    ranked = chosen.withColumn("_year", of_year).withColumn("_month", of_month)
    kept = (F.col("grain") == YEAR) | ((F.col("_year") > YEAR) & (F.col("grain") == F.col("_month")))
    return ranked.where(kept).drop("_year", "_month")


def read_periods(
    spark: SparkSession,
    which: str | Dataset,
    root: str,
    paths: list[str],
    bounds: TimeBounds | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """Rows of the given stored periods, with ``year`` and ``period``.

    The wide schema is always given, so narrow columns of older files widen on
    read. Time bounds, if any, reach the Parquet scan of every layout.
    """
    ds = dataset(which)
    folders = [p for p in paths if "/period=" in p]
    single = [p for p in paths if "/period=" not in p]
    reader = spark.read.option("ignoreCorruptFiles", ignore_corrupt)
    parts = []
    if folders or not single:
        schema = f"{ds.ddl}, year int, period string"
        if folders:
            rows = reader.schema(schema).option("basePath", root).parquet(*folders)
        else:
            rows = spark.createDataFrame([], schema)
        parts.append(rows.where(bounds.holds(F.col(ds.time))) if bounds else rows)
    files = _parts_of(Files(spark, root), single)
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        kinds = list(pool.map(lambda path: _time_kind(spark, path, ds.time), files))
    for kind in sorted(set(kinds)):
        parts.append(_single_files(ds, reader, [p for p, k in zip(files, kinds, strict=True) if k == kind], kind, bounds))
    return reduce(DataFrame.unionByName, parts)


def _parts_of(files: Files, paths: list[str]) -> list[str]:
    """The files that folders named like single files hold, and single files themselves."""
    held = [[e.path for e in files.glob(f"{path}/[!_.]*")] for path in paths]
    return [part for path, parts in zip(paths, held, strict=True) for part in parts or [path]]


def _time_kind(spark: SparkSession, path: str, column: str) -> str:
    """How a file stores its times, from the schema that Spark finds in it; every file of a folder is asked on its own.

    Spark knows milli- and microseconds itself. Nanoseconds it refuses, which tells them from whole numbers.
    """
    try:
        schema = spark.read.parquet(path).schema
    except (PySparkException, Py4JJavaError) as e:
        # Anything else wrong with the file is said, or passed over, where its rows are read.
        return _NANOS if "NANOS" in str(e) else _NAIVE
    kind = schema[column].dataType.simpleString() if column in schema.names else _NAIVE
    return _MICROS if kind in ("bigint", "int") else kind


def _single_files(ds: Dataset, reader, paths: list[str], kind: str, bounds: TimeBounds | None) -> DataFrame:
    """Rows of single files that store their times alike."""
    stored = "bigint" if kind in (_MICROS, _NANOS) else kind
    raw = reader.schema(re.sub(rf"\b{ds.time} timestamp_ntz", f"{ds.time} {stored}", ds.ddl)).parquet(*paths)
    value = F.col(ds.time)
    if bounds and stored == "bigint":
        per = 1000 if kind == _NANOS else 1
        raw = raw.where(value.between(_micros(bounds.start) * per, _micros(bounds.end) * per + per - 1))
    elif bounds and kind == _NAIVE:
        raw = raw.where(bounds.holds(value))
    path_period = F.regexp_extract("_metadata.file_path", r"/(\d{4}(?:-\d{2}){0,2})\.parquet(?:/|$)", 1)
    rows = raw.select(
        *[_naive(value, kind).alias(c) if c == ds.time else F.col(c) for c in ds.columns],
        path_period.alias("period"),
    )
    rows = rows.select(*ds.columns, F.substring("period", 1, 4).cast("int").alias("year"), "period")
    return rows.where(bounds.holds(F.col(ds.time))) if bounds else rows


def _naive(stored: Column, kind: str) -> Column:
    if kind == _NAIVE:
        return stored
    thousand = F.lit(1000)
    micros = {
        _INSTANT: F.unix_micros(stored) if kind == _INSTANT else None,
        _MICROS: stored,
        _NANOS: F.call_function("div", stored - F.pmod(stored, thousand), thousand) if kind == _NANOS else None,
    }[kind]
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def _micros(moment) -> int:
    gap = moment - datetime(1970, 1, 1)
    return (gap.days * 86_400 + gap.seconds) * 10**6 + gap.microseconds
