"""Digests of text days and of the days in stored periods, kept beside the lake.

Every row has a hash, a day the sum of its rows' hashes, a month that of its days and a
year that of its months. Days are remembered together with a stamp of the files they were
read from: their names, sizes and times. As long as the stamp holds, the digest does, and
no data file is opened to compare both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barhouse.datasets import Dataset
from barhouse.files import Files
from barhouse.operators.dedup import drop_copies
from barhouse.operators.fingerprint import fingerprint
from barhouse.operators.reconcile import period_of
from barhouse.sources.periods import read_periods
from barhouse.sources.text_days import DAY_FILE, read_text

_HOME = "_digests"
TEXT, STORED, ACCEPTED = "text", "stored", "accepted"
_ROW = "side string, name string, stamp string, day string, rows bigint, digest decimal(38,0)"

# Fixed value: where a period's name ends in the path of one of its files.
_PERIOD_PATH = r"^(.*?/(?:period=\d{4}(?:-\d{2}){0,2}|\d{4}(?:-\d{2}){0,2}\.parquet))(?:/|$)"


def _stamps(files: DataFrame, name: Column) -> dict[str, str]:
    """What each name's files look like from outside, in any order of listing."""
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    per_name = files.groupBy(name.alias("name")).agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(mark)).alias("stamp"))
    return {r["name"]: r["stamp"] for r in per_name.collect()}


def text_stamps(spark: SparkSession, text_root: str) -> dict[str, str]:
    """Day to stamp; files are listed, not opened."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=DAY_FILE).load(text_root)
    return _stamps(found, F.element_at(F.split("path", "/"), -1).substr(1, 10))


def period_stamps(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Path of a stored period to stamp; files are listed, not opened."""
    if not paths:
        return {}
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True).load(paths)
    data = found.where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    return _stamps(data, F.regexp_extract("path", _PERIOD_PATH, 1))


class Catalogue:
    """The digests known of one lake; rows are only ever added, and count while their stamp is the files' own.

    Known days are held on the driver: they are bounded by the calendar.
    """

    def __init__(self, spark: SparkSession, ds: Dataset, root: str):
        self._spark, self._ds = spark, ds
        files = Files(spark, root)
        self._home = f"{files.qualified(root)}/{_HOME}"
        known = spark.read.schema(_ROW).parquet(self._home).collect() if files.exists(self._home) else []
        self._known: dict[tuple[str, str, str], dict[str, tuple[int, int]]] = {}
        self._new: list[tuple] = []
        for r in known:
            self._put(r["side"], r["name"], r["stamp"], r["day"], (r["rows"], int(r["digest"])))

    def _put(self, side: str, name: str, stamp: str, day: str, mark: tuple[int, int]) -> None:
        self._known.setdefault((side, name, stamp), {})[day] = mark

    def add(self, side: str, name: str, stamp: str, days: dict[str, tuple[int, int]]) -> None:
        """Remember a name's days; one without rows is remembered too."""
        for day, (rows, digest) in (days or {"": (0, 0)}).items():
            self._put(side, name, stamp, day, (rows, digest))
            self._new.append((side, name, stamp, day, rows, digest))

    def save(self) -> None:
        """Append what is new; a run that dies before has remembered nothing."""
        if self._new:
            # The digest travels as text: Python's whole numbers aren't decimals.
            rows = [(*row[:5], str(row[5])) for row in self._new]
            table = self._spark.createDataFrame(rows, _ROW.replace("decimal(38,0)", "string"))
            table.withColumn("digest", F.col("digest").cast("decimal(38,0)")).coalesce(1).write.mode("append").parquet(self._home)
            self._new = []

    def knows(self, side: str, name: str, stamp: str) -> bool:
        return (side, name, stamp) in self._known

    def days(self, side: str, stamps: dict[str, str]) -> dict[str, tuple[int, int]]:
        """Day to (rows, digest) of the given names, as far as known under their stamps."""
        found: dict[str, tuple[int, int]] = {}
        for name, stamp in stamps.items():
            found.update(self._known.get((side, name, stamp), {}))
        found.pop("", None)
        return found

    def text_days(self, text_root: str, stamps: dict[str, str]) -> dict[str, tuple[int, int]]:
        """(rows, digest) of the distinct rows of text days; only days whose files changed are read."""
        unread = sorted(day for day, stamp in stamps.items() if not self.knows(TEXT, day, stamp))
        if unread:
            read = day_digests(drop_copies(read_text(self._spark, self._ds, text_root, days=unread)), self._ds)
            for day in unread:
                self.add(TEXT, day, stamps[day], {day: read[day]} if day in read else {})
        return self.days(TEXT, stamps)

    def stored_days(self, root: str, paths: list[str]) -> dict[str, tuple[int, int]]:
        """(rows, digest) of the days in stored periods; only periods whose files changed are read."""
        stamps = period_stamps(self._spark, paths)
        unread = sorted(p for p, stamp in stamps.items() if not self.knows(STORED, p, stamp))
        if unread:
            rows = read_periods(self._spark, self._ds, root, unread)
            read = {path: {} for path in unread}
            by_name = {_name_of(path): path for path in unread}
            for (name, day), mark in _digests(rows, self._ds, ["period", "day"]).items():
                read[by_name[name]][day] = mark
            for path, days in read.items():
                self.add(STORED, path, stamps[path], days)
        return self.days(STORED, stamps)


def _name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1].removeprefix("period=").removesuffix(".parquet")


def _digests(rows: DataFrame, ds: Dataset, by: list[str]) -> dict[tuple, tuple[int, int]]:
    """Digests of days, below other groups if any: a day's name is part of its rows' hashes."""
    with_day = rows.withColumn("day", period_of(ds, "day"))
    found = fingerprint(with_day, ds, "day") if by == ["day"] else fingerprint(with_day, ds, "day", by[:-1])
    return {tuple(r[c] for c in by): (r["rows"], int(r["digest"])) for r in found.collect()}


def day_digests(rows: DataFrame, ds: Dataset) -> dict[str, tuple[int, int]]:
    """Day to (rows, digest) of a table."""
    return {day: mark for (day,), mark in _digests(rows, ds, ["day"]).items()}


def digest_tree(spark: SparkSession, **sides: dict[str, tuple[int, int]]) -> DataFrame:
    """(node, rows_<side>..., same) for every day, month and year of two sides' digests, and for all (node ``all``)."""
    rows = [(side, day, n, str(digest)) for side, days in sides.items() for day, (n, digest) in days.items()]
    table = spark.createDataFrame(rows, "side string, day string, rows bigint, digest string")
    parts = [F.col("day").substr(1, n).alias(name) for name, n in (("year", 4), ("month", 7))]
    aggs = []
    for side in sides:
        here = F.col("side") == side
        aggs.append(F.coalesce(F.sum(F.when(here, F.col("rows"))), F.lit(0)).alias(f"rows_{side}"))
        digest = F.sum(F.when(here, F.col("digest").cast("decimal(38,0)")))
        aggs.append(F.coalesce(digest, F.lit(0).cast("decimal(38,0)")).alias(f"digest_{side}"))
    tree = table.select("*", *parts).rollup("year", "month", "day").agg(*aggs)
    first, *others = sides
    alike = [F.col(f"{what}_{first}") == F.col(f"{what}_{side}") for what in ("rows", "digest") for side in others]
    node = F.coalesce("day", "month", "year", F.lit("all")).alias("node")
    return tree.select(node, *[f"rows_{side}" for side in sides], reduce(Column.__and__, alike).alias("same"))
