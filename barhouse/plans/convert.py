"""Migration of text day files into stored days."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barhouse.datasets import NAME_LENGTH, Dataset, dataset
from barhouse.files import Files
from barhouse.functions.routing import TimeBounds, time_bounds
from barhouse.operators.dedup import drop_copies
from barhouse.operators.reconcile import conversion_check
from barhouse.plans.compact import Target, recover, store_periods
from barhouse.plans.digests import ACCEPTED, TEXT, Catalogue, text_stamps
from barhouse.plans.writers import with_period, write_rows
from barhouse.sources.periods import list_periods, manifest_of, read_periods, resolve_tiers
from barhouse.sources.text_days import read_text, text_days

_PENDING = "day string, reason string"


def pending_days(
    spark: SparkSession, text_root: str, which: str | Dataset, root: str, int_tolerance: bool = False, remember: bool = False
) -> DataFrame:
    """(day, reason) of text days to convert: ``new`` ones, and ``stale`` ones
    whose stored rows aren't the distinct rows of the text.

    Days without stored rows are told from the file names alone; only the
    others are read and compared, all in one job. With ``remember``, digests of
    both sides are kept beside the lake, and only days whose text files or stored
    period changed since are read (:mod:`barhouse.plans.digests`).
    """
    new, stale = _pending(spark, text_root, dataset(which), root, int_tolerance, remember)
    fresh = spark.createDataFrame([(day, "new") for day in new], _PENDING)
    return fresh if stale is None else fresh.unionByName(stale)


def convert_text(
    spark: SparkSession, text_root: str, which: str | Dataset, root: str, int_tolerance: bool = False, remember: bool = False
) -> DataFrame:
    """Convert every pending day in one job; returns (day, reason).

    Copies of a row are dropped, days already converted are left alone, and
    running it again does nothing. A stale day inside a stored month or year is
    replaced there: the period is staged anew, read back and put in place.

    With ``remember``, the days are read back and held against what was written, and their
    digests kept: the next run opens no file of a day that hasn't changed.
    """
    ds = dataset(which)
    stamps = text_stamps(spark, text_root) if remember else {}
    new, stale = _pending(spark, text_root, ds, root, int_tolerance, remember)
    pending = [(day, "new") for day in new]
    if stale is not None:
        pending += [tuple(r) for r in stale.collect()]
    stored = _stored(spark, root, [day for day, reason in pending if reason == "stale"])
    inside = [day for day, _ in pending if day[:7] in stored or day[:4] in stored]
    apart = [day for day, _ in pending if day not in inside]
    rows = lambda days: drop_copies(read_text(spark, ds, text_root, days=days))
    if apart:
        handed = Observation()
        write_rows(with_period(rows(apart), ds, "day"), ds, root, layout="rebalance", observation=handed if remember else None)
        if remember:
            _remember(spark, ds, root, apart, stamps, handed)
    if inside:
        _replace(spark, ds, root, rows(inside), inside, stored)
    return spark.createDataFrame(sorted(pending), _PENDING)


class ConversionError(RuntimeError):
    """Stored days didn't read back as written."""


def _remember(spark: SparkSession, ds: Dataset, root: str, days: list[str], stamps: dict[str, str], handed: Observation) -> None:
    """Read stored days back and keep their digests for both sides.

    A day's name is part of its rows' hashes in either sum, so totals over all days suffice.
    A day that held no row has no folder, and its text is read again.
    """
    paths = [path for found in _stored(spark, root, days).values() for path in found if path.rsplit("=", 1)[-1] in days]
    catalogue = Catalogue(spark, ds, root)
    saved = catalogue.stored_days(root, paths)
    total = [sum(column) for column in zip(*saved.values(), strict=True)] or [0, 0]
    if total != [handed.get["rows"], int(handed.get["digest"])]:
        raise ConversionError("stored days aren't as written")
    for day, mark in saved.items():
        catalogue.add(TEXT, day, stamps[day], {day: mark})
    catalogue.save()


def _stored(spark: SparkSession, root: str, days: list[str]) -> dict[str, list[str]]:
    """Paths of everything stored under the name of one of the days, its month or its year."""
    names = {part for d in days for part in (d, d[:7], d[:4])}
    found: dict[str, list[str]] = {}
    if days:
        for path, name, _ in list_periods(spark, root, sorted({int(d[:4]) for d in days})):
            if name in names:
                found.setdefault(name, []).append(path)
    return found


def _replace(
    spark: SparkSession, ds: Dataset, root: str, rows: DataFrame, days: list[str], stored: dict[str, list[str]]
) -> None:
    """Put the days' rows in the place of what stored months and years hold of those days.

    Months go first: if the run dies in between, the year still tells the day is
    stale. Days stored beside them are deleted, or a later compaction would bring their rows back.
    """
    base = Files(spark, root).qualified(root)
    recover(spark, base)
    fresh = F.col(ds.time).cast("date").isin([date.fromisoformat(d) for d in days])
    parts, targets = [], []
    for grain in ("month", "year"):
        names = sorted({d[: NAME_LENGTH[grain]] for d in days} & set(stored))
        if names:
            held = read_periods(spark, ds, base, [p for n in names for p in stored[n]])
            parts += [held.where(~fresh), with_period(rows, ds, grain).where(F.col("period").isin(names))]
            for name in names:
                own = [p for d in days if d.startswith(name) for p in stored.get(d, [])]
                targets.append(Target(name, own, stored[name], [], []))
    store_periods(spark, ds, base, drop_copies(reduce(DataFrame.unionByName, parts)), targets)


def _pending(
    spark: SparkSession, text_root: str, ds: Dataset, root: str, int_tolerance: bool, remember: bool
) -> tuple[list[str], DataFrame | None]:
    """New days, and a table of the stale ones among the others, if any."""
    new, compared = _split_days(spark, text_days(spark, text_root), root)
    if not compared.days:
        return new, None
    if remember:
        stale = _changed(spark, text_root, ds, root, int_tolerance, compared)
        return new, spark.createDataFrame([(day, "stale") for day in stale], _PENDING)
    checked = _checked(spark, text_root, ds, root, int_tolerance, compared)
    return new, checked.where("not converted").select("day", F.lit("stale").alias("reason"))


def _checked(
    spark: SparkSession, text_root: str, ds: Dataset, root: str, int_tolerance: bool, compared: _Compared
) -> DataFrame:
    """Row by row, both sides of some days."""
    held = read_periods(spark, ds, root, compared.stored, compared.bounds)
    known = held.where(F.col(ds.time).cast("date").isin([date.fromisoformat(d) for d in compared.days]))
    return conversion_check(read_text(spark, ds, text_root, days=compared.days), known, ds, int_tolerance)


def _changed(
    spark: SparkSession, text_root: str, ds: Dataset, root: str, int_tolerance: bool, compared: _Compared
) -> list[str]:
    """The stale days, by digests; only days of unequal digests are compared row by row, once.

    A pair of digests whose rows agree within tolerance is remembered as accepted.
    """
    catalogue = Catalogue(spark, ds, root)
    stamps = text_stamps(spark, text_root)
    text = catalogue.text_days(text_root, {day: stamps[day] for day in compared.days})
    stored = catalogue.stored_days(root, compared.stored)
    none = (0, 0)
    pairs = {day: (text.get(day, none), stored.get(day, none)) for day in compared.days}
    marks = {day: f"{a[0]}:{a[1]}/{b[0]}:{b[1]}/{int_tolerance}" for day, (a, b) in pairs.items() if a != b}
    doubtful = [day for day, mark in marks.items() if not catalogue.knows(ACCEPTED, day, mark)]
    stale = doubtful
    if doubtful:
        checked = _checked(spark, text_root, ds, root, int_tolerance, _Compared(doubtful, compared.stored))
        accepted = {r["day"] for r in checked.where("converted").select("day").collect()}
        for day in accepted:
            catalogue.add(ACCEPTED, day, marks[day], {})
        stale = [day for day in doubtful if day not in accepted]
    catalogue.save()
    return stale


@dataclass(frozen=True)
class _Compared:
    """Text days that have stored rows, and the periods those are in."""

    days: list[str]
    stored: list[str]

    @property
    def bounds(self) -> TimeBounds:
        return time_bounds(self.days[0], self.days[-1], intraday=True)


def _split_days(spark: SparkSession, days: list[str], root: str) -> tuple[list[str], _Compared]:
    if not days:
        return [], _Compared([], [])
    years = range(int(days[0][:4]), int(days[-1][:4]) + 1)
    found = list_periods(spark, root, years)
    if not found:
        return days, _Compared([], [])
    tiers = resolve_tiers(manifest_of(spark, found), days[0], days[-1])
    stored = {r.period: r.path for r in tiers.select("period", "path").collect()}
    covering = {day: [p for p in (day, day[:7], day[:4]) if p in stored] for day in days}
    known = [day for day in days if covering[day]]
    periods = sorted({p for day in known for p in covering[day]})
    return [day for day in days if not covering[day]], _Compared(known, [stored[p] for p in periods])
