"""Compaction: days into months, months into years.

All periods that are due are compacted by one Spark job. The result is staged
beside the data, read back and compared with what was handed to the writer;
only then is it put in place, and only after that are the inputs deleted. A
run that dies at any point leaves every row stored, and the next run tidies up.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barhouse.datasets import NAME_LENGTH, Dataset, dataset
from barhouse.files import Files
from barhouse.operators.dedup import drop_copies
from barhouse.operators.fingerprint import fingerprint
from barhouse.operators.reports import month_groups
from barhouse.plans.writers import write_rows
from barhouse.sources.periods import period_manifest, read_periods

# Fixed value: days to wait after a month's end before its days are merged.
DAYS_TO_WAIT = 5

_STAGING, _REPLACED = "_staging", "_replaced"
_REPORT = (
    "period string, inputs int, merged_existing boolean, rows bigint, published boolean, "
    "missing array<string>, leftover array<string>"
)


class CompactionError(RuntimeError):
    """A compacted period didn't read back as written; its inputs are kept."""


def due_months(manifest: DataFrame, as_of: date | str, days_wait: int = DAYS_TO_WAIT) -> DataFrame:
    """Months with stored days that ended at least ``days_wait`` days ago."""
    first = F.to_date(F.concat("period", F.lit("-01")))
    ready = F.date_add(F.add_months(first, 1).cast("date"), days_wait)
    return month_groups(manifest, "month").where(F.lit(str(as_of)).cast("date") >= ready)


def due_years(manifest: DataFrame, as_of: date | str) -> DataFrame:
    """Years with stored months that are strictly past."""
    return month_groups(manifest, "year").where(
        F.col("period").cast("int") < F.year(F.lit(str(as_of)).cast("date"))
    )


def compact_months(spark: SparkSession, root: str, which: str | Dataset, as_of: date | str, **options) -> DataFrame:
    """Merge the days of every month that is due; returns the job report."""
    return _compact(spark, root, dataset(which), "month", as_of, **options)


def compact_years(spark: SparkSession, root: str, which: str | Dataset, as_of: date | str, **options) -> DataFrame:
    """Merge the months of every past year; returns the job report.

    The report names months that weren't there and days left beside the year.
    """
    return _compact(spark, root, dataset(which), "year", as_of, **options)


@dataclass(frozen=True)
class Target:
    """A period to be made, from which stored periods."""

    period: str
    inputs: list[str]
    existing: list[str]
    missing: list[str]
    leftover: list[str]

    def folder(self, root: str) -> str:
        return f"{root}/year={self.period[:4]}/period={self.period}"


def _compact(spark, root, ds, grain, as_of, *, partitions=None) -> DataFrame:
    files = Files(spark, root)
    root = files.qualified(root)
    recover(spark, root)
    targets = _targets(spark, root, grain, as_of)
    if not targets:
        return spark.createDataFrame([], _REPORT)
    sources = [p for t in targets for p in t.inputs + t.existing]
    rows = read_periods(spark, ds, root, sources)

    name = F.substring("period", 1, NAME_LENGTH[grain])
    merged = drop_copies(rows.withColumn("period", name))

    saved = store_periods(spark, ds, root, merged, targets, partitions)
    lines = [
        (t.period, len(t.inputs), bool(t.existing), saved[t.period][0], True, t.missing, t.leftover)
        for t in targets
    ]
    return spark.createDataFrame(lines, _REPORT)


def store_periods(
    spark: SparkSession, ds: Dataset, root: str, merged: DataFrame, targets: list[Target], partitions: int | None = None
) -> dict[str, tuple[int, int]]:
    """Stage rows that carry ``year`` and ``period``, read them back, and publish each period that agrees.

    ``root`` must be qualified; targets are published in the order given. Returns what
    :func:`read_back` found; fails if a period wasn't as handed to the writer.
    """
    files = Files(spark, root)
    staging = f"{root}/{_STAGING}-{uuid.uuid4().hex}"
    handed = Observation()
    write_rows(merged, ds, staging, partitions=partitions, observation=handed)
    saved = read_back(spark, ds, staging)
    good = set(saved)
    if not _agrees(handed.get, saved):
        good = _agreeing(merged, ds, saved)

    for t in targets:
        if t.period in good:
            publish(files, root, staging, t)
    files.delete(staging)
    bad = sorted(t.period for t in targets if t.period not in good)
    if bad:
        raise CompactionError(f"not as written, inputs kept: {', '.join(bad)}")
    return saved


def read_back(spark: SparkSession, ds: Dataset, folder: str) -> dict[str, tuple[int, int]]:
    """(rows, digest) of every period in a folder, from the stored files."""
    paths = [e.path for e in Files(spark, folder).glob(f"{folder}/year=*/period=*")]
    rows = read_periods(spark, ds, folder, paths)
    if [f.dataType for f in rows.select(*ds.columns).schema] != [f.dataType for f in ds.schema]:
        raise CompactionError("stored schema differs")
    return {r.period: (r.rows, int(r.digest)) for r in fingerprint(rows, ds, "period").collect()}


def _agrees(handed: dict, saved: dict[str, tuple[int, int]]) -> bool:
    """The period is part of every row's hash, so sums over periods suffice."""
    rows, total = (sum(column) for column in zip(*saved.values())) if saved else (0, 0)
    return (rows, total) == (handed["rows"], int(handed["digest"]))


def _agreeing(merged: DataFrame, ds: Dataset, saved: dict[str, tuple[int, int]]) -> set[str]:
    """The periods that did read back as computed from the inputs."""
    wanted = {r.period: (r.rows, int(r.digest)) for r in fingerprint(merged, ds, "period").collect()}
    return {p for p, mark in wanted.items() if saved.get(p) == mark}


def _targets(spark: SparkSession, root: str, grain: str, as_of) -> list[Target]:
    manifest = period_manifest(spark, root)
    due = due_months(manifest, as_of) if grain == "month" else due_years(manifest, as_of)
    groups = {r.period: r.paths for r in due.collect()}
    if not groups:
        return []
    stored = manifest.select("path", "period", "month", "year").collect()
    out = []
    for period, paths in sorted(groups.items()):
        existing = [r.path for r in stored if r.period == period]
        missing, leftover = [], []
        if grain == "year":
            have = {r.period for r in stored if r.year == period}
            months = [f"{period}-{m:02d}" for m in range(1, 13)]
            missing = [m for m in months if m not in have] if not existing else []
            leftover = sorted(p for p in have if len(p) == NAME_LENGTH["day"])
        out.append(Target(period, list(paths), existing, missing, leftover))
    return out


def publish(files: Files, root: str, staging: str, target: Target) -> None:
    """Put a staged period in place, then delete what it was made from.

    A period that already exists is moved aside first, not deleted: if the run
    dies in between, :func:`recover` moves it back.
    """
    place = target.folder(root)
    aside = f"{root}/{_REPLACED}/{target.period}"
    old = {files.qualified(p) for p in [*target.existing, *target.inputs]} - {files.qualified(place)}
    if files.exists(place):
        files.rename(place, aside)
    files.rename(target.folder(staging), place)
    files.delete_all([aside, *sorted(old)], keep=place)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish or undo what a run that died left behind; returns the periods.

    A period moved aside goes back if nothing took its place, else it is
    superseded and deleted. Staged data is never the only copy.
    """
    files = Files(spark, root)
    root = files.qualified(root)
    touched = []
    for entry in files.glob(f"{root}/{_REPLACED}/*"):
        place = f"{root}/year={entry.name[:4]}/period={entry.name}"
        if files.exists(place):
            files.delete(entry.path)
        else:
            files.rename(entry.path, place)
        touched.append(entry.name)
    for entry in files.glob(f"{root}/{_STAGING}-*"):
        files.delete(entry.path)
    return sorted(touched)
