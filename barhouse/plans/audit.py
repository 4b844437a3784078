"""Reconciliation of text originals with a stored tier, all periods in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse.datasets import NAME_LENGTH, Dataset, dataset
from barhouse.operators.reconcile import align, reconcile_summary
from barhouse.sources.periods import period_manifest, read_periods
from barhouse.sources.text_days import read_text, text_days

# Verdicts of a period.
OK, FAILED, NOT_STORED, NO_TEXT = "ok", "failed", "not stored", "no text"


def reconcile_months(spark: SparkSession, text_root: str, which: str | Dataset, root: str) -> DataFrame:
    """Text against stored months; months that only one side has are reported so."""
    return _reconcile(spark, text_root, dataset(which), root, "month")


def reconcile_years(spark: SparkSession, text_root: str, which: str | Dataset, root: str) -> DataFrame:
    """Text against stored years; years that only one side has are reported so."""
    return _reconcile(spark, text_root, dataset(which), root, "year")


def sources_of(
    spark: SparkSession, text_root: str, ds: Dataset, root: str, grain: str
) -> tuple[DataFrame, DataFrame, set[str], set[str]]:
    """Text rows and stored rows of the periods both sides have, and the
    periods each side has."""
    length = NAME_LENGTH[grain]
    days = text_days(spark, text_root)
    stored = period_manifest(spark, root).where(F.length("period") == length).select("path", "period").collect()
    texts, held = {day[:length] for day in days}, {r.period for r in stored}
    both = texts & held
    txt = read_text(spark, ds, text_root, days=[day for day in days if day[:length] in both])
    pq = read_periods(spark, ds, root, [r.path for r in stored if r.period in both])
    return txt, pq.select(*ds.columns), texts, held


def _reconcile(spark: SparkSession, text_root: str, ds: Dataset, root: str, grain: str) -> DataFrame:
    txt, pq, texts, held = sources_of(spark, text_root, ds, root, grain)
    summary = reconcile_summary(align(txt, pq, ds), ds, grain)
    judged = summary.select(
        "period", F.when(F.col("ok"), OK).otherwise(FAILED).alias("status"),
        *[c for c in summary.columns if c not in ("period", "ok")],
    )
    one_sided = [(p, NOT_STORED) for p in sorted(texts - held)] + [(p, NO_TEXT) for p in sorted(held - texts)]
    rest = spark.createDataFrame(one_sided, "period string, status string")
    return judged.unionByName(rest, allowMissingColumns=True)
