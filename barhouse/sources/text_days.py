"""Tab-separated day files named ``YYYY-MM-DD.txt``, in any sub-folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barhouse.datasets import KR_1D, KR_1M, US_5M, Dataset, dataset
from barhouse.functions.clean import day_time, file_day, try_day_time, whole_volume

# Fixed value: the name every day file carries.
DAY_FILE = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9].txt"
CORRUPT = "_corrupt_record"

# Lines are always split whole: with pruned columns one of the wrong length
# would pass unnoticed.
_OPTIONS = {"sep": "\t", "recursiveFileLookup": True, "pathGlobFilter": DAY_FILE, "columnPruning": False}


def text_days(spark: SparkSession, root: str) -> list[str]:
    """The days that have files below a folder, however many files each has. No file is opened for it."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=DAY_FILE).load(root)
    days = found.select(F.substring_index("path", "/", -1).alias("name")).distinct()
    return sorted(r.name.removesuffix(".txt") for r in days.collect())


def _files_of(days: list[str] | None) -> str:
    return DAY_FILE if days is None else "{" + ",".join(days) + "}.txt"


def read_text(
    spark: SparkSession,
    which: str | Dataset,
    root: str | list[str],
    *,
    days: list[str] | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Typed rows of a dataset's day files, copies of a row included; of some days, if any are given.

    Reading a malformed line fails. With ``mode="DROPMALFORMED"`` such lines
    are left out; :func:`read_text_rejects` has them.
    """
    ds = dataset(which)
    if days == []:
        return spark.createDataFrame([], ds.schema)
    if mode == "FAILFAST":
        reader = spark.read.schema(ds.text_ddl).options(**_OPTIONS, mode=mode).option("pathGlobFilter", _files_of(days))
        return _typed(ds, _with_day(reader.csv(root)), day_time, _demand)
    if mode != "DROPMALFORMED":
        raise ValueError(f"unknown mode {mode!r}")
    return _typed(ds, _judged(spark, ds, root, days).where("not _bad"), try_day_time, Column.try_cast)


def read_text_rejects(spark: SparkSession, which: str | Dataset, root: str | list[str]) -> DataFrame:
    """(day, line) of every line that doesn't fit the dataset's layout."""
    ds = dataset(which)
    whole = F.concat_ws("\t", *[F.coalesce(F.col(n), F.lit("")) for n, _ in ds.text_fields])
    line = F.coalesce(F.col(CORRUPT), whole).alias("line")
    return _judged(spark, ds, root).where("_bad").select(F.col("_day").alias("day"), line)


def read_day_text(spark: SparkSession, root: str | list[str], **options) -> DataFrame:
    return read_text(spark, KR_1D, root, **options)


def read_minute_text(spark: SparkSession, root: str | list[str], **options) -> DataFrame:
    return read_text(spark, KR_1M, root, **options)


def read_us_text(spark: SparkSession, root: str | list[str], **options) -> DataFrame:
    return read_text(spark, US_5M, root, **options)


def stream_text_rows(spark: SparkSession, which: str | Dataset, root: str, files_per_batch: int) -> DataFrame:
    """The same rows as a stream of newly landed files."""
    ds = dataset(which)
    reader = spark.readStream.schema(ds.text_ddl).options(**_OPTIONS, mode="FAILFAST", maxFilesPerTrigger=files_per_batch)
    return _typed(ds, _with_day(reader.csv(root)), day_time, _demand)


def _judged(spark: SparkSession, ds: Dataset, root: str | list[str], days: list[str] | None = None) -> DataFrame:
    """Lines as text fields, and whether any of them doesn't fit."""
    ddl = ", ".join(f"{name} string" for name in [*[n for n, _ in ds.text_fields], CORRUPT])
    reader = spark.read.schema(ddl).options(**_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    reader = reader.option("pathGlobFilter", _files_of(days))
    bad = F.col(CORRUPT).isNotNull()
    for name, kind in ds.text_fields:
        if kind == "bigint":
            bad |= F.col(name).try_cast(kind).isNull()
        elif kind == "double":
            bad |= F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
    if ds.intraday:
        bad |= try_day_time(F.col("_day"), F.col("time")).isNull()
    return _with_day(reader.csv(root)).withColumn("_bad", bad)


def _with_day(raw: DataFrame) -> DataFrame:
    return raw.select("*", file_day(F.col("_metadata.file_name")).alias("_day"))


def _demand(value: Column, kind: str) -> Column:
    """A whole number must be there; a blank one makes the line malformed."""
    blank = F.raise_error(F.lit("blank number in a day file")).cast(kind)
    return F.when(value.isNull(), blank).otherwise(value) if kind == "bigint" else value


def _typed(ds: Dataset, raw: DataFrame, stamp, number) -> DataFrame:
    day = F.col("_day")
    time = stamp(day, F.col("time")) if ds.intraday else day.cast("timestamp_ntz")
    columns = {name: number(F.col(name), kind) if kind != "string" else F.col(name) for name, kind in ds.text_fields}
    if ds is US_5M:
        columns["volume"] = whole_volume(columns["volume"])
    return ds.canonical(raw.select(time.alias(ds.time), *[c.alias(n) for n, c in columns.items()]))
