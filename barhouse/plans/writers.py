"""Sinks: stored periods, text lines, text day files, symbol lists."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Observation, functions as F

from barhouse.datasets import Dataset, dataset
from barhouse.files import Files
from barhouse.operators.fingerprint import digest
from barhouse.operators.reconcile import period_of

# Stored files: zstd, with the delta encodings of version-2 pages, which suit
# sorted times and whole numbers. A row group whose symbols fit a dictionary is
# passed over by that if the one wanted isn't in it; where they don't, a Bloom
# filter, sized by the symbols there are, does so. Only the partitions written are replaced.
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.bloom.filter.enabled#symbol": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "partitionOverwriteMode": "dynamic",
}
PERIOD_COLUMNS = ["year", "period"]

# Estimated bytes a write task should get, and what no estimate is good for.
LEAST_TASK_BYTES, MOST_TASK_BYTES, BEYOND_BELIEF = 4 * 2**20, 192 * 2**20, 2**53


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size; for stored files, theirs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def write_tasks(df: DataFrame) -> int:
    """How many tasks should write a table, from its estimated size.

    Small tables get fewer than ``spark.sql.shuffle.partitions``, large ones as
    many as it takes; an estimate beyond belief, as joins can give, counts as
    none.
    """
    session, size = df.sparkSession, planned_bytes(df)
    usual = int(session.conf.get("spark.sql.shuffle.partitions"))
    if size >= BEYOND_BELIEF:
        return usual
    few = max(session.sparkContext.defaultParallelism, ceil(size / LEAST_TASK_BYTES))
    return max(min(usual, few), ceil(size / MOST_TASK_BYTES))


def with_period(df: DataFrame, which: str | Dataset, grain: str) -> DataFrame:
    """Stored columns plus the ``year`` and ``period`` a row's time puts it in."""
    ds = dataset(which)
    timeless = F.raise_error(F.lit("a row has no time and so belongs to no period")).cast("string")
    return _with_year(ds.canonical(df, F.coalesce(period_of(ds, grain), timeless).alias("period")), ds)


def _with_year(df: DataFrame, ds: Dataset) -> DataFrame:
    return df.select(*ds.columns, F.substring("period", 1, 4).cast("int").alias("year"), "period")


def write_rows(
    df: DataFrame,
    which: str | Dataset,
    root: str,
    *,
    mode: str = "overwrite",
    layout: str = "range",
    partitions: int | None = None,
    observation: Observation | None = None,
) -> None:
    """Write rows that carry ``year`` and ``period``, sorted by key.

    ``range``: rows are range-partitioned over (period, key, other columns). A
    task gets a contiguous run, a small period lands in one file, and a large
    period, or one where a single symbol has most rows, is cut into files of
    disjoint key ranges. Even copies of one row are spread, by the input
    partition they come from, which a retried task can't change. Finding the
    ranges reads the input once more, so this suits inputs that come out of a
    shuffle.

    ``rebalance``: rows are sent to their period's task in one pass; AQE cuts
    periods that are too large and joins those that are small. This suits
    inputs that are costly to read, such as text, and bulk loads use it.

    An observation is taken after the shuffle, in the stage that writes, so
    that a lost executor can't make it count twice.
    """
    ds = dataset(which)
    order = ["year", "period", *ds.key]
    if layout == "range":
        placed = _by_range(df, partitions or write_tasks(df), *order, *ds.values)
    elif layout == "rebalance":
        placed = df.hint("rebalance", *PERIOD_COLUMNS)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    if observation is not None:
        placed = placed.observe(observation, *digest(ds, "period"))
    writer = placed.sortWithinPartitions(*order).write.partitionBy(*PERIOD_COLUMNS)
    writer.mode(mode).options(**WRITE_OPTIONS).parquet(root)


def _by_range(df: DataFrame, parts: int, *order: str) -> DataFrame:
    """Range partitioning that can also cut a run of equal rows in two: they
    are told apart by the input partition they come from."""
    source = df.withColumn("_source", F.spark_partition_id())
    return source.repartitionByRange(parts, *order, "_source").drop("_source")


def write_days(
    df: DataFrame,
    which: str | Dataset,
    root: str,
    *,
    grain: str = "day",
    mode: str = "overwrite",
    layout: str = "range",
    partitions: int | None = None,
) -> None:
    """Store rows as daily periods; only the days that occur are replaced.

    A row without a time fails the write.

    ``mode="append"`` adds to stored days instead. ``grain`` may also be
    ``month`` or ``year``; for ``layout`` see :func:`write_rows`.
    """
    write_rows(with_period(df, which, grain), which, root, mode=mode, layout=layout, partitions=partitions)


def text_lines(df: DataFrame, which: str | Dataset, *extra: Column) -> DataFrame:
    """Rows as tab-separated lines in the dataset's text layout."""
    ds = dataset(which)
    clock = F.substring(F.col(ds.time).cast("string"), 12, 5)
    fields = [clock if n == "time" else F.col(n).cast("string") for n, _ in ds.text_fields]
    filled = [F.coalesce(f, F.lit("")) for f in fields]
    return df.select(F.concat_ws("\t", *filled).alias("value"), *extra)


def write_text(df: DataFrame, which: str | Dataset, path: str) -> None:
    """Tab-separated lines without a header, in line order."""
    lines = text_lines(df, which)
    ranged = _by_range(lines, write_tasks(lines), "value").sortWithinPartitions("value")
    ranged.write.mode("overwrite").text(path)


def write_symbols(symbols: DataFrame, path: str) -> None:
    """One symbol per line, sorted."""
    symbols.select(F.col("symbol").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_text_days(df: DataFrame, which: str | Dataset, root: str) -> None:
    """Text day files ``YYYY-MM-DD.txt`` as the text readers expect them.

    Lines are written by day in one job. The parts are then renamed: a day
    spread over several tasks gives ``0/<day>.txt``, ``1/<day>.txt``...
    """
    ds = dataset(which)
    day = period_of(ds, "day").alias("day")
    lines = text_lines(df, ds, day)
    staged = f"{root}/_parts"
    ranged = _by_range(lines, write_tasks(lines), "day", "value").sortWithinPartitions("day", "value")
    ranged.write.partitionBy("day").mode("overwrite").text(staged)
    files = Files(df.sparkSession, root)
    copies: dict[str, int] = {}
    targets = []
    parts = files.glob(f"{staged}/day=*/part-*")
    for entry in parts:
        name = entry.parent.removeprefix("day=")
        copies[name] = copies.get(name, -1) + 1
        targets.append(f"{root}/{copies[name]}/{name}.txt")
    files.each(files.rename, [e.path for e in parts], targets)
    files.delete(staged)
