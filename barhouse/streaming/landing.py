"""Text day files that land one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barhouse.datasets import Dataset, dataset
from barhouse.operators.dedup import drop_copies
from barhouse.functions.routing import time_bounds
from barhouse.plans.writers import write_days
from barhouse.sources.periods import list_periods, read_periods
from barhouse.sources.text_days import stream_text_rows
from barhouse.streaming.ledger import Ledger, stream_of

# Day files taken into one batch.
FILES_PER_BATCH = 1000


def stored_rows(rows: DataFrame, which: str | Dataset, root: str) -> DataFrame | None:
    """What is stored, in any tier, of the days that occur in ``rows``; None if nothing is.

    Only periods that hold one of those days are read, however far the days lie apart.
    """
    ds, spark = dataset(which), rows.sparkSession
    day = F.col(ds.time).cast("date").cast("string")
    days = sorted(r.day for r in rows.select(day.alias("day")).distinct().collect() if r.day)
    names = {part for d in days for part in (d, d[:7], d[:4])}
    found = list_periods(spark, root, sorted({int(d[:4]) for d in days})) if days else []
    paths = [path for path, name, _ in found if name in names]
    if not paths:
        return None
    bounds = time_bounds(days[0], days[-1], intraday=True)
    return read_periods(spark, ds, root, paths, bounds).where(day.isin(days)).select(*ds.columns)


def new_rows(batch: DataFrame, which: str | Dataset, root: str) -> DataFrame:
    """Distinct rows of a batch that aren't stored yet, in any tier: a day file may repeat rows of another."""
    ds = dataset(which)
    rows = drop_copies(ds.canonical(batch))
    stored = stored_rows(rows, ds, root)
    if stored is None:
        return rows
    same = [rows[c].eqNullSafe(stored[c]) for c in ds.columns]
    return rows.join(stored, same, "left_anti")


def stream_text(
    spark: SparkSession,
    which: str | Dataset,
    source: str,
    root: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Append the rows of day files not seen before, then stop.

    The checkpoint remembers the files; start it again whenever more have
    landed. A backlog is worked off in batches of bounded size. Each batch is
    published once, however often it is delivered (:class:`Ledger`).
    """
    ds = dataset(which)

    def append(batch: DataFrame, number: int) -> None:
        ledger = Ledger(batch.sparkSession, root, stream_of(batch))
        ledger.publish(number, lambda folder: write_days(new_rows(batch, ds, root), ds, f"{folder}/rows"))

    rows = stream_text_rows(spark, ds, source, files_per_batch)
    sink = rows.writeStream.foreachBatch(append).trigger(availableNow=True)
    return sink.option("checkpointLocation", checkpoint).start()
