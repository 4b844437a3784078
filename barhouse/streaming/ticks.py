"""Keep-first dedup of a running stream of ticks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from barhouse.datasets import Dataset, dataset
from barhouse.operators.dedup import first_per_key
from barhouse.plans.writers import write_days
from barhouse.streaming.arrivals import ARRIVED, ROW, numbered, numbered_stream, with_arrival
from barhouse.streaming.landing import stored_rows
from barhouse.streaming.ledger import Ledger, stream_of

# Keys that share one state: those of a day (of the time in UTC) whose symbols fall into one of so many buckets. A call costs
# as much as some ten thousand rows, so a day of a million rows is worth about eight, and one of few rows no more.
BUCKETS, _DAY_MS = 8, 86_400_000


def first_arrivals(ticks: DataFrame, which: str | Dataset, delay: str = "1 day", late: bool = False) -> DataFrame:
    """Per (symbol, time), the row that arrives first; with ``late``, also those after it, and a column that says so.

    In a batch, files count by time and name and rows by their place in the file (see
    :func:`with_arrival`). State is the keys seen, by day and bucket of symbols, so that
    a batch calls Python once for each of those and not for each key. They are kept until
    the watermark, ``delay`` behind the latest time seen, has passed their day; a timeout
    clears them. Rows that come after the watermark has passed their time are dropped by
    Spark, and :func:`dropped_rows` counts them, so this suits streams whose lateness is
    known to be bounded; :func:`land_first` loses none. Rows without a time are left out.
    Watermarks need an instant, so the naive time is read in the session's zone, which
    should be UTC.
    """
    ds, naive = dataset(which), F.col(dataset(which).time)
    placed = ticks if ARRIVED in ticks.columns else with_arrival(ticks)
    rows = numbered_stream(ds.canonical(placed, ARRIVED).where(naive.isNotNull()))
    instant = naive.cast("timestamp").alias(ds.time)
    timed = rows.select(*[instant if c == ds.time else c for c in ds.columns], f"{ARRIVED}.*", F.col(ROW).alias("place")).withWatermark(ds.time, delay)
    kinds = ", ".join(f"{f.name} {'timestamp' if f.name == ds.time else f.dataType.simpleString()}" for f in ds.schema)
    # An int, where checkpoints of 64 buckets have a bigint: Spark refuses to continue those.
    day, bucket = F.floor(F.unix_millis(naive) / _DAY_MS), F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).cast("int")
    grouped = timed.withColumns({"day": day, "bucket": bucket}).groupBy("day", "bucket")
    told = grouped.applyInPandasWithState(_keeper(ds, late), f"{kinds}, late boolean", "seen binary", "append", "EventTimeTimeout")
    told = told.withColumn(ds.time, naive.cast("timestamp_ntz"))
    return told if late else told.where("not late").drop("late")


def _keeper(ds: Dataset, late: bool) -> Callable[..., Iterator[pd.DataFrame]]:
    """What is done with a batch's rows of one day and bucket: the rows whose keys are new, with ``late`` the others too.

    The functions are local so that they travel with the job. State is the keys as blocks of Arrow, one after another.
    """
    out, keys, order = ds.columns, ds.key, ["modified", "file", "block", "place"]

    def gathered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The same rows in ever larger parts, so that the earliest aren't sorted again with each small one."""
        held, size, least = [], 0, 0
        for part in parts:
            held.append(part)
            size += len(part)
            if size >= least:
                yield joined(held)
                held, size, least = [], 0, least + size
        if held:
            yield joined(held)

    def joined(held: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(held) if len(held) > 1 else held[0]

    def arranged(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows of one key in order of arrival; a key's only row can be anywhere."""
        shared = rows.duplicated(keys, keep=False).to_numpy()
        return pd.concat([rows[~shared], rows[shared].sort_values(order)]) if shared.any() else rows

    def packed(rows: pd.DataFrame) -> bytes:
        sink, table = pa.BufferOutputStream(), pa.Table.from_pandas(rows[keys], preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as block:
            block.write_table(table)
        return sink.getvalue().to_pybytes()

    def unpacked(blocks: bytes) -> pd.DataFrame | None:
        source, tables = pa.BufferReader(blocks), []
        while source.tell() < len(blocks):
            tables.append(pa.ipc.open_stream(source).read_all())
        return pa.concat_tables(tables, promote_options="permissive").to_pandas() if tables else None

    def known(rows: pd.DataFrame, seen: pd.DataFrame | None) -> np.ndarray:
        """Which rows, those of a key in order of arrival, have a key that was seen, also in a row before them."""
        if seen is None:
            return rows.duplicated(keys).to_numpy()
        return pd.concat([seen, rows[keys]]).duplicated().to_numpy()[len(seen):]

    def keep(group, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        blocks = bytes(state.get[0]) if state.exists else b""
        seen, first = unpacked(blocks), None
        for rows in gathered(parts):
            # The earliest so far wait until all rows of the batch have been seen.
            rows = arranged(rows if first is None else joined([first, rows]))
            again = known(rows, seen)
            if late and again.any():
                yield rows.loc[again, out].assign(late=True)
            first = rows[~again] if again.any() else rows
        if first is not None and len(first):
            state.update((blocks + packed(first),))
            state.setTimeoutTimestamp((int(group[0]) + 1) * _DAY_MS)
            yield first[out].assign(late=False)

    return keep


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after their state was gone, as far as Spark remembers the stream's progress."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def land_first(ticks: DataFrame, which: str | Dataset, root: str, checkpoint: str, late: str | None = None) -> StreamingQuery:
    """Append the row that arrives first of each (symbol, time) to stored days, then stop.

    What has arrived is what is stored, so there is no watermark: a row counts
    however late it is. In a batch, files count by time and name and rows by their
    place in the file (see :func:`with_arrival`). Rows that came too late to be the
    first are stored in the folder ``late``, if one is given. A batch is published
    once, however often it is delivered (:class:`Ledger`).
    """
    ds = dataset(which)
    placed = ticks if ARRIVED in ticks.columns else with_arrival(ticks)

    def append(batch: DataFrame, number: int) -> None:
        rows = numbered(ds.canonical(batch, ARRIVED))

        def write(folder: str) -> None:
            first = first_per_key(rows, ds.key, [ARRIVED, ROW])
            known = stored_rows(first, ds, root)
            if known is not None:
                first = first.join(known.select(*ds.key), ds.key, "left_anti")
            write_days(first, ds, f"{folder}/rows")
            if late:
                lost = rows.join(first.select(ARRIVED, ROW), [ARRIVED, ROW], "left_anti")
                lost.select(*ds.columns).write.parquet(f"{folder}/late")

        Ledger(batch.sparkSession, root, stream_of(batch)).publish(number, write, **({"late": late} if late else {}))

    sink = placed.writeStream.foreachBatch(append).trigger(availableNow=True)
    return sink.option("checkpointLocation", checkpoint).start()
