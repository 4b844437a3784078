"""Where a streamed row stands in the order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

# Columns that say when a row arrived: its file and block, and its place among the rows of its task.
ARRIVED, ROW = "_arrived", "_row"


def with_arrival(rows: DataFrame, by_name: bool = False) -> DataFrame:
    """Add ``_arrived``: time and name of the file that a row comes from, and the start of its block.

    ``by_name`` leaves the time out, for files whose names tell their order. Rows of
    a source without files have only their order in the batch.
    """
    file = F.col("_metadata")
    modified = F.lit(0).cast("bigint") if by_name else F.unix_micros(file["file_modification_time"])
    try:
        return rows.select("*", _place(modified, file["file_path"], file["file_block_start"]))
    except AnalysisException:  # this source has no files
        zero = F.lit(0).cast("bigint")
        return rows.select("*", _place(zero, F.lit(""), zero))


def _place(modified: Column, file: Column, block: Column) -> Column:
    return F.struct(modified.alias("modified"), file.alias("file"), block.alias("block")).alias(ARRIVED)


def numbered(batch: DataFrame) -> DataFrame:
    """Add ``_row`` to a batch as it was read: rows of one file block rise with their place in it."""
    return batch.withColumn(ROW, F.monotonically_increasing_id())


def numbered_stream(rows: DataFrame) -> DataFrame:
    """The same for a stream, whose rows Spark's own numbering doesn't take."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            number = pa.array(np.arange(seen, seen + len(batch)), pa.int64())
            seen += len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, number], [*batch.schema.names, ROW])

    return rows.mapInArrow(count, StructType([*rows.schema.fields, StructField(ROW, LongType())]))
