"""What several text operators share: words, settled tables, ranks without a hot group."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barhouse.session import scratch_dir

# Fixed value: a word is a run of characters other than the six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"

# Rank groups are cut by hash into so many buckets, each ranked on its own.
RANK_BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the files, so a lost executor costs no more than the
    step under way, and what made the rows isn't run again for every reader.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of a finished write at once: what is read later is read from the written files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(-1))


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str) -> DataFrame:
    """Add a 1-based rank inside each group, which no single task holds.

    A group is dealt by a hash of the order columns into buckets. Counting gives
    each bucket the rank it starts from, so only a bucket is sorted in one task.
    Groups must not be null. Rows equal in all order columns are ranked in any order.
    """
    cut, start = f"{rank}_cut", f"{rank}_start"
    df = df.withColumn(cut, F.pmod(F.xxhash64(*order), F.lit(RANK_BUCKETS)))
    before = Window.partitionBy(*group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*group, cut).count().select(
        *group, cut, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start)
    )
    inside = Window.partitionBy(*group, cut).orderBy(*order)
    numbered = df.withColumn(rank, F.row_number().over(inside).cast("bigint"))
    return numbered.join(starts, [*group, cut]).withColumn(rank, F.col(rank) + F.col(start)).drop(cut, start)


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs of about ``most`` in total; a longer item is a run of its own."""
    first = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)
