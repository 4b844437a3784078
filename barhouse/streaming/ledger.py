"""Batches of a stream, each published once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barhouse.files import Files

_HOME, _COMPLETE, _DONE, _BATCH = "_batches", "_complete", "done-", "batch-"


def stream_of(batch: DataFrame) -> str:
    """The id, kept with its checkpoint, of the stream whose batch this is."""
    name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise ValueError("not a batch of a stream")
    return name


class Ledger:
    """What a stream has published into the lake at ``root``.

    A batch is first written to a folder of its own. Once that is complete its files are
    moved to where readers look, and last of all its number is noted. When Spark delivers a
    batch again after a crash, one that is noted is skipped; of one that is complete, the
    files still there are moved; any other is written afresh. A file is thus either in that
    folder or published, and nothing is lost or stored twice, also if a compaction has
    taken published files in the meantime. No stored row is read for it.

    Spark only ever delivers the last batch again, so the last number is all that is kept.
    """

    def __init__(self, spark: SparkSession, root: str, stream: str):
        self._files = Files(spark, root)
        self._root = self._files.qualified(root)
        self._stream = stream
        self._home = f"{self._root}/{_HOME}/{stream}"

    def last(self) -> int:
        """The number of the last batch that was published; -1 before the first."""
        return max(self._noted(), default=-1)

    def _noted(self) -> list[int]:
        return [int(e.name.removeprefix(_DONE)) for e in self._files.glob(f"{self._home}/{_DONE}*")]

    def publish(self, number: int, write: Callable[[str], None], **elsewhere: str) -> bool:
        """Let ``write`` store a batch's periods below ``<folder>/rows``, and publish them; False if that was done before.

        Files below ``<folder>/<name>`` go to the folder given under that name.
        """
        noted = self._noted()
        if number <= max(noted, default=-1):
            return False
        folder = f"{self._home}/{_BATCH}{number}"
        if not self._files.exists(f"{folder}/{_COMPLETE}"):
            self._files.delete(folder)
            write(folder)
            self._files.touch(f"{folder}/{_COMPLETE}")
        self._move(f"{folder}/rows", "year=*/period=*/", self._root, number)
        for name, target in elsewhere.items():
            self._move(f"{folder}/{name}", "", self._files.qualified(target), number)
        self._files.rename(f"{folder}/{_COMPLETE}", f"{self._home}/{_DONE}{number}")
        old = [f"{self._home}/{_DONE}{n}" for n in noted]
        self._files.each(self._files.delete, [*old, *(e.path for e in self._files.glob(f"{self._home}/{_BATCH}*"))])
        return True

    def _move(self, source: str, inner: str, target: str, number: int) -> None:
        parts = [e.path for e in self._files.glob(f"{source}/{inner}part-*")]
        folders = [p.rsplit("/", 1) for p in parts]
        base = self._files.qualified(source)
        places = [f"{target}{folder.removeprefix(base)}/part-{self._stream}-{number}-{name.removeprefix('part-')}" for folder, name in folders]
        self._files.each(self._files.rename, parts, places)
