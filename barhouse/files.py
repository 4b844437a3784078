"""Folder operations on whatever file system Spark itself is using.

Only metadata passes through here: period folders are listed, renamed and
deleted, which is bounded by the calendar and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Folder operations under way at one time.
_AT_ONCE = 16


@dataclass(frozen=True)
class Entry:
    path: str

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 2)[-1]

    @property
    def parent(self) -> str:
        return self.path.rsplit("/", 2)[-2]


class Files:
    """A handle on the Hadoop file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._hadoop = spark._jvm, spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def qualified(self, path: str) -> str:
        """The one spelling of a path, with scheme and authority, that listings use too."""
        return self._fs.makeQualified(self._path(path)).toString()

    def glob(self, pattern: str) -> list[Entry]:
        found = self._fs.globStatus(self._path(pattern))
        return [Entry(p.toString()) for p in self._hadoop.FileUtil.stat2Paths(found)] if found else []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if self._fs.exists(to):
            raise FileExistsError(target)
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"could not rename {source} to {target}")

    def touch(self, path: str) -> None:
        """Create an empty file, and the folders above it."""
        self._fs.create(self._path(path)).close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_all(self, paths: Iterable[str], keep: str) -> None:
        """Delete several paths, none of which may be ``keep`` or a folder above it."""
        doomed, kept = [self.qualified(p) for p in paths], self.qualified(keep)
        for path in doomed:
            if f"{kept}/".startswith(f"{path}/"):
                raise ValueError(f"refusing to delete {path}, which holds {kept}")
        self.each(self.delete, doomed)

    def each(self, step: Callable[..., None], *arguments: Iterable[str]) -> None:
        """Run a step for many paths, several at a time."""
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            list(pool.map(step, *arguments))
