"""Folder operations through the file system that Spark itself uses for a path."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import SparkSession


def blocks(items: Iterable, size: int = 1000) -> Iterator[list]:
    """The items in lists of ``size``, so that a pool never holds more of them."""
    items = iter(items)
    while block := list(islice(items, size)):
        yield block


class Files:
    """Existence, listing, moving and small marker files below any Hadoop-style path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        handle = self._jvm.org.apache.hadoop.fs.Path(path)
        return handle.getFileSystem(self._conf), handle

    def exists(self, path: str) -> bool:
        system, handle = self._at(path)
        return system.exists(handle)

    def make_folder(self, path: str) -> None:
        system, handle = self._at(path)
        system.mkdirs(handle)

    def delete(self, path: str) -> bool:
        system, handle = self._at(path)
        return system.delete(handle, True)

    def delete_without_files(self, path: str) -> bool:
        """Delete a folder that holds nothing but marker and checksum files."""
        system, handle = self._at(path)
        if not system.exists(handle) or any(status.getPath().getName()[0] not in "._" for status in system.listStatus(handle)):
            return False
        return system.delete(handle, True)

    def move(self, source: str, target: str) -> None:
        """Rename a folder; the target must not exist, its parents are made."""
        system, handle = self._at(source)
        goal = self._jvm.org.apache.hadoop.fs.Path(target)
        system.mkdirs(goal.getParent())
        if not system.rename(handle, goal):
            raise OSError(f"cannot move {source} to {target}")

    def mark(self, path: str) -> None:
        """Create an empty file; an error when it exists, so that of two writers only one commits."""
        system, handle = self._at(path)
        system.create(handle, False).close()

    def folders(self, path: str) -> list[str]:
        """Names of the direct subfolders."""
        system, handle = self._at(path)
        if not system.exists(handle):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(handle) if status.isDirectory())

    def matches(self, pattern: str) -> list[str]:
        """Full names that a glob pattern finds."""
        system, handle = self._at(pattern)
        return [status.getPath().toString() for status in (system.globStatus(handle) or [])]
