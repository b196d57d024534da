"""Tables that are replaced as a whole while readers keep the version they opened.

A version is a folder ``v=<number>``. It counts once its commit marker exists, and the marker is created
last, so a crash at any moment leaves the previous version in force.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from desklake import schemas
from desklake.sources.files import Files

MARKER = "_COMMITTED"


@dataclass
class VersionedTable:
    spark: SparkSession
    path: str
    schema: T.StructType

    def _committed(self) -> list[str]:
        found = Files(self.spark).matches(f"{self.path}/v=*/{MARKER}")
        return sorted(name.split("/")[-2] for name in found)

    def current(self) -> str | None:
        """Folder of the newest committed version."""
        committed = self._committed()
        return f"{self.path}/{committed[-1]}" if committed else None

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        """The newest version, or no rows of the declared schema."""
        folder = self.current()
        if folder is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(folder)

    def next_folder(self) -> str:
        taken = [int(name.removeprefix("v=")) for name in Files(self.spark).folders(self.path) if name.startswith("v=")]
        return f"{self.path}/v={max(taken, default=0) + 1:010d}"

    def stage(self, frame: DataFrame) -> str:
        """Write the next version without committing it."""
        folder = self.next_folder()
        schemas.evolve(frame, self.schema).write.mode("errorifexists").parquet(folder)
        return folder

    def commit(self, folder: str) -> None:
        Files(self.spark).mark(f"{folder}/{MARKER}")

    def replace(self, frame: DataFrame) -> str:
        folder = self.stage(frame)
        self.commit(folder)
        return folder

    def expire(self, keep: int = 2) -> int:
        """Delete committed versions older than the newest ``keep``; returns how many."""
        old = self._committed()[:-keep]
        for name in old:
            Files(self.spark).delete(f"{self.path}/{name}")
        return len(old)
