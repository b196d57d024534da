"""A versioned table kept by month, whose versions share the months that did not change.

A version holds data folders ``month=<key>`` of the months it rewrote and a table ``months`` that names the folder of
every month it consists of, its own or an older version's. Both count once the version is committed. A version written
by ``replace`` is one folder without months and is read as such.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake.sources.files import Files
from desklake.sources.versions import MARKER, VersionedTable

MONTHS = schemas.MONTHS


@dataclass
class MonthlyTable(VersionedTable):

    def months(self, version: str | None = None) -> DataFrame:
        """One row per month of a version, the newest by default; no rows where there is none."""
        version = version or self.current()
        if version is None or not Files(self.spark).exists(f"{version}/months"):
            return self.spark.createDataFrame([], MONTHS)
        return self.spark.read.schema(MONTHS).parquet(f"{version}/months")

    def folders(self, version: str | None = None) -> list[str]:
        """Data folders of a version: one per month, or the version itself when it has none."""
        version = version or self.current()
        if version is None:
            return []
        if not Files(self.spark).exists(f"{version}/months"):
            return [version]
        return sorted(f"{self.path}/{row.folder}" for row in self.months(version).select("folder").toLocalIterator())

    def read(self, version: str | None = None) -> DataFrame:
        folders = self.folders(version)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def stage_months(self, folder: str, frame: DataFrame, *beside: str) -> set[str]:
        """Write the rows of rewritten months, given with their key in a column ``month``, into a new version's folder;
        returns the keys that had rows. Columns ``beside`` the table's are stored too, but not read with it."""
        frame.select("month", *self.schema.names, *beside).write.mode("append").partitionBy("month").parquet(folder)
        return {name.removeprefix("month=") for name in Files(self.spark).folders(folder) if name.startswith("month=")}

    def commit_months(self, folder: str, months: DataFrame) -> None:
        """Name the months of a staged version and commit it."""
        schemas.evolve(months, MONTHS).coalesce(1).write.parquet(f"{folder}/months")
        self.commit(folder)

    def versions(self) -> DataFrame:
        """Committed versions with their months, how many of them each wrote itself, and their rows; versions without rows are left out."""
        stored = [f"{self.path}/{name}/months" for name in self._committed() if Files(self.spark).exists(f"{self.path}/{name}/months")]
        found = self.spark.read.schema(MONTHS).parquet(*stored) if stored else self.spark.createDataFrame([], MONTHS)
        name = F.regexp_extract("_metadata.file_path", "/(v=[0-9]+)/months/", 1) if stored else F.lit(None).cast("string")
        return (found.select("*", name.alias("name")).groupBy(F.substring("name", 3, 20).cast("bigint").alias("version"))
                .agg(F.count(F.lit(1)).alias("months"),
                     F.count_if(F.startswith("folder", F.concat("name", F.lit("/")))).alias("months_rewritten"),
                     F.sum("rows").alias("total_rows")))

    def expire(self, keep: int = 2) -> int:
        """Delete committed versions older than the newest ``keep``, save the months that a kept version still names,
        and staged versions that were passed over; returns how many committed ones went.

        A version loses its marker first, so none is ever current with months missing; a stopped call is finished by the next.
        """
        files, committed = Files(self.spark), self._committed()
        kept = committed[-keep:]
        used = {name.removeprefix(f"{self.path}/") for version in kept for name in self.folders(f"{self.path}/{version}")}
        for name in committed[:-keep]:
            files.delete(f"{self.path}/{name}/{MARKER}")
        for name in files.folders(self.path):
            if kept and name.startswith("v=") and name < kept[-1] and name not in kept:
                inside = [f"{name}/{month}" for month in files.folders(f"{self.path}/{name}")]
                if not used.intersection(inside):
                    files.delete(f"{self.path}/{name}")
                    continue
                for old in set(inside) - used:
                    files.delete(f"{self.path}/{old}")
        return len(committed[:-keep])
