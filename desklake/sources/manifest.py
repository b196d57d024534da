"""The manifest: which data files the lake holds, as the runs that wrote, merged and deleted them put it down.

It is append-only. One step of one run is an entry, a folder below the day of the files it speaks of; repeating the step replaces its
entry. A file is live, then perhaps superseded by the run that merged it, then deleted; the furthest of its states counts. An
inventory is a fold of the entries of the days asked for, so nothing has to list the folders of the lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, clock
from desklake.sources.lake import Lake, scan_files

LIVE, DELETED = "live", "deleted"
STATES = [LIVE, V.SUPERSEDED, DELETED]


def record(lake: Lake, files: DataFrame, entry: str, state: str, by: str, at: Clock) -> None:
    """Put down one state of files, given as rows of :func:`scan_files` or :func:`inventory`, by the job's own clock."""
    rows = files.select(
        F.regexp_extract("path", "tenant_key=.*", 0).alias("path"), "tenant_id", "format", "dialect", "run", "size_bytes",
        F.lit(state).alias("state"), F.lit(by).alias("state_by"), clock(at).alias("state_at"),
        F.date_format("file_day", "yyyy-MM-dd").alias("file_day"), F.lit(entry).alias("entry"))
    (rows.coalesce(1 if state == LIVE else 8)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_day", "entry").parquet(lake.manifest))


def entries(lake: Lake) -> DataFrame:
    if not lake.files.exists(lake.manifest):
        return lake.spark.createDataFrame([], schemas.MANIFEST)
    return lake.spark.read.schema(schemas.MANIFEST).parquet(lake.manifest)


def inventory(lake: Lake, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """One row per file that is not deleted; days bound the run dates of the files and prune the entries that are read."""
    told = entries(lake)
    if first_day:
        told = told.where(F.col("file_day") >= first_day)
    if last_day:
        told = told.where(F.col("file_day") <= last_day)
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))
    per_file = told.groupBy("file_day", "path").agg(
        F.max_by(F.struct("tenant_id", "format", "dialect", "run", "size_bytes"), F.struct(rank, "state_at")).alias("file"),
        F.max(F.struct(rank.alias("rank"), "state_at", "state", "state_by")).alias("last"), F.min("state_at").alias("modified_at"))
    day = F.col("file_day").cast("date")
    return per_file.where(F.col("last.state") != DELETED).select(
        F.concat(F.lit(f"{lake.data}/"), "path").alias("path"),
        F.regexp_replace(F.concat(F.lit(f"{lake.data}/"), "path"), "/[^/]*$", "").alias("folder"), "file.size_bytes", "modified_at",
        "file.tenant_id", "file.tenant_id", "file.format", "file.dialect", "file.run", day.alias("file_day"), day.alias("day"),
        F.nullif("last.state", F.lit(LIVE)).alias("compaction_status"), "last.state_by"
    ).toDF("path", "folder", "size_bytes", "modified_at", "tenant_id", "tenant_key", "format", "dialect", "run", "file_day", "day",
           "compaction_status", "state_by")


def adopt(lake: Lake, day: str, at: Clock) -> None:
    """Put down files of one day that were written without the manifest; those it knows keep their state."""
    found = scan_files(lake, day)
    known = entries(lake).where(F.col("file_day") == day).select(F.concat(F.lit("/"), "path").alias("known"))
    relative = F.concat(F.lit("/"), F.regexp_extract("path", "tenant_key=.*", 0))
    record(lake, found.withColumn("known", relative).join(known, "known", "left_anti"), "adopted", LIVE, "adopted", at)
