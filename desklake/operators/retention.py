"""What to keep, move to a cheaper tier, or delete."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago, clock
from desklake.functions.numbers import format_bytes
from desklake.sources import manifest
from desklake.sources.files import blocks
from desklake.sources.lake import Lake

DELETERS = 16


def lifecycle_plan(inventory: DataFrame, as_of: Clock) -> DataFrame:
    """Tier per file by days since modification; superseded files go after a week.

    Ages compare strictly: a file modified exactly 30 days ago is still hot.
    """
    age = F.timestamp_diff("MICROSECOND", F.col("modified_at"), clock(as_of)) / F.lit(86_400_000_000.0)
    superseded = F.col("compaction_status").eqNullSafe(V.SUPERSEDED)
    tier = (F.when((age > V.DELETE_AFTER_DAYS) | (superseded & (age > V.SUPERSEDED_AFTER_DAYS)), "delete")
            .when(age > V.ARCHIVE_AFTER_DAYS, "archive").when(age > V.COOL_AFTER_DAYS, "cool").otherwise("hot"))
    return inventory.withColumn("tier", tier)


def lifecycle_totals(plan: DataFrame) -> DataFrame:
    """Files and bytes per tier."""
    return (plan.groupBy("tier").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("total_bytes"))
            .orderBy("tier"))


def runlog_retention(log: DataFrame, as_of: Clock, days: int = V.LOG_RETENTION_DAYS) -> DataFrame:
    """Log rows that stay."""
    return log.where(F.col("refresh_timestamp") >= ago(as_of, f"{days} days"))


def file_retention(inventory: DataFrame, as_of: Clock, days: int = V.LOG_RETENTION_DAYS) -> DataFrame:
    """File counts before and after deleting files whose age in whole days exceeds ``days``."""
    old = F.timestamp_diff("DAY", F.col("modified_at"), clock(as_of)) > days
    return inventory.agg(F.count(F.lit(1)).alias("files_before"), F.count_if(old).alias("files_deleted"),
                         F.count_if(~old).alias("files_after"))


def purge(lake: Lake, plan: DataFrame, at: datetime) -> int:
    """Delete the files whose tier in ``plan`` (a lifecycle plan of the manifest's inventory) says so; returns how many.

    The list is stored first and put down in the manifest last, so a call that was interrupted is made good by the next.
    """
    entry = f"purge_{at:%Y%m%d%H%M%S}"
    folder = f"{lake.root}/purge/{entry}"
    if not lake.files.exists(f"{folder}/_SUCCESS"):
        plan.where(F.col("tier") == "delete").write.mode("overwrite").parquet(folder)
    doomed = lake.spark.read.parquet(folder)
    with ThreadPoolExecutor(DELETERS) as pool:
        for block in blocks(row.path for row in doomed.select("path").toLocalIterator()):
            list(pool.map(lake.files.delete, block))
        for block in blocks(row.folder for row in doomed.select("folder").distinct().toLocalIterator()):
            list(pool.map(lake.files.delete_without_files, block))
    manifest.record(lake, doomed, entry, manifest.DELETED, entry, at)
    return doomed.count()


def largest_prefixes(inventory: DataFrame, top: int = 10) -> DataFrame:
    """The folders that hold most bytes."""
    prefix = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    sizes = inventory.groupBy(prefix.alias("prefix")).agg(
        F.sum("size_bytes").alias("total_bytes"), F.count(F.lit(1)).alias("files"))
    return (sizes.orderBy(F.desc("total_bytes"), "prefix").limit(top)
            .withColumn("size_text", format_bytes(F.col("total_bytes"))))


def compaction_candidates(inventory: DataFrame) -> DataFrame:
    """Per tenant, format and day: number of files and whether compaction would run."""
    days = inventory.groupBy("tenant_id", "format", "day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("total_bytes"))
    reason = F.when(F.col("files") == 1, "single_file")
    return (days.withColumns({"skip_reason": reason, "compact": reason.isNull()})
            .orderBy("tenant_id", "format", "day"))
