"""The append-only run log. Appending the same run twice leaves one copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago, clock
from desklake.sources.lake import Lake

LOG_PARTITIONS = ["log_day", "run_id"]
STORED = T.StructType(schemas.RUN_LOG.fields + [T.StructField(name, T.StringType()) for name in LOG_PARTITIONS])


def error_text(error: Exception) -> str:
    """The whole error message, or its kind when it has none; causes stand below the first line."""
    return str(error).strip() or type(error).__name__


def log_rows(events: DataFrame, run_id: str, at: Clock, job_id: str, **fixed) -> DataFrame:
    """Complete log rows for events; columns the events lack come from ``fixed`` or the defaults.

    Ids are hashes of what identifies an event, so a repeated run produces the same ones.
    """
    known = {name: F.lit(value) for name, value in fixed.items() if name not in events.columns}
    moments = {name: clock(at) for name in ("refresh_timestamp", "run_ts", "created_at") if name not in events.columns}
    complete = schemas.evolve_runlog(events.withColumns({**moments, **known, "job_id": F.lit(job_id)}))
    identity = F.xxhash64(F.lit(run_id), "view_name", "tenant_id", "file_format", "export_type", "file_path")
    return complete.withColumn("id", identity)


def runlog_append(lake: Lake, rows: DataFrame, run_id: str) -> None:
    """One folder per day and run; appending a run again replaces its folder."""
    (rows.withColumns({"log_day": F.date_format("refresh_timestamp", "yyyy-MM-dd"), "run_id": F.lit(run_id)})
     .hint("rebalance")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LOG_PARTITIONS).parquet(lake.log))


def runlog_read(lake: Lake) -> DataFrame:
    """Every logged row, in the present layout; older files lack columns and get their defaults."""
    if not lake.files.matches(f"{lake.log}/log_day=*"):
        return lake.spark.createDataFrame([], schemas.RUN_LOG)
    stored = lake.spark.read.schema(STORED).parquet(lake.log)
    filled = stored.fillna({k: v for k, v in schemas.RUN_LOG_DEFAULTS.items()})
    return filled.select(*schemas.RUN_LOG.names)


def runlog_purge(lake: Lake, as_of: Clock, days: int = V.LOG_RETENTION_DAYS) -> int:
    """Delete the folders of days that lie wholly before the retention limit; returns how many."""
    limit = lake.spark.range(1).select(F.date_format(ago(as_of, f"{days} days"), "yyyy-MM-dd")).first()[0]
    old = [name for name in lake.files.folders(lake.log) if name.startswith("log_day=") and name.removeprefix("log_day=") < limit]
    for name in old:
        lake.files.delete(f"{lake.log}/{name}")
    return len(old)
