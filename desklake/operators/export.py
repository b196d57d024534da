"""Exports: one set-based job over all tenants, written once per distinct writer dialect."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago, clock
from desklake.operators import incremental, settings as options
from desklake.operators.joins import TENANT_TASKS, is_small, join_per_tenant
from desklake.operators.runlog import error_text, log_rows, runlog_append
from desklake.operators.settings import Dialect
from desklake.operators.watermark import watermark_upsert
from desklake.operators.writer import lake_write
from desklake.sources import manifest
from desklake.sources.lake import Lake, lake_read, lake_tenants, run_folder, scan_files
from desklake.sources.versions import VersionedTable

WRITERS = 8


def _attempt(job) -> tuple[str, float, str | None]:
    """Run one write; its failure becomes an outcome so that other dialects go on."""
    started = time.time()
    try:
        job()
        return V.SUCCESS, round(time.time() - started, 2), None
    except Exception as error:
        return V.ERROR, round(time.time() - started, 2), error_text(error)


def _counts(totals: DataFrame) -> DataFrame:
    return totals.select(F.col("tenant_id").alias("tenant_key"), F.col("rows_exported").alias("n"))


def write_all(lake: Lake, rows: DataFrame, totals: DataFrame, assignments: DataFrame, day: str, run: str) -> DataFrame:
    """Write the rows of every tenant in each of its formats; one outcome per tenant and format.

    ``totals`` has the row count per tenant, ``assignments`` a row per tenant and format with the dialect columns. Only dialects of the closed
    lists are gathered, some fifty at most; anything else is an error outcome without a job.
    """
    small = is_small(assignments)

    def write(dialect: Dialect) -> tuple:
        chosen = assignments.where(options.is_dialect(dialect)).select("tenant_id", F.col("date_format").alias("_date_format"))
        mine = join_per_tenant(rows, chosen, how="inner", small=small)
        counts = _counts(totals.join(chosen, "tenant_id", "left_semi"))
        return *astuple(dialect), *_attempt(
            lambda: lake_write(mine, lake.data, dialect, day, run, F.col("_date_format"), counts))

    # Dialects are independent jobs; a small one need not wait for a large one.
    with ThreadPoolExecutor(WRITERS) as pool:
        outcomes = list(pool.map(write, options.distinct_dialects(assignments)))
    schema = ", ".join(f"{name} string" for name in options.DIALECT_COLUMNS)
    done = lake.spark.createDataFrame(outcomes, f"{schema}, status string, duration_seconds double, error_message string")
    able = F.col("_able")
    refused = F.concat(F.lit("Format, codec or CSV option not supported: "),
                       F.concat_ws(" ", *options.DIALECT_COLUMNS, "date_format"))
    return (assignments.withColumn("_able", options.writable()).join(F.broadcast(done), options.DIALECT_COLUMNS, "left")
            .select("tenant_id", F.col("format").alias("file_format"),
                    F.when(able, F.col("status")).otherwise(V.ERROR).alias("status"),
                    F.coalesce("duration_seconds", F.lit(0.0)).alias("duration_seconds"),
                    F.when(able, F.col("error_message")).otherwise(refused).alias("error_message"),
                    F.when(able, run_folder(day, run)).alias("folder")))


def _files_made(lake: Lake, outcomes: DataFrame, run_ts: datetime, run: str, entry: str | None = None) -> DataFrame:
    """tenant_id, file_format and number of the files a run has written, which go into the manifest.

    Only the run's own folders are listed, one per tenant and format; Spark lists many of them in parallel.
    """
    written = outcomes.where((F.col("status") == V.SUCCESS) & F.col("folder").isNotNull()).select("folder").collect()
    made = scan_files(lake, folders=[f"{lake.data}/{row.folder}" for row in written]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if written:
            manifest.record(lake, made, entry or run, manifest.LIVE, run, run_ts)
        counts = made.groupBy("tenant_id", F.col("format").alias("file_format")).agg(F.count(F.lit(1)).cast("int").alias("files_created"))
        return lake.spark.createDataFrame(counts.collect(), counts.schema)  # a row per tenant and format
    finally:
        made.unpersist()


def _finish(lake: Lake, totals: DataFrame, outcomes: DataFrame, run_ts: datetime, run: str, job_id: str) -> DataFrame:
    """Put down the files, store and log every outcome, then move the marks: data, log and mark are written in this order.

    Outcomes that the run stored earlier for tenants not in ``totals`` stay, in the results and in the log.
    """
    good = F.col("status") == V.SUCCESS
    made = _files_made(lake, outcomes, run_ts, run)
    results = outcomes.join(totals, "tenant_id").join(F.broadcast(made), ["tenant_id", "file_format"], "left").withColumns({
        "rows_affected": F.when(good, F.col("rows_exported")).otherwise(F.lit(0)),
        "files_created": F.coalesce("files_created", F.lit(0)), "file_path": F.when(good, F.concat(F.lit("data/"), "folder"))}).drop("folder")
    kept = _results(lake, run)
    earlier = kept.read().join(totals.select("tenant_id"), "tenant_id", "left_anti")
    kept.replace(earlier.unionByName(results))
    stored = kept.read()
    events = stored.select("tenant_id", "file_format", "status", "rows_affected", "duration_seconds", "error_message",
                           "export_type", "file_path", "files_created")
    runlog_append(lake, log_rows(events, run, run_ts, job_id, view_name=job_id, task_id=job_id,
                                 export_destination=V.EXPORT_DESTINATION, store_account=lake.account,
                                 container=lake.container), f"{job_id}_{run}")
    done = stored.join(totals.select("tenant_id"), "tenant_id", "left_semi")
    updates = incremental.next_watermark(done.select("tenant_id", "last_exported_created_at", "rows_exported", "export_type").distinct(), done)
    lake.marks.replace(watermark_upsert(lake.marks.read(), updates, run_ts))
    return stored


def _run_name(run_ts: datetime, prefix: str = "", part: int = 1) -> tuple[str, str]:
    name = prefix + run_ts.strftime("%Y%m%d_%H%M%S")
    return run_ts.strftime("%Y-%m-%d"), name if part == 1 else f"{name}_{part}"


def _results(lake: Lake, run: str) -> VersionedTable:
    return VersionedTable(lake.spark, f"{lake.root}/results/{run}", schemas.EXPORT_RESULTS)


def _bounds(lake: Lake, run: str) -> VersionedTable:
    return VersionedTable(lake.spark, f"{lake.root}/bounds/{run}", schemas.EXPORT_BOUNDS)


def _export(lake: Lake, taken: DataFrame, marks: DataFrame, run_ts: datetime, part: int) -> DataFrame:
    """Write one slice under the name of its run and part, whose bounds are stored before any data."""
    day, run = _run_name(run_ts, part=part)
    taken = taken.persist(StorageLevel.MEMORY_AND_DISK)
    totals = incremental.slice_totals(taken).coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
    config = options.export_config(totals, lake.settings.read())
    assignments = options.dialect_columns(config).coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
    bounds = _bounds(lake, run)
    try:
        if totals.isEmpty() and part > 1:
            return _results(lake, run).read()
        if not bounds.exists() and not totals.isEmpty():
            lower = marks.select("tenant_id", F.col("last_exported_created_at").alias("lower"))
            bounds.replace(totals.select("tenant_id", F.col("last_exported_created_at").alias("upper")).join(lower, "tenant_id", "left"))
        outcomes = write_all(lake, taken, totals, assignments, day, run)
        return _finish(lake, totals, outcomes, run_ts, run, "export_tickets")
    finally:
        for kept in (assignments, totals, taken):
            kept.unpersist()


def _finish_part(lake: Lake, known: DataFrame, run_ts: datetime, as_of: Clock, part: int) -> None:
    """Write again, within its stored bounds, what a part took for tenants whose mark has not reached them."""
    now = lake.marks.read().select("tenant_id", F.col("last_exported_created_at").alias("mark"))
    behind = F.col("mark").isNull() | (F.col("mark") < F.col("upper"))
    unfinished = _bounds(lake, _run_name(run_ts, part=part)[1]).read().join(now, "tenant_id", "left").where(behind).select(
        "tenant_id", F.when(F.col("lower").isNotNull(), F.least("lower", "mark")).alias("lower"), "upper").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if unfinished.isEmpty():
            return
        marks = unfinished.where("lower IS NOT NULL").select("tenant_id", F.col("lower").alias("last_exported_created_at"))
        rows = join_per_tenant(known, unfinished.select("tenant_id", F.col("upper").alias("_upper")), how="inner")
        rows = rows.where(F.coalesce(F.col("created_at") <= F.col("_upper"), F.lit(True))).drop("_upper")
        _export(lake, incremental.incremental_slice(rows, marks, as_of), marks, run_ts, part)
    finally:
        unfinished.unpersist()


def export_run(lake: Lake, flat: DataFrame, run_ts: datetime, as_of: Clock | None = None) -> DataFrame:
    """Incremental export for every tenant with a folder; returns one row per tenant and format written under ``run_ts``.

    Tenants with nothing new appear nowhere. Called again with the same ``run_ts``, it first writes once more what an earlier call
    left unfinished, within the bounds that call had stored; rows beyond them go to a further part with a name of its own, so
    no file of a finished part is replaced. With nothing left to do it writes nothing and returns the stored results.
    """
    known = join_per_tenant(flat, lake_tenants(lake), how="left_semi")
    parts = 0
    while _bounds(lake, _run_name(run_ts, part=parts + 1)[1]).exists():
        parts += 1
        _finish_part(lake, known, run_ts, as_of or run_ts, parts)
    marks = lake.marks.read()
    fresh = _export(lake, incremental.incremental_slice(known, marks, as_of or run_ts), marks, run_ts, parts + 1)
    earlier = [_results(lake, _run_name(run_ts, part=part)[1]).read() for part in range(1, parts + 1)]
    return reduce(DataFrame.unionByName, [*earlier, fresh])


def export_full(lake: Lake, flat: DataFrame, run_ts: datetime, file_format: str = V.PARQUET) -> DataFrame:
    """All rows of every tenant with a folder, in one format with default options; sets marks and logs.

    The source is read twice, the first time for the totals, which need two columns, rather than kept: it
    may be all history.
    """
    Dialect(file_format).writer_options()
    day, run = _run_name(run_ts, "full_")
    taken = incremental.full_slice(flat, lake_tenants(lake))
    totals = incremental.slice_totals(taken).coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        status, seconds, error = _attempt(
            lambda: lake_write(taken, lake.data, Dialect(file_format), day, run, counts=_counts(totals)))
        options_of = Dialect(file_format)
        placed = totals.withColumns({name: F.lit(value) for name, value in zip(options.DIALECT_COLUMNS, astuple(options_of))}
                                    | {"date_format": F.lit(V.DEFAULT_DATE_FORMAT)}).withColumn("folder", run_folder(day, run))
        outcomes = placed.select("tenant_id", F.lit(file_format).alias("file_format"), F.lit(status).alias("status"),
                                 F.lit(seconds).alias("duration_seconds"), F.lit(error).cast("string").alias("error_message"),
                                 "folder")
        return _finish(lake, totals, outcomes, run_ts, run, "export_initial")
    finally:
        totals.unpersist()


def export_replay(lake: Lake, failed: DataFrame, run_ts: datetime, file_format: str, part: int = 1) -> DataFrame:
    """Write the slices of one run (or a later part of it) again in a format that had failed, for the tenants in ``failed``; logged.

    The mark moved because another format succeeded, so the rows are taken from the day's files of that format, within the bounds the run
    had stored: from the run's own files or, once those are merged, from the merged ones. Each tenant gets its own dialect; one
    without rows in these bounds is an error outcome.
    """
    day, run = _run_name(run_ts, part=part)
    other = V.PARQUET if file_format == V.CSV else V.CSV
    wanted = failed.select("tenant_id").distinct()
    limits = _bounds(lake, run).read().select("tenant_id", F.col("lower").alias("_lower"), F.col("upper").alias("_upper"))
    window = ago(run_ts, V.FIRST_EXPORT_WINDOW)
    first = (F.col("created_at") >= window) | (F.col("finish_time") >= window)
    within = F.when(F.col("_lower").isNull(), first).otherwise(F.col("created_at") > F.col("_lower")) & (F.col("created_at") <= F.col("_upper"))
    limits = limits.join(wanted, "tenant_id", "left_semi").coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
    # Plain bounds that a scan can push down: merged files hold the whole day, of which the slices may be a small part.
    oldest, unmarked = limits.agg(F.min("_lower"), F.count_if(F.col("_lower").isNull()) > 0).first()
    reach = [F.col("created_at") > clock(oldest)] * (oldest is not None) + [first] * bool(unmarked)
    held = join_per_tenant(lake_read(lake, other, day=day).where(reduce(Column.__or__, reach, F.lit(False))), limits, how="inner").where(within)
    # One image of each row: the run's own where it is left, else that of the latest run.
    rest = [name for name in schemas.FLAT.names if name not in ("tenant_id", "id")]
    image = F.max_by(F.struct(*rest, "_lower"), F.struct(F.col("run") == run, "run")).alias("row")
    taken = held.groupBy("tenant_id", "id").agg(image).select("tenant_id", "id", "row.*").withColumn(
        "export_type", F.when(F.col("_lower").isNull(), V.FULL).otherwise(V.INCREMENTAL)).select(*schemas.FLAT.names, "export_type")
    # Stored, not kept in memory: a write into the lake makes Spark drop what it keeps of frames that read the lake, to compute it again.
    stage = f"{lake.root}/replay/{run}_{file_format}"
    totals = None
    try:
        taken.write.mode("overwrite").parquet(stage)
        rows = lake.spark.read.schema(taken.schema).parquet(stage)
        totals = incremental.slice_totals(rows).coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
        config = options.export_config(totals, lake.settings.read()).withColumn("export_formats", F.array(F.lit(file_format)))
        outcomes = write_all(lake, rows, totals, options.dialect_columns(config), day, run)
        made = _files_made(lake, outcomes, run_ts, run, f"{run}_replay_{file_format}")
        found = outcomes.join(totals, "tenant_id").join(F.broadcast(made), ["tenant_id", "file_format"], "left")
        missing = F.col("status").isNull()
        good = F.col("status") == V.SUCCESS
        results = wanted.join(found, "tenant_id", "left").select(
            "tenant_id", F.lit(file_format).alias("file_format"), F.coalesce("status", F.lit(V.ERROR)).alias("status"),
            F.coalesce("duration_seconds", F.lit(0.0)).alias("duration_seconds"),
            F.when(missing, "no rows of this run are left").otherwise(F.col("error_message")).alias("error_message"), "export_type",
            F.when(good, F.col("rows_exported")).otherwise(0).alias("rows_affected"), F.coalesce("files_created", F.lit(0)).alias("files_created"),
            F.when(good, F.concat(F.lit("data/"), "folder")).alias("file_path"))
        runlog_append(lake, log_rows(results, f"{run}_replay", run_ts, "export_replay", view_name="export_replay", task_id="export_replay",
                                     export_destination=V.EXPORT_DESTINATION, store_account=lake.account, container=lake.container),
                      f"export_replay_{run}_{file_format}")
        return lake.spark.createDataFrame(results.collect(), results.schema)  # a row per failed tenant
    finally:
        if totals is not None:
            totals.unpersist()
        limits.unpersist()
        lake.files.delete(stage)
