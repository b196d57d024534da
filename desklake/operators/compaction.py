"""Merging the small files of one day, for all tenants in one job per writer dialect.

The merged rows are first written to a staging folder and checked there. Only then does each staged folder
move next to its inputs, under a name of its own, and only then are the inputs deleted. A crash before the
check leaves the lake as it was; after it, the next call finishes the move from what is staged.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock
from desklake.functions.numbers import exact_sum, six_places
from desklake.operators.joins import TENANT_TASKS, is_small
from desklake.operators.runlog import error_text, log_rows, runlog_append
from desklake.operators.settings import Dialect, dialect_columns, distinct_dialects, export_config, is_dialect, writable
from desklake.operators.writer import ROWS_PER_FILE, gathered, lake_rows, write_partitions
from desklake.sources import manifest
from desklake.sources.files import blocks
from desklake.sources.lake import Lake, csv_stem, lake_read, lake_tenants, scan_files

GROUP = ["tenant_key", "format"]
CONSOLIDATED = "_consolidated"
CHECKED = "_CHECKED"
MOVERS = 16
DIALECTS = 8


def plan_day(files: DataFrame, enabled: DataFrame) -> DataFrame:
    """Per tenant and enabled format of one day: its files, and why it is skipped if it is.

    One file is consolidated already. So are several that one earlier compaction wrote, which it does
    when a tenant's day exceeds one file.
    """
    groups = files.groupBy("tenant_id", "format").agg(
        F.count(F.lit(1)).alias("files_before"), F.count_distinct("run").alias("runs"),
        F.count_if(~F.col("run").contains(CONSOLIDATED)).alias("loose"))
    whole = (F.col("files_before") == 1) | ((F.col("loose") == 0) & (F.col("runs") == 1))
    reason = F.when(F.col("files_before").isNull(), "no_files").when(whole, "single_file")
    return (enabled.join(groups, ["tenant_id", "format"], "left")
            .select(*enabled.columns, F.coalesce("files_before", F.lit(0)).alias("files_before"), reason.alias("reason")))


def deduplicate(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per distinct row of a tenant and format; or per ``keys``, the latest run winning.

    Both are aggregates, so copies are folded before the shuffle however many there are; rows that come :func:`gathered`
    are folded where they are. Whole rows are compared without the dialect and run they were written in.
    """
    content = [*GROUP, *schemas.FLAT.names]
    if keys is None:
        # Packed, a row is copied as one value by both steps of the aggregate. Floats stay outside, or each step would build the struct anew.
        apart = [*GROUP, *[f.name for f in schemas.FLAT.fields if isinstance(f.dataType, T.DoubleType)]]
        slices = [name for name in rows.columns if name == "_slice"]
        packed = rows.select(*apart, *slices, F.struct(*[name for name in content if name not in apart]).alias("row")).distinct()
        return packed.select("*", "row.*").select(*content, *slices)
    identity = [*GROUP, *keys]
    rest = [c for c in content if c not in identity]
    latest = F.max_by(F.struct(*rest), F.struct("run", F.xxhash64(*content))).alias("row")
    return rows.groupBy(*identity).agg(latest).select(*identity, *[F.col(f"row.{c}").alias(c) for c in rest])


def _print(seed: int, columns: list[str]) -> Column:
    # Structs hash like their fields in turn, but in methods of their own, which the compiler does not refuse for their length.
    return F.xxhash64(F.lit(seed), F.struct(*columns), F.struct(*[F.col(name).isNull().alias(name) for name in columns]))


def _told_by(file_format: str, keys: list[str] | None) -> list[str]:
    """Columns that tell rows of merged files: all where files keep them exactly, else those that every dialect keeps."""
    return list(keys) if keys else schemas.FLAT.names if file_format == V.PARQUET else ["id"]


def expected_rows(rows: DataFrame, file_format: str, keys: list[str] | None = None) -> DataFrame:
    """Per tenant and format: rows, distinct rows, and an order-free fingerprint of the distinct ones.

    Only hashes are shuffled, 128 bits a row. It depends on the input alone, not on how often a task ran.
    """
    identity, told = schemas.FLAT.names if keys is None else list(keys), _told_by(file_format, keys)
    prints = {"a": _print(1, identity), "b": _print(2, identity), "told": _print(3, told)}
    if told == identity:  # the third is as good as the first
        del prints["a"]
    hashed = rows.select(*GROUP, *[value.alias(name) for name, value in prints.items()])
    distinct = hashed.groupBy(*GROUP, *prints).agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy(*GROUP).agg(F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("rows_expected"),
                                        exact_sum(F.col("told")).alias("print_expected"))


def staged_rows(rows: DataFrame, file_format: str, keys: list[str] | None = None) -> DataFrame:
    """Per tenant and format: rows of merged files and their fingerprint, copies included."""
    told = rows.select(*GROUP, _print(3, _told_by(file_format, keys)).alias("told"))
    return told.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows_after"), exact_sum(F.col("told")).alias("print_after"))


def _matches() -> Column:
    return F.col("rows_expected").eqNullSafe(F.col("rows_after")) & F.col("print_expected").eqNullSafe(F.col("print_after"))


def staged_check(lake: Lake, day: str, keys: list[str] | None = None) -> DataFrame:
    """Whether the files staged for ``day`` still hold exactly the rows they should, per tenant and format."""
    checks = [lake.spark.createDataFrame([], "tenant_id string, file_format string, rows_expected bigint, rows_staged bigint, matches boolean")]
    for path in _pending(lake, day):
        folder = path.rsplit("/", 1)[0]
        counts = lake.spark.read.parquet(f"{folder}/counts").drop("rows_after", "print_after")
        file_format = V.CSV if lake.files.matches(f"{folder}/data/*/format={V.CSV}") else V.PARQUET
        staged = staged_rows(lake_read(Lake(lake.spark, folder), file_format), file_format, keys)
        checks.append(counts.join(staged, GROUP, "left").select(
            F.col("tenant_key").alias("tenant_id"), F.col("format").alias("file_format"), "rows_expected",
            F.coalesce("rows_after", F.lit(0)).alias("rows_staged"), _matches().alias("matches")))
    return reduce(DataFrame.unionByName, checks)


def dedup_stats(rows: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Rows before and after and copies removed per group, when ``columns`` decide what a copy is."""
    per_row = rows.groupBy(*group, *columns).agg(F.count(F.lit(1)).alias("n"))
    return (per_row.groupBy(*group).agg(F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
            .withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after")))


def compaction_summary(results: DataFrame) -> DataFrame:
    """One row of totals over a run's results."""
    good = F.col("status") == "success"

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(good, F.col(name))), F.lit(0))

    saved = F.try_divide((F.col("files_before") - F.col("files_after")) * 100.0, F.col("files_before"))
    return (results.groupBy("tenant_id").agg(
                F.max(F.when(good, 1).otherwise(0)).alias("done"), total("files_before").alias("files_before"),
                total("files_after").alias("files_after"), total("duplicates_removed").alias("duplicates_removed"))
            .agg(F.count(F.lit(1)).alias("tenants_total"), F.sum("done").alias("tenants_compacted"),
                 F.sum(1 - F.col("done")).alias("tenants_skipped"), F.sum("files_before").alias("files_before"),
                 F.sum("files_after").alias("files_after"), F.sum("duplicates_removed").alias("duplicates_removed"))
            .withColumn("files_saved_percent", six_places(F.coalesce(saved, F.lit(0.0)))))


def _staging(lake: Lake, day: str) -> str:
    return f"{lake.root}/compaction/day={day}"


def compact(lake: Lake, day: str, run_ts: datetime, keys: list[str] | None = None, publish_now: bool = True) -> DataFrame:
    """Compact every tenant and enabled format of ``day``; one result row each, skipped ones included.

    Merged files are written in the tenant's present dialect, whatever its inputs were written in. Without ``publish_now`` they stay
    staged and checked until :func:`finish_pending` or the next call, as after a crash.
    """
    finish_pending(lake, day, run_ts)
    staging, spark = _staging(lake, day), lake.spark
    name = f"{day.replace('-', '')}{CONSOLIDATED}_{run_ts:%Y%m%d%H%M%S}"
    lake.files.delete(staging)
    # The day's file list is fixed first; files that arrive later are not among the inputs.
    manifest.adopt(lake, day, run_ts)
    scan_files(lake, day).write.parquet(f"{staging}/listing")
    files = spark.read.parquet(f"{staging}/listing")
    enabled = dialect_columns(export_config(lake_tenants(lake), lake.settings.read()))
    plan_day(files, enabled).write.parquet(f"{staging}/plan")
    plan = spark.read.parquet(f"{staging}/plan")
    chosen = plan.where(F.col("reason").isNull())
    # Dialects share no folder; a small one need not wait for a large one, and uses the cores that the large one's last tasks leave.
    with ThreadPoolExecutor(DIALECTS) as pool:
        outcomes = list(pool.map(lambda dialect: _compact_dialect(
            lake, day, run_ts, name, chosen.where(is_dialect(dialect)), files, dialect, keys, publish_now), distinct_dialects(chosen)))
    _results(lake, plan, outcomes).write.mode("overwrite").parquet(f"{lake.root}/results/{name}")
    results = spark.read.parquet(f"{lake.root}/results/{name}")
    if not _pending(lake, day):
        lake.files.delete(staging)
    _log(lake, results, run_ts, name)
    return results


def _compact_dialect(lake: Lake, day: str, run_ts: datetime, name: str, groups: DataFrame, files: DataFrame, dialect: Dialect,
                     keys: list[str] | None, publish_now: bool) -> tuple[Dialect, str, str | None, float, DataFrame | None]:
    """Stage, check and publish one dialect.

    A failure before publishing leaves the inputs in place; one while publishing is made good by the next call.
    """
    started = time.time()
    folder = f"{_staging(lake, day)}/{dialect.codec if dialect.file_format == V.PARQUET else csv_stem(dialect)}"
    try:
        counts = _stage(lake, day, name, groups, files, dialect, keys, folder)
        if not publish_now:
            return dialect, "staged", None, round(time.time() - started, 2), counts
        publish(lake, folder, run_ts)
        return dialect, "success", None, round(time.time() - started, 2), counts
    except Exception as error:
        return dialect, "error", error_text(error), round(time.time() - started, 2), None


def _stage(lake: Lake, day: str, name: str, groups: DataFrame, files: DataFrame, dialect: Dialect,
           keys: list[str] | None, folder: str) -> DataFrame:
    """Write the merged rows and the list of input folders, and check that they hold exactly the distinct rows of the input."""
    spark = lake.spark
    # One row per tenant, format and run of the day: broadcast when few, as they mostly are.
    listed = files.select("folder", *GROUP, "run").distinct()
    few = is_small(listed)
    hint = F.broadcast if few else (lambda frame: frame)
    formats = hint(groups.select(F.col("tenant_id").alias("tenant_key"), "format", F.col("date_format").alias("_date_format")))
    inputs = listed.join(formats, GROUP, "left_semi")
    rows = lake_read(lake, dialect.file_format, day=day).join(hint(inputs.select(*GROUP, "run")), [*GROUP, "run"], "left_semi")
    before = expected_rows(rows, dialect.file_format, keys).coalesce(TENANT_TASKS).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = before.select("tenant_key", F.col("rows_before").alias("n"))
    # Where most rows stay, one shuffle gathers them for folding and writing; where most are copies, they are folded before it.
    once = few and keys is None and not dialect.as_lines and before.select(F.sum("rows_expected") * 2 > F.sum("rows_before")).first()[0]
    merged = deduplicate(gathered(rows, ROWS_PER_FILE, sizes) if once else rows, keys).join(formats, GROUP)
    shaped = lake_rows(merged, dialect, day, name, F.col("_date_format"), folder_of="tenant_key")
    write_partitions(shaped, f"{folder}/data", dialect, counts=sizes, ready=bool(once))
    staged = Lake(spark, folder)
    after = staged_rows(lake_read(staged, dialect.file_format), dialect.file_format, keys)
    scan_files(staged, day).write.parquet(f"{folder}/made")
    made = spark.read.parquet(f"{folder}/made").groupBy(*GROUP).agg(F.count(F.lit(1)).alias("files_after"))
    files.join(inputs, [*GROUP, "run"], "left_semi").write.parquet(f"{folder}/inputs")
    taken = spark.read.parquet(f"{folder}/inputs").groupBy(*GROUP).agg(F.count(F.lit(1)).alias("files_before"))
    before.join(after, GROUP, "left").join(made, GROUP, "left").join(taken, GROUP, "left").write.parquet(f"{folder}/counts")
    before.unpersist()
    counts = spark.read.parquet(f"{folder}/counts")
    rows_wanted, rows_found, wrong = counts.agg(F.sum("rows_expected"), F.sum("rows_after"), F.count_if(~_matches())).first()
    if wrong:
        raise ValueError(f"validation failed: {rows_found} rows staged, {rows_wanted} expected, {wrong} groups wrong")
    lake.files.mark(f"{folder}/{CHECKED}")
    return counts


def publish(lake: Lake, folder: str, at: Clock) -> None:
    """Move the staged folders into the lake, then delete the input files. Safe to repeat after a crash.

    The manifest is told of the new files and of what they supersede before anything is deleted, and of the deletions after them. Only
    listed files go, with folders they leave empty; a file that came into an input folder meanwhile stays.
    """
    files, spark = lake.files, lake.spark
    moves = files.matches(f"{folder}/data/tenant_key=*/format=*/dialect=*/year=*/month=*/day=*/run=*")
    marker = f"{folder}/data/"
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda source: files.move(source, f"{lake.data}/{source.split(marker, 1)[1]}"), moves))
        made, inputs = spark.read.parquet(f"{folder}/made"), spark.read.parquet(f"{folder}/inputs")
        name = made.select("run", "dialect", "format").first()
        entry = f"{name.run}_{folder.rsplit('/', 1)[1]}" if name else CONSOLIDATED
        manifest.record(lake, made, entry, manifest.LIVE, entry, at)
        manifest.record(lake, inputs, f"{entry}_superseded", V.SUPERSEDED, entry, at)
        for block in blocks(row.path for row in inputs.select("path").toLocalIterator()):
            list(pool.map(files.delete, block))
        for block in blocks(row.folder for row in inputs.select("folder").distinct().toLocalIterator()):
            list(pool.map(files.delete_without_files, block))
        manifest.record(lake, inputs, f"{entry}_deleted", manifest.DELETED, entry, at)
    files.delete(f"{folder}/{CHECKED}")


def _pending(lake: Lake, day: str) -> list[str]:
    return lake.files.matches(f"{_staging(lake, day)}/*/{CHECKED}")


def finish_pending(lake: Lake, day: str, run_ts: datetime) -> int:
    """Publish and log what an interrupted compaction had staged and checked; returns how many dialects."""
    checked = _pending(lake, day)
    for path in checked:
        folder = path.rsplit("/", 1)[0]
        publish(lake, folder, run_ts)
        counts = lake.spark.read.parquet(f"{folder}/counts")
        done = counts.select(F.col("tenant_key").alias("tenant_id"), F.col("format").alias("file_format"), F.lit("success").alias("status"),
                             F.lit("recovered").alias("reason"), "rows_after", F.lit(0.0).alias("duration_seconds"), "files_after",
                             F.col("files_before").alias("files_deleted"), (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"))
        _log(lake, done, run_ts, f"{day.replace('-', '')}_recovered_{folder.rsplit('/', 1)[1]}_{run_ts:%Y%m%d%H%M%S}")
    return len(checked)


def _results(lake: Lake, plan: DataFrame, outcomes: list) -> DataFrame:
    """Plan rows with their outcome, counts and times."""
    counts = lake.spark.createDataFrame(
        [], "tenant_key string, format string, rows_before bigint, rows_after bigint, files_after bigint")
    refused = F.col("reason").isNull() & ~writable()
    state = F.when(refused, "error").otherwise("skipped")
    reason = F.when(refused, "dialect not supported").otherwise(F.col("reason"))
    seconds = F.lit(0.0)
    for dialect, status, error, duration, found in outcomes:
        mine = is_dialect(dialect) & F.col("reason").isNull()
        state = F.when(mine, status).otherwise(state)
        reason = F.when(mine, F.lit(error)).otherwise(reason)
        seconds = F.when(mine, duration).otherwise(seconds)
        counts = counts.unionByName(found.select(*counts.columns)) if found is not None else counts
    marked = plan.select("tenant_id", "format", "files_before", state.alias("status"), reason.alias("why"),
                         seconds.alias("duration_seconds"))
    none = F.lit(0)
    return marked.join(counts.withColumnRenamed("tenant_key", "tenant_id"), ["tenant_id", "format"], "left").select(
        "tenant_id", F.col("format").alias("file_format"), "status", F.col("why").alias("reason"), "files_before",
        F.coalesce("files_after", none).alias("files_after"), F.coalesce("rows_before", none).alias("rows_before"),
        F.coalesce("rows_after", none).alias("rows_after"),
        F.coalesce(F.col("rows_before") - F.col("rows_after"), none).alias("duplicates_removed"),
        F.when(F.col("status") == "success", F.col("files_before")).otherwise(none).alias("files_deleted"), "duration_seconds")


def _log(lake: Lake, results: DataFrame, run_ts: datetime, name: str) -> None:
    """One log row per tenant and format that was compacted or failed."""
    events = results.where(~F.col("status").isin("skipped", "staged")).select(
        "tenant_id", "file_format", F.when(F.col("status") == "success", V.SUCCESS).otherwise(V.ERROR).alias("status"),
        F.col("rows_after").alias("rows_affected"), "duration_seconds", F.col("reason").alias("error_message"),
        F.col("files_after").alias("files_created"), "files_deleted", "duplicates_removed")
    runlog_append(lake, log_rows(events, name, run_ts, "lake_compaction", view_name="lake_compaction", task_id="compact",
                                 export_type=V.COMPACTION, export_destination=V.EXPORT_DESTINATION,
                                 store_account=lake.account, container=lake.container), f"compaction_{name}")
