"""The stored wide view: a new version while readers keep the old one, of which only the months that could differ are written."""

from __future__ import annotations

import re
import time
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, clock
from desklake.functions.numbers import exact_sum, format_bytes
from desklake.operators.flat import with_calendar, with_measures, with_requester
from desklake.operators.runlog import log_rows, runlog_append
from desklake.sources.lake import Lake
from desklake.sources.versions import VersionedTable

EDITION = 1  # raised when a stored column is computed in another way, so that every month is written anew
ROWS_PER_SLICE = 5_000_000
KEEP_VERSIONS = 8
NO_MONTH = "none"
PRINT = "_print"  # a stored column beside those of the view: the fingerprint of the ticket a row was made from


def require_tables(tables: dict[str, VersionedTable]) -> None:
    """An error naming every table that has no committed version."""
    missing = [name for name, table in tables.items() if not table.exists()]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}; build them first")


def month_key(created: Column) -> Column:
    return F.coalesce(F.date_format(created, "yyyy-MM"), F.lit(NO_MONTH))


def in_months(created: Column, months: set[str]) -> Column:
    """Whether a moment lies in one of the months, told as ranges of time that a scan can push down."""
    plain = sorted(12 * int(m[:4]) + int(m[5:]) - 1 for m in months if re.fullmatch("[0-9]{4}-[0-9]{2}", m))
    other = [m for m in months if m != NO_MONTH and not re.fullmatch("[0-9]{4}-[0-9]{2}", m)]
    firsts = [n for n in plain if n - 1 not in set(plain)]
    lasts = [n for n in plain if n + 1 not in set(plain)]
    ranges = [(created >= clock(_first_day(a))) & (created < clock(_first_day(b + 1))) for a, b in zip(firsts, lasts)]
    rest = ([created.isNull()] if NO_MONTH in months else []) + ([month_key(created).isin(other)] if other else [])
    return reduce(Column.__or__, ranges + rest, F.lit(False))


def _first_day(month: int) -> str:
    return f"{month // 12:04d}-{month % 12 + 1:02d}-01"


def ticket_print() -> Column:
    columns = [F.col(name) for name in schemas.TICKETS.names]
    return F.xxhash64(F.lit(EDITION), *columns, *[column.isNull() for column in columns])


def month_prints(tickets: DataFrame, month: Column | None = None, row: Column | None = None) -> DataFrame:
    """Rows, open tickets and an order-free fingerprint of the tickets of each month; combines on the map side."""
    told = tickets.select((month_key(F.col("created_at")) if month is None else month).alias("month"), "finish_time",
                          (ticket_print() if row is None else row).alias("row"))
    return told.groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("finish_time").isNull()).alias("open_rows"),
        exact_sum(F.col("row")).alias("print"))


def month_sizes(tickets: DataFrame) -> DataFrame:
    """Rows of each month, for which a source is read by one column."""
    return tickets.groupBy(month_key(F.col("created_at")).alias("month")).agg(F.count(F.lit(1)).alias("rows"))


def stored_prints(lake: Lake, folder: str, months: set[str]) -> DataFrame:
    """The same as :func:`month_prints`, from the rows that a version's folder holds of ``months``."""
    rows = lake.spark.read.schema(f"finish_time timestamp_ntz, {PRINT} bigint, month string").option("basePath", folder).parquet(
        *[f"{folder}/month={month}" for month in sorted(months)])
    return month_prints(rows, F.col("month"), F.col(PRINT))


def renamed_months(tickets: DataFrame, names: DataFrame, before: DataFrame) -> set[str]:
    """Months with tickets of requesters that came, went or changed their name since ``before``."""
    sides = names.select("id", "name", F.lit(1).alias("side")).unionAll(before.select("id", "name", F.lit(-1).alias("side")))
    changed = sides.groupBy("id", "name").agg(F.sum("side").alias("side")).where("side <> 0").select(F.col("id").alias("requester_id"))
    if changed.isEmpty():
        return set()
    hit = tickets.select("requester_id", "created_at").join(changed, "requester_id", "left_semi")
    return {row.month for row in hit.select(month_key(F.col("created_at")).alias("month")).distinct().toLocalIterator()}


def clustered(tickets: DataFrame, months: DataFrame) -> DataFrame:
    """Rows with their month, those of a month and tenant together and in time order, so row-group statistics serve tenant and time filters.

    A month is cut into as many slices of tenants as its counted rows call for; the rebalance splits a slice that one
    tenant fills and joins small ones by measured size. ``months`` has one row per month.
    """
    slices = months.select("month", F.ceil(F.col("rows") / ROWS_PER_SLICE).alias("slices"))
    return (tickets.withColumn("month", month_key(F.col("created_at"))).join(F.broadcast(slices), "month")
            .withColumn("slice", F.pmod(F.xxhash64("tenant_id"), "slices"))
            .hint("rebalance", "month", "slice").sortWithinPartitions("month", "tenant_id", "created_at", "id"))


def refresh_flat(lake: Lake, tickets: DataFrame, users: DataFrame, as_of: Clock, run_id: str,
                 keep: int = KEEP_VERSIONS, full: bool = False) -> str:
    """Build, check and commit the next version of the wide view; log the run and signal its completion.

    Only months that could differ are written: those with open tickets, whose durations follow the clock, those whose
    tickets have another fingerprint than in the version before, and those of requesters renamed since. The others are
    named where they lie; ``full`` writes all. A version with repeated ids is logged as FAILED and never becomes current.
    The newest ``keep`` versions stay readable.
    """
    started = time.time()
    table, spark = lake.snapshot, lake.spark
    before, folder = table.current(), table.next_folder()
    # The names are stored first and joined as stored, so that a change meanwhile is found by the next refresh.
    users.select("id", "name").write.parquet(f"{folder}/users")
    names = spark.read.schema(schemas.USERS).parquet(f"{folder}/users")
    known = {} if full else {row.month: row for row in table.months(before).toLocalIterator()}
    # With nothing to compare every month is written, so the source need not be read for fingerprints first: they are stored with the rows.
    found = {row.month: row for row in (month_prints if known else month_sizes)(tickets).toLocalIterator()}
    stale = {month for month, row in found.items()
             if not known or row.open_rows or month not in known or (known[month].rows, known[month].print) != (row.rows, row.print)}
    if known:
        stale |= renamed_months(tickets, names, spark.read.schema(schemas.USERS).parquet(f"{before}/users")) & set(found)
    written = set()
    if stale:
        source = tickets.where(in_months(F.col("created_at"), stale)).withColumn(PRINT, ticket_print())
        counts = spark.createDataFrame([(month, found[month].rows) for month in sorted(stale)], "month string, rows bigint")
        # The columns that follow from a ticket are made after the shuffle, which carries the ticket alone.
        rows = clustered(with_requester(source, names), counts)
        written = table.stage_months(folder, with_calendar(with_measures(rows, as_of)), PRINT)
    prints = found if known or not written else {row.month: row for row in stored_prints(lake, folder, written).toLocalIterator()}
    version = folder.rsplit("/", 1)[1]
    parts = [(month, f"{version}/month={month}" if month in stale else known[month].folder, row.rows, prints[month].open_rows, prints[month].print)
             for month, row in sorted(found.items()) if month in written or month not in stale]
    months = spark.createDataFrame(parts, schemas.MONTHS)
    rows = sum(part[2] for part in parts)
    repeated = _repeats_ids(lake, [f"{table.path}/{part[1]}" for part in parts if part[0] in stale],
                            [f"{table.path}/{part[1]}" for part in parts if part[0] not in stale])
    seconds = round(time.time() - started, 2)
    status, error = (V.FAILED, "repeated ticket ids") if repeated else (V.SUCCESS, None)
    if not repeated:
        table.commit_months(folder, months)
    events = spark.createDataFrame([(name, status, rows, seconds, error) for name in ([V.FLAT_VIEW] if repeated else [V.FLAT_VIEW, V.ALL_VIEWS])],
                                   "view_name string, status string, rows_affected bigint, duration_seconds double, error_message string")
    runlog_append(lake, log_rows(events, run_id, as_of, "refresh", task_id="refresh_flat"), run_id)
    if repeated:
        raise ValueError(f"snapshot not committed: {error}")
    _signal(lake, folder, as_of, run_id)
    table.expire(keep)
    return folder


def _repeats_ids(lake: Lake, written: list[str], carried: list[str]) -> bool:
    """Whether an id stands twice in the written folders, or there and in a carried one; carried ones were checked when written."""
    if not written:
        return False
    ids = lake.spark.read.schema("id bigint").parquet(*written)
    if not ids.groupBy("id").count().where("count > 1").isEmpty():
        return True
    if not carried:
        return False
    others = lake.spark.read.schema("id bigint").parquet(*carried).withColumnRenamed("id", "other")
    return not others.join(ids, F.col("other").eqNullSafe(F.col("id")), "left_semi").isEmpty()


def _signal(lake: Lake, folder: str, as_of: Clock, run_id: str) -> None:
    """A one-row file per completed refresh, which streams follow."""
    event = lake.spark.range(1).select(F.lit(run_id).alias("run_id"), clock(as_of).alias("as_of"), F.lit(folder).alias("folder"))
    event.coalesce(1).write.mode("append").parquet(lake.signals)


def analyze_snapshot(lake: Lake, name: str = V.FLAT_VIEW) -> None:
    """Register the current version as a table and collect column statistics for the optimizer."""
    require_tables({name: lake.snapshot})
    spark, months = lake.spark, list(lake.snapshot.months().toLocalIterator())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not months:
        spark.catalog.createTable(name, path=lake.snapshot.current(), source="parquet", schema=lake.snapshot.schema)
    else:
        # The month is a partition of the table, so a filter on it opens the folders of those months only.
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lake.snapshot.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (created_year_month) LOCATION '{lake.snapshot.current()}'")
        values = ((f"'{row.month}'" if row.month != NO_MONTH else "NULL", row.folder) for row in months)
        parts = " ".join(f"PARTITION (created_year_month = {value}) LOCATION '{lake.snapshot.path}/{folder}'" for value, folder in values)
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def snapshot_stats(lake: Lake) -> DataFrame:
    """Files, bytes and rows of the current version, and whether it holds any."""
    require_tables({V.FLAT_VIEW: lake.snapshot})
    folders = lake.snapshot.folders()
    found = (lake.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders).select("length") if folders
             else lake.spark.createDataFrame([], "length bigint"))
    files = (found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")))
    rows = lake.snapshot.read().select(F.count(F.lit(1))).scalar()
    return files.select(F.lit(V.FLAT_VIEW).alias("view_name"), "files", "total_bytes",
                        format_bytes(F.col("total_bytes")).alias("total_size"), rows.alias("total_rows"),
                        (rows > 0).alias("is_populated"))
