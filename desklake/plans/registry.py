"""All registered queries by name, each over the help-desk views of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import clock
from desklake.functions.formats import date_pattern
from desklake.functions.names import lake_path, slug
from desklake.operators import (compaction, export, flat, incremental, quality, retention, runlog as logstore, settings,
                                snapshot, watermark)
from desklake.operators.writer import lake_write
from desklake.plans import access, alerts, runlog, tickets
from desklake.session import shared_dir
from desklake.sources.fixtures import AS_OF_LOG, AS_OF_TICKETS, HelpDesk
from desklake.sources.lake import (Lake, lake_combine as combined, lake_read,
                                   lake_tenants as tenant_folders, register_tenants, scan_files)
from desklake.sources import manifest
from desklake.sources.relational import read_flat as sorted_flat
from desklake.streaming.export_stream import stream_export as follow_refreshes

Query = Callable[[HelpDesk], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(HelpDesk(spark, sf_dir))
    return {name: bind(function) for name, function in QUERIES.items()}


def _flat(desk: HelpDesk) -> DataFrame:
    return flat.tickets_flat(desk.tickets, desk.users, AS_OF_TICKETS)


# --- tickets ------------------------------------------------------------------------------------

@query
def tickets_flat(desk: HelpDesk) -> DataFrame:
    return _flat(desk)


@query
def flat_row_count(desk: HelpDesk) -> DataFrame:
    return tickets.flat_row_count(_flat(desk))


@query
def tickets_by_status(desk: HelpDesk) -> DataFrame:
    return tickets.tickets_by_status(desk.tickets)


@query
def active_by_sla(desk: HelpDesk) -> DataFrame:
    return tickets.active_by_sla_from_tickets(desk.tickets, AS_OF_TICKETS)


@query
def top_requesters(desk: HelpDesk) -> DataFrame:
    return tickets.top_requesters(desk.tickets, desk.users, AS_OF_TICKETS)


@query
def tickets_per_tenant(desk: HelpDesk) -> DataFrame:
    return tickets.tickets_per_tenant(desk.tickets, desk.tenants)


@query
def tenant_search(desk: HelpDesk) -> DataFrame:
    return incremental.tenant_search(desk.tenants, desk.tickets, names=["Nation_1", "_7"])


@query
def tenant_search_by_id(desk: HelpDesk) -> DataFrame:
    return incremental.tenant_search(desk.tenants, desk.tickets, ids=["3", "14", "99"])


@query
def tenant_slug(desk: HelpDesk) -> DataFrame:
    """Slugs of tenant and requester names decorated with their ids."""
    names = desk.tenants.select("name").unionByName(desk.users.select("name"))
    return names.select("name", slug(F.concat(F.lit("  Empresa "), F.col("name"), F.lit(" Ção & X! -- Ltd"))).alias("slug"))


@query
def partition_path(desk: HelpDesk) -> DataFrame:
    """Object name every ticket's export would have, were its creation the run time."""
    return desk.tickets.select("id", lake_path(F.col("tenant_id"), F.lit("parquet"), F.col("created_at")).alias("path"))


# --- run log ------------------------------------------------------------------------------------

@query
def refresh_duration_stats(desk: HelpDesk) -> DataFrame:
    return runlog.refresh_duration_stats(desk.runlog, AS_OF_LOG)


@query
def growth_trend(desk: HelpDesk) -> DataFrame:
    return runlog.growth_trend(desk.runlog, AS_OF_LOG)


@query
def failed_runs(desk: HelpDesk) -> DataFrame:
    return runlog.failed_runs(desk.runlog, AS_OF_LOG)


@query
def hourly_performance(desk: HelpDesk) -> DataFrame:
    return runlog.hourly_performance(desk.runlog, AS_OF_LOG)


@query
def daily_success_rate(desk: HelpDesk) -> DataFrame:
    return runlog.daily_success_rate(desk.runlog, AS_OF_LOG)


@query
def export_stats_by_tenant(desk: HelpDesk) -> DataFrame:
    return runlog.export_stats_by_tenant(desk.runlog, desk.tenants)


@query
def export_stats_by_format(desk: HelpDesk) -> DataFrame:
    return runlog.export_stats_by_format(desk.runlog, desk.tenants)


@query
def compaction_history(desk: HelpDesk) -> DataFrame:
    return runlog.compaction_history(desk.runlog, desk.tenants)


@query
def recent_exports(desk: HelpDesk) -> DataFrame:
    return runlog.recent_exports(desk.runlog, desk.tenants, AS_OF_LOG)


@query
def export_failures(desk: HelpDesk) -> DataFrame:
    return runlog.export_failures(desk.runlog, desk.tenants, AS_OF_LOG)


@query
def daily_export_summary(desk: HelpDesk) -> DataFrame:
    return runlog.daily_export_summary(desk.runlog, AS_OF_LOG)


@query
def weekly_compaction_stats(desk: HelpDesk) -> DataFrame:
    return runlog.weekly_compaction_stats(desk.runlog, AS_OF_LOG)


@query
def recent_runs(desk: HelpDesk) -> DataFrame:
    return runlog.recent_runs(desk.runlog, AS_OF_LOG)


@query
def run_status_stats(desk: HelpDesk) -> DataFrame:
    return runlog.run_status_stats(desk.runlog, AS_OF_LOG)


@query
def runs_last_minutes(desk: HelpDesk) -> DataFrame:
    return runlog.runs_last_minutes(desk.runlog, AS_OF_LOG)


@query
def activity_report(desk: HelpDesk) -> DataFrame:
    return runlog.activity_report(desk.runlog, desk.tickets, AS_OF_LOG, AS_OF_TICKETS)


@query
def evolve_runlog(desk: HelpDesk) -> DataFrame:
    """Rows of the first log layout brought to the present one."""
    first_layout = desk.runlog.select("id", "refresh_timestamp", "view_name", "status", "rows_affected",
                                      "duration_seconds", "error_message", "job_id", "task_id")
    return schemas.evolve_runlog(first_layout).select(
        "id", "status", "duration_seconds", "files_created", "files_deleted", "duplicates_removed", "file_format",
        "tenant_id", "export_type").withColumn("duration_seconds", F.col("duration_seconds").cast("double"))


@query
def runlog_retention(desk: HelpDesk) -> DataFrame:
    kept = retention.runlog_retention(desk.runlog, clock("2024-02-15 00:00:00"))
    return kept.groupBy("view_name").agg(F.count(F.lit(1)).alias("rows_kept"), F.min("refresh_timestamp").alias("oldest"))


@query
def failure_streaks(desk: HelpDesk) -> DataFrame:
    return alerts.failure_streaks(desk.runlog)


# --- settings -----------------------------------------------------------------------------------

def _csv_changes(desk: HelpDesk) -> DataFrame:
    n = F.col("id").cast("int")
    return desk.tenants.where(n % 3 == 0).select(
        F.col("id").alias("tenant_id"), F.lit(";").alias("csv_delimiter"),
        F.when(n % 2 == 0, "latin1").alias("csv_encoding"))


def _settings_text(frame: DataFrame) -> DataFrame:
    return settings.display_formats(frame).select(
        "tenant_id", "export_formats", "csv_delimiter", "csv_encoding", "active", "notes")


@query
def export_config(desk: HelpDesk) -> DataFrame:
    wanted = desk.tenants.select(F.col("id").alias("tenant_id"))
    return settings.display_formats(settings.export_config(wanted, desk.settings)).drop("csv_quoting")


@query
def settings_bootstrap(desk: HelpDesk) -> DataFrame:
    return _settings_text(settings.settings_bootstrap(desk.tenants, desk.settings, AS_OF_LOG))


@query
def settings_enable_csv(desk: HelpDesk) -> DataFrame:
    return _settings_text(settings.settings_enable_csv(desk.settings, _csv_changes(desk), AS_OF_LOG))


@query
def settings_stamps(desk: HelpDesk) -> DataFrame:
    """Who changed which settings rows when, after CSV was switched on for some tenants."""
    changed = settings.settings_enable_csv(desk.settings, _csv_changes(desk), AS_OF_LOG)
    return changed.where(F.col("updated_at") == clock(AS_OF_LOG)).select("tenant_id", "updated_by", "updated_at")


@query
def csv_date_formats(desk: HelpDesk) -> DataFrame:
    """Creation times as CSV files of tenants with various date formats show them."""
    formats = ["%Y-%m-%d %H:%M:%S", "%d/%m/%y", "%b %d, %Y %I:%M %p", "%B (%j) %Y", "%Y%m%dT%H%M%S.%f", "on %d at %H h", "100%% %Y", "%d.%m.%Y"]
    chosen = F.element_at(F.array(*map(F.lit, formats)), (F.col("id") % len(formats) + 1).cast("int"))
    dated = desk.tickets.select("id", chosen.alias("date_format"), "created_at")
    return dated.select("id", "date_format", F.call_function("date_format", "created_at", date_pattern(F.col("date_format"))).alias("shown"))


@query
def settings_enable_csv_for_all(desk: HelpDesk) -> DataFrame:
    everyone = desk.tenants.select(F.col("id").alias("tenant_id"))
    return _settings_text(settings.settings_enable_csv(desk.settings, everyone, AS_OF_LOG))


@query
def settings_disable_csv(desk: HelpDesk) -> DataFrame:
    return _settings_text(settings.settings_disable_csv(desk.settings, _csv_changes(desk), AS_OF_LOG))


@query
def settings_change_outcomes(desk: HelpDesk) -> DataFrame:
    return settings.change_outcomes(_csv_changes(desk), desk.settings)


@query
def csv_enabled_tenants(desk: HelpDesk) -> DataFrame:
    return settings.display_formats(settings.csv_enabled_tenants(desk.settings, desk.tenants)).drop("created_at", "updated_at")


@query
def formats_summary(desk: HelpDesk) -> DataFrame:
    summary = settings.formats_summary(desk.tenants, desk.settings)
    return summary.withColumn("formats_used", F.array_join("formats_used", ",", "NULL"))


@query
def settings_totals(desk: HelpDesk) -> DataFrame:
    return settings.settings_totals(desk.settings)


@query
def tenant_formats(desk: HelpDesk) -> DataFrame:
    shown = settings.display_formats(settings.tenant_formats(desk.tenants, desk.settings))
    return shown.select("tenant_id", "tenant_name", F.col("export_formats").alias("formats"), "csv_delimiter",
                        "csv_encoding", "active")


@query
def tenant_detail(desk: HelpDesk) -> DataFrame:
    shown = settings.display_formats(settings.tenant_detail(desk.tenants, desk.settings, "7"))
    return shown.select("tenant_id", "tenant_name", F.col("export_formats").alias("formats"), "csv_delimiter",
                        "csv_encoding", "csv_quoting", "csv_date_format", "parquet_compression", "active", "notes")


@query
def dq_settings(desk: HelpDesk) -> DataFrame:
    """Violations after the stored words were damaged for some tenants."""
    n = F.col("tenant_id").cast("int")
    damaged = desk.settings.withColumns({
        "export_formats": F.when(n % 4 == 0, F.array_append("export_formats", F.lit("xlsx"))).otherwise(F.col("export_formats")),
        "csv_delimiter": F.when(n % 6 == 0, "#").otherwise(F.col("csv_delimiter")),
        "csv_encoding": F.when(n % 9 == 0, "utf-16").otherwise(F.col("csv_encoding")),
        "parquet_compression": F.when(n % 8 == 0, "lzo").otherwise(F.col("parquet_compression")),
    })
    return settings.settings_violations(damaged)


# --- marks and slices ---------------------------------------------------------------------------

@query
def watermark_bootstrap(desk: HelpDesk) -> DataFrame:
    new = watermark.watermark_bootstrap(desk.tenants, desk.tickets, desk.marks, AS_OF_TICKETS)
    return new.select("tenant_id", "last_exported_created_at", "rows_exported", "export_type")


@query
def watermark_bootstrap_replay(desk: HelpDesk) -> DataFrame:
    new = watermark.watermark_bootstrap_replay(desk.tenants, desk.marks, AS_OF_TICKETS)
    return new.select("tenant_id", "last_exported_created_at", "rows_exported", "export_type")


@query
def watermark_reset(desk: HelpDesk) -> DataFrame:
    reset = watermark.watermark_reset(desk.marks, ["4", "12"], AS_OF_TICKETS)
    return reset.select("tenant_id", "last_exported_created_at", "rows_exported", "export_type", "notes")


@query
def incremental_slice(desk: HelpDesk) -> DataFrame:
    taken = incremental.incremental_slice(_flat(desk), desk.marks, AS_OF_TICKETS, bound=desk.tenants)
    return taken.select("id", "tenant_id", "created_at", "finish_time", "ticket_status", "sla_status",
                        "duration_minutes", "requester_name", "export_type")


def _slice_totals(desk: HelpDesk) -> DataFrame:
    rows = desk.tickets.select("id", "tenant_id", "created_at", "finish_time")
    return incremental.slice_totals(incremental.incremental_slice(rows, desk.marks, AS_OF_TICKETS, bound=desk.tenants))


def _outcomes(desk: HelpDesk) -> DataFrame:
    """One outcome per tenant and format; tenants divisible by four fail in every format."""
    n = F.col("id").cast("int")
    formats = F.explode(F.array(F.lit("parquet"), F.lit("csv")))
    each = desk.tenants.select("id", F.col("id").alias("tenant_id"), formats.alias("format"))
    bad = (n % 4 == 0) | ((n % 4 == 1) & (F.col("format") == "csv"))
    return each.select("tenant_id", "format", F.when(bad, "ERROR").otherwise("SUCCESS").alias("status"))


@query
def next_watermark(desk: HelpDesk) -> DataFrame:
    return incremental.next_watermark(_slice_totals(desk), _outcomes(desk))


@query
def export_summary(desk: HelpDesk) -> DataFrame:
    everyone = desk.tenants.select(F.col("id").alias("tenant_id"))
    return incremental.export_summary(_slice_totals(desk), _outcomes(desk), everyone)


@query
def watermark_upsert(desk: HelpDesk) -> DataFrame:
    updates = incremental.next_watermark(_slice_totals(desk), _outcomes(desk))
    merged = watermark.watermark_upsert(desk.marks, updates, AS_OF_TICKETS)
    return merged.select("tenant_id", "last_exported_created_at", "last_export_success_at", "rows_exported", "export_type")


@query
def watermark_latest(desk: HelpDesk) -> DataFrame:
    """Newest log entry per tenant, the run log read as a ledger of marks."""
    ledger = desk.runlog.where(F.col("tenant_id").isNotNull()).select(
        "tenant_id", F.col("refresh_timestamp").alias("updated_at"),
        F.col("id").alias("last_exported_created_at"), F.col("rows_affected").alias("rows_exported"))
    newest = watermark.watermark_latest(ledger)
    return newest.select("tenant_id", "updated_at", F.col("last_exported_created_at").alias("log_id"), "rows_exported")


@query
def watermark_status(desk: HelpDesk) -> DataFrame:
    return watermark.watermark_status(desk.marks, desk.tenants, desk.tickets, AS_OF_TICKETS)


@query
def lagging_exports(desk: HelpDesk) -> DataFrame:
    status = watermark.watermark_status(desk.marks, desk.tenants, desk.tickets, AS_OF_TICKETS)
    return watermark.lagging_exports(status, hours=6.0)


@query
def stale_tenants(desk: HelpDesk) -> DataFrame:
    return watermark.stale_tenants(desk.tenants, desk.marks, AS_OF_TICKETS)


@query
def missed_rows(desk: HelpDesk) -> DataFrame:
    """Tickets that arrived late: the lake here holds what was created at least an hour before the hour's end."""
    rows = desk.tickets.select("id", "tenant_id", "created_at", "title")
    lake = rows.where(F.minute("created_at") < 45)
    return incremental.missed_rows(rows, lake, desk.marks, bound=desk.tenants)


@query
def tenant_reconciliation(desk: HelpDesk) -> DataFrame:
    """Lake folders named with twice each tenant's number against the tenants that have tickets."""
    folders = desk.tenants.select((F.col("id").cast("int") * 2).cast("string").alias("tenant_id"))
    return incremental.tenant_reconciliation(folders, desk.tickets)


@query
def export_full(desk: HelpDesk) -> DataFrame:
    """Rows per tenant that a full export writes."""
    folders = desk.tenants.select(F.col("id").alias("tenant_id"))
    taken = incremental.full_slice(_flat(desk), folders)
    return taken.groupBy("tenant_id", "export_type").agg(F.count(F.lit(1)).alias("rows"), F.max("created_at").alias("newest"))


# --- files --------------------------------------------------------------------------------------

@query
def compaction_candidates(desk: HelpDesk) -> DataFrame:
    return retention.compaction_candidates(desk.inventory)


@query
def lifecycle_plan(desk: HelpDesk) -> DataFrame:
    return retention.lifecycle_plan(desk.inventory, AS_OF_LOG).select("path", "day", "modified_at", "tier")


@query
def lifecycle_totals(desk: HelpDesk) -> DataFrame:
    return retention.lifecycle_totals(retention.lifecycle_plan(desk.inventory, AS_OF_LOG))


@query
def file_retention(desk: HelpDesk) -> DataFrame:
    return retention.file_retention(desk.inventory, AS_OF_LOG)


@query
def largest_prefixes(desk: HelpDesk) -> DataFrame:
    return retention.largest_prefixes(desk.inventory)


@query
def growth_alerts(desk: HelpDesk) -> DataFrame:
    return alerts.growth_alerts(desk.inventory)


# --- access log ---------------------------------------------------------------------------------

@query
def access_per_hour(desk: HelpDesk) -> DataFrame:
    return access.access_per_hour(desk.access_log)


@query
def access_quality(desk: HelpDesk) -> DataFrame:
    return access.access_quality(desk.access_log, AS_OF_LOG)


@query
def access_by_tenant(desk: HelpDesk) -> DataFrame:
    return access.access_by_tenant(desk.access_log, AS_OF_LOG)


@query
def access_alerts(desk: HelpDesk) -> DataFrame:
    return access.access_alerts(desk.access_log)


# --- data quality -------------------------------------------------------------------------------

@query
def dq_duplicate_ids(desk: HelpDesk) -> DataFrame:
    """Ids of the log and of the tickets in one table: those that both use are held twice."""
    ids = desk.tickets.select("id").unionByName(desk.runlog.select("id"))
    return quality.duplicate_ids(ids)


@query
def dq_keys(desk: HelpDesk) -> DataFrame:
    return quality.key_violations({
        "tickets": (desk.tickets, "id"), "users": (desk.users, "id"), "tenants": (desk.tenants, "id"),
        "runlog_by_tenant": (desk.runlog, "tenant_id"), "marks": (desk.marks, "tenant_id")})


@query
def dq_orphans(desk: HelpDesk) -> DataFrame:
    return quality.orphan_counts({"runlog": desk.runlog, "tickets": desk.tickets, "settings": desk.settings}, desk.tenants)


@query
def drop_orphans(desk: HelpDesk) -> DataFrame:
    """Log rows of existing tenants, as a cascading delete would leave them."""
    kept = quality.drop_orphans(desk.runlog, desk.tenants)
    return kept.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("rows"), F.max("refresh_timestamp").alias("newest"))


@query
def dq_isolation(desk: HelpDesk) -> DataFrame:
    """Tickets filed by tenant, where some ids landed in the folder of tenant 0."""
    misfiled = F.when(F.col("id") % 97 == 0, "0").otherwise(F.col("tenant_id"))
    return quality.isolation_breaches(desk.tickets.select("id", "tenant_id", misfiled.alias("tenant_key")))


@query
def dedup_stats(desk: HelpDesk) -> DataFrame:
    """Two full exports; between them every ticket was renamed that was not created in one hour of the day."""
    rows = desk.tickets.select("id", "tenant_id", "title", "status", "created_at")
    renamed = rows.withColumn("title", F.when(F.hour("created_at") == 13, F.col("title")).otherwise(F.upper(F.concat("title", F.lit("!")))))
    twice = rows.unionByName(renamed)
    return compaction.dedup_stats(twice, ["tenant_id"], ["id", "title", "status", "created_at"])


@query
def compaction_summary(desk: HelpDesk) -> DataFrame:
    """Totals over logged compactions."""
    runs = desk.runlog.where((F.col("export_type") == "COMPACTION") & F.col("tenant_id").isNotNull())
    results = runs.select(
        "tenant_id", F.when(F.col("status") == "SUCCESS", "success").otherwise("error").alias("status"),
        F.col("files_deleted").alias("files_before"), F.col("files_created").alias("files_after"), "duplicates_removed")
    return compaction.compaction_summary(results)


# --- the stored lake: each query writes one below the shared folder and reads it back ---------------

RUN = datetime(2001, 8, 2, 0, 0, 0)
RUN_DAY = "2001-08-02"


def _lake(desk: HelpDesk) -> Lake:
    """A lake with the snapshot, marks, settings and folders of every tenant."""
    lake = Lake(desk.spark, shared_dir(desk.spark, "lake"))
    steps = [lambda: snapshot.refresh_flat(lake, desk.tickets, desk.users, AS_OF_TICKETS, "refresh_1"),
             lambda: lake.marks.replace(desk.marks), lambda: lake.settings.replace(desk.settings),
             lambda: register_tenants(lake, desk.tenants.select(F.col("id").alias("tenant_id")))]
    with ThreadPoolExecutor(len(steps)) as pool:  # none needs another's result; the small ones fill cores that the refresh leaves idle
        for step in [pool.submit(step) for step in steps]:
            step.result()
    return lake


@query
def refresh_flat(desk: HelpDesk) -> DataFrame:
    """The wide view as read back from its stored version."""
    return _lake(desk).snapshot.read()


@query
def refresh_months(desk: HelpDesk) -> DataFrame:
    """Versions of the wide view after three refreshes: without the newest months, with them, and with the texts of one
    old month and the name of one requester changed. Tickets before May 2001 count as finished."""
    lake = Lake(desk.spark, shared_dir(desk.spark, "lake"))
    created, finished = F.col("created_at"), F.col("finish_time")
    settled = desk.tickets.withColumn(
        "finish_time", F.when(created < clock("2001-05-01"), F.coalesce(finished, F.timestamp_add("DAY", F.lit(1), created))).otherwise(finished))
    retitled = F.when(F.trunc(created, "month") == "1996-03-01", F.concat("title", F.lit("!"))).otherwise(F.col("title"))
    renamed = F.when(F.col("id") == 2, F.concat("name", F.lit(" II"))).otherwise(F.col("name"))
    snapshot.refresh_flat(lake, settled.where(created < clock("2001-06-01")), desk.users, RUN.replace(month=6), "refresh_1")
    snapshot.refresh_flat(lake, settled, desk.users, AS_OF_TICKETS, "refresh_2")
    snapshot.refresh_flat(lake, settled.withColumn("title", retitled), desk.users.withColumn("name", renamed), AS_OF_TICKETS, "refresh_3")
    stored = lake.snapshot.read()
    return lake.snapshot.versions().withColumns({
        "retitled_rows": stored.select(F.count_if(F.endswith("title", F.lit("!")))).scalar(),
        "renamed_rows": stored.select(F.count_if(F.endswith("requester_name", F.lit(" II")))).scalar()})


@query
def read_flat(desk: HelpDesk) -> DataFrame:
    """Every row of the stored wide view in its export order, with the columns that identify it."""
    return sorted_flat(_lake(desk)).select("tenant_id", "id", "created_at", "sla_status", "requester_name")


@query
def lake_tenants(desk: HelpDesk) -> DataFrame:
    return tenant_folders(_lake(desk))


@query
def lake_combine(desk: HelpDesk) -> DataFrame:
    """All Parquet files of a lake as one table, whatever folders they lie in; CSV files are passed over."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    return combined(desk.spark, lake.data).groupBy("tenant_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


@query
def lake_combine_first(desk: HelpDesk) -> DataFrame:
    """The rows of the first Parquet file of an export by name."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    return combined(desk.spark, lake.data, limit_files=1).groupBy("tenant_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def export_replay(desk: HelpDesk) -> DataFrame:
    """Slices of one run written again as CSV after its files were merged, for tenants whose CSV counts as failed, as logged and as stored."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3))
    failed = desk.tenants.where(F.col("id").cast("int") % 5 == 1).select(F.col("id").alias("tenant_id"))
    export.export_replay(lake, failed, RUN, "csv")
    stored = lake_read(lake, "csv", day=RUN_DAY, run="20010802_000000").groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("stored_rows"), F.max("created_at").alias("newest"))
    logged = logstore.runlog_read(lake).where(F.col("view_name") == "export_replay")
    return logged.join(stored, "tenant_id", "left").select(
        "tenant_id", "status", "rows_affected", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"), "newest")


@query
def snapshot_stats(desk: HelpDesk) -> DataFrame:
    """Bytes and files depend on the writer, so it is told that there are some and that the size text is that of the bytes."""
    stats = snapshot.snapshot_stats(_lake(desk))
    return stats.select("view_name", "total_rows", "is_populated", (F.col("files") > 0).alias("has_files"),
                        ((F.col("total_bytes") > 0) & (F.length("total_size") > 3)).alias("sized"))


@query
def export_run(desk: HelpDesk) -> DataFrame:
    lake = _lake(desk)
    done = export.export_run(lake, lake.snapshot.read(), RUN)
    return done.select("tenant_id", "file_format", "status", "rows_affected", "export_type", "last_exported_created_at", "files_created")


@query
def lake_read_parquet(desk: HelpDesk) -> DataFrame:
    """Rows of an incremental export as found in its Parquet files."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    return lake_read(lake).select("id", "tenant_key", "created_at", "finish_time", "duration_minutes", "sla_status",
                                  "requester_name", "created_day_name", "format", "year", "month", "day", "run")


@query
def lake_read_csv(desk: HelpDesk) -> DataFrame:
    """The same from CSV files written with each tenant's delimiter, encoding and date format."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    return lake_read(lake, "csv").select("id", "tenant_key", "created_at", "finish_time", "duration_minutes", "sla_status",
                                         "requester_name", "created_day_name", "format", "year", "month", "day", "run")


@query
def lake_read_dialects(desk: HelpDesk) -> DataFrame:
    """Tickets with awkward titles as read back from CSV files of every allowed encoding and quoting, delimiters in turn."""
    lake = Lake(desk.spark, shared_dir(desk.spark, "lake"))
    title = F.when(F.col("id") % 7 != 0, F.concat("title", F.lit(' "ã" ;,|\t\r\n'), F.col("id").cast("string")))
    words = [(encoding, quoting) for encoding in V.ALLOWED_ENCODINGS for quoting in settings.WRITABLE_QUOTING]
    rows = _flat(desk).withColumns({"title": title, "number": F.pmod(F.col("tenant_id").cast("int"), F.lit(len(words)))})
    # The view is made once and stored by dialect, so that each write reads the rows of its own tenants alone.
    rows.write.partitionBy("number").parquet(f"{lake.root}/by_dialect")
    stored = desk.spark.read.schema(T.StructType([*schemas.FLAT.fields, T.StructField("number", T.IntegerType())])).parquet(f"{lake.root}/by_dialect")

    def write(number: int, encoding: str, quoting: str) -> None:
        dialect = settings.Dialect("csv", V.ALLOWED_DELIMITERS[number % len(V.ALLOWED_DELIMITERS)], encoding, quoting)
        lake_write(stored.where(F.col("number") == number).drop("number"), lake.data, dialect, RUN_DAY, f"dialect_{number}")

    with ThreadPoolExecutor(export.WRITERS) as pool:  # a dialect has few tenants, so one alone leaves cores idle
        list(pool.map(write, range(len(words)), *zip(*words)))
    return lake_read(lake, "csv").select(
        "id", "tenant_id", F.split("dialect", r"\.")[1].alias("encoding"), F.split("dialect", r"\.")[2].alias("quoting"),
        F.md5("title").alias("title_md5"), "created_at", "finish_time", "duration_minutes", "requester_name")


@query
def compact_mismatch(desk: HelpDesk) -> DataFrame:
    """Staged merged files against what they should hold, after the staged files of two tenants were lost."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3), publish_now=False)
    for tenant in ("6", "12"):
        for folder in lake.files.matches(f"{lake.root}/compaction/*/*/data/tenant_key={tenant}"):
            lake.files.delete(folder)
    return compaction.staged_check(lake, RUN_DAY)


@query
def watermark_after_export(desk: HelpDesk) -> DataFrame:
    """Stored marks after two runs, of which the second finds nothing new for tenants with a mark."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_run(lake, lake.snapshot.read(), RUN.replace(minute=15))
    return lake.marks.read().select("tenant_id", "last_exported_created_at", "rows_exported", "export_type")


@query
def runlog_append(desk: HelpDesk) -> DataFrame:
    """The run log of a refresh and an export, the export repeated with the same run time."""
    lake, marks = _lake(desk), desk.marks
    export.export_run(lake, lake.snapshot.read(), RUN)
    lake.marks.replace(marks)
    export.export_run(lake, lake.snapshot.read(), RUN)
    return (logstore.runlog_read(lake).groupBy("view_name", "status", "file_format", "export_type", "files_created")
            .agg(F.count(F.lit(1)).alias("entries"), F.sum("rows_affected").alias("rows_affected"),
                 F.count_distinct("id").alias("ids")))


@query
def lake_status_counts(desk: HelpDesk) -> DataFrame:
    """Tickets by status since a date, counted from a full export."""
    lake = _lake(desk)
    export.export_full(lake, lake.snapshot.read(), RUN)
    return tickets.status_counts_since(lake_read(lake), "1998-01-01 00:00:00")


@query
def compact(desk: HelpDesk) -> DataFrame:
    """A day with an incremental and a full export: what compaction did per tenant and format."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    done = compaction.compact(lake, RUN_DAY, RUN.replace(day=3))
    return done.select("tenant_id", "file_format", "status", "reason", "rows_before", "rows_after", "duplicates_removed")


@query
def lake_after_compaction(desk: HelpDesk) -> DataFrame:
    """Rows left in the Parquet files after compaction ran twice with a late file between."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3))
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=30))
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3, hour=1))
    return (lake_read(lake).groupBy("tenant_key")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_distinct("run").alias("runs"),
                 F.max("created_at").alias("newest")))


@query
def file_inventory(desk: HelpDesk) -> DataFrame:
    """Folders per tenant and format after an incremental export."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    return (manifest.inventory(lake, RUN_DAY, RUN_DAY).groupBy("tenant_id", "format", "file_day")
            .agg(F.count_distinct("folder").alias("folders"), (F.min("size_bytes") > 0).alias("all_filled")))


@query
def logged_files(desk: HelpDesk) -> DataFrame:
    """What the run log says an export has made, against the files that are there."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    logged = logstore.runlog_read(lake).where(F.col("view_name") == "export_tickets")
    there = scan_files(lake, RUN_DAY).groupBy("tenant_id", F.col("format").alias("file_format")).agg(
        F.count(F.lit(1)).alias("files"), F.min("folder").alias("folder"))
    return logged.join(there, ["tenant_id", "file_format"], "full").select(
        "tenant_id", "file_format", "files", (F.col("files_created") == F.col("files")).alias("same_count"),
        F.col("folder").endswith(F.col("file_path")).alias("same_folder"))


def _two_months(desk: HelpDesk) -> Lake:
    """A full export in June, one in July, and an incremental and a full one on a day of August that is compacted."""
    lake = _lake(desk)
    for month in (6, 7):
        export.export_full(lake, lake.snapshot.read(), RUN.replace(month=month))
    lake.marks.replace(desk.marks)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    return lake


@query
def stored_candidates(desk: HelpDesk) -> DataFrame:
    """Files to merge per tenant, format and day of a stored lake; the same day of two months stays apart."""
    return retention.compaction_candidates(manifest.inventory(_two_months(desk))).drop("total_bytes")


@query
def stored_lifecycle_plan(desk: HelpDesk) -> DataFrame:
    """Tiers of the files of a stored lake after a compaction, which leaves none of its inputs."""
    lake = _two_months(desk)
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3))
    plan = retention.lifecycle_plan(manifest.inventory(lake), "2001-09-02 00:00:00")
    return plan.groupBy("tenant_id", "format", "day", "tier").agg(F.count(F.lit(1)).alias("files"))


@query
def stored_file_purge(desk: HelpDesk) -> DataFrame:
    """Files of a stored lake before and after those past their age are deleted, by the manifest and by the file system."""
    lake = _two_months(desk)
    before, at = manifest.inventory(lake), datetime(2003, 6, 20)
    counted = before.agg(F.count(F.lit(1)).alias("files_before")).first()[0]
    deleted = retention.purge(lake, retention.lifecycle_plan(before, at), at)
    listed = scan_files(lake).groupBy("file_day").agg(F.count(F.lit(1)).alias("files_there"))
    return (manifest.inventory(lake).groupBy("file_day").agg(F.count(F.lit(1)).alias("files_left")).join(listed, "file_day", "full")
            .withColumns({"files_before": F.lit(counted), "files_deleted": F.lit(deleted).cast("long")}))


@query
def compact_recovered(desk: HelpDesk) -> DataFrame:
    """The run log of a compaction that stopped before it published and was finished by a later call."""
    lake = _lake(desk)
    export.export_run(lake, lake.snapshot.read(), RUN)
    export.export_full(lake, lake.snapshot.read(), RUN.replace(minute=15))
    compaction.compact(lake, RUN_DAY, RUN.replace(day=3), publish_now=False)
    compaction.finish_pending(lake, RUN_DAY, RUN.replace(day=3, hour=1))
    return logstore.runlog_read(lake).where(F.col("view_name") == "lake_compaction").select(
        "tenant_id", "file_format", "status", "rows_affected", "files_created", "files_deleted", "duplicates_removed", "refresh_timestamp")


@query
def stream_export(desk: HelpDesk) -> DataFrame:
    """Exports that a stream of refresh signals set off, as logged."""
    lake = _lake(desk)
    for _ in range(2):  # the second drain finds no new signal
        follow_refreshes(lake, f"{lake.root}/stream").awaitTermination()
    exports = logstore.runlog_read(lake).where(F.col("view_name") == "export_tickets")
    return exports.select("tenant_id", "file_format", "status", "rows_affected", "export_type", "refresh_timestamp")
