"""Reports over the run log. ``as_of`` stands for "now" in every look-back window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago, as_date
from desklake.functions.numbers import percent, six_places
from desklake.operators.joins import join_per_tenant

# Column names; columns themselves need a running session.
RAN_AT = "refresh_timestamp"
DURATION = "duration_seconds"


def _runs() -> Column:
    return F.count(F.lit(1))


def _since(log: DataFrame, as_of: Clock, span: str) -> DataFrame:
    return log.where(F.col(RAN_AT) >= ago(as_of, span))


def _single_views(log: DataFrame) -> DataFrame:
    """Without completion markers; rows whose name is NULL go too, as SQL inequality has it."""
    return log.where(F.col("view_name") != V.ALL_VIEWS)


def _status_count(word: str) -> Column:
    return F.count_if(F.col("status") == word)


def _name_frame(tenants: DataFrame) -> DataFrame:
    return tenants.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"))


def _named_rows(log: DataFrame, tenants: DataFrame) -> DataFrame:
    """Log rows with tenant names; rows without tenant or with an unknown one stay."""
    return join_per_tenant(log, _name_frame(tenants), how="left", spread_by="id")


def refresh_duration_stats(log: DataFrame, as_of: Clock) -> DataFrame:
    return (_single_views(_since(log, as_of, "7 days")).groupBy("view_name")
            .agg(_runs().alias("total_executions"),
                 six_places(F.avg(DURATION)).alias("avg_duration_sec"),
                 F.min(DURATION).alias("min_duration_sec"),
                 F.max(DURATION).alias("max_duration_sec"),
                 six_places(F.stddev_samp(DURATION)).alias("stddev_duration_sec"),
                 _status_count(V.SUCCESS).alias("successful"),
                 _status_count(V.FAILED).alias("failed"))
            .orderBy(F.desc_nulls_first("avg_duration_sec"), "view_name"))


def growth_trend(log: DataFrame, as_of: Clock) -> DataFrame:
    good = _single_views(_since(log, as_of, "30 days")).where(F.col("status") == V.SUCCESS)
    return (good.groupBy(as_date(F.col(RAN_AT)).alias("date"), "view_name")
            .agg(six_places(F.avg("rows_affected")).alias("avg_rows"), F.max("rows_affected").alias("max_rows"))
            .orderBy(F.desc("date"), "view_name"))


def failed_runs(log: DataFrame, as_of: Clock) -> DataFrame:
    return (_since(log, as_of, "7 days").where(F.col("status") == V.FAILED)
            .select("refresh_timestamp", "view_name", "error_message", "job_id", "task_id")
            .orderBy(F.desc("refresh_timestamp")))


def hourly_performance(log: DataFrame, as_of: Clock) -> DataFrame:
    good = _single_views(_since(log, as_of, "7 days")).where(F.col("status") == V.SUCCESS)
    return (good.groupBy(F.hour(RAN_AT).alias("hour_of_day"), "view_name")
            .agg(_runs().alias("executions"), six_places(F.avg(DURATION)).alias("avg_duration_sec"))
            .orderBy("hour_of_day", "view_name"))


def daily_success_rate(log: DataFrame, as_of: Clock) -> DataFrame:
    daily = (_since(log, as_of, "30 days").where(F.col("view_name") == V.ALL_VIEWS)
             .groupBy(as_date(F.col(RAN_AT)).alias("date"))
             .agg(_runs().alias("total_runs"), _status_count(V.SUCCESS).alias("successful_runs")))
    return (daily.withColumn("success_rate_percent", percent(F.col("successful_runs"), F.col("total_runs")))
            .orderBy(F.desc("date")))


def _export_totals() -> list[Column]:
    return [_runs().alias("total_exports"),
            F.sum("rows_affected").alias("total_rows_exported"),
            F.sum("files_created").alias("total_files_created"),
            F.max(RAN_AT).alias("last_export_date"),
            six_places(F.avg(DURATION)).alias("avg_duration_seconds"),
            _status_count(V.SUCCESS).alias("successful_exports"),
            _status_count(V.ERROR).alias("failed_exports")]


def _exports(log: DataFrame) -> DataFrame:
    return log.where(F.col("export_destination") == V.EXPORT_DESTINATION)


def export_stats_by_tenant(log: DataFrame, tenants: DataFrame) -> DataFrame:
    """Totals per tenant. The log is folded to one row per tenant before names are joined."""
    totals = _exports(log).where(F.col("tenant_id").isNotNull()).groupBy("tenant_id").agg(*_export_totals())
    return (totals.join(_name_frame(tenants), "tenant_id", "left")
            .select("tenant_id", "tenant_name", *[c for c in totals.columns if c != "tenant_id"])
            .orderBy(F.desc_nulls_first("total_rows_exported"), "tenant_id"))


def export_stats_by_format(log: DataFrame, tenants: DataFrame) -> DataFrame:
    """Totals per tenant and file format; rows without a tenant form their own group."""
    totals = _exports(log).groupBy("tenant_id", "file_format").agg(*_export_totals())
    rest = [c for c in totals.columns if c not in ("tenant_id", "file_format")]
    return (totals.join(_name_frame(tenants), "tenant_id", "left")
            .select("tenant_id", "tenant_name", "file_format", *rest)
            .orderBy(F.asc_nulls_last("tenant_name"), F.asc_nulls_last("file_format"), "tenant_id"))


def compaction_history(log: DataFrame, tenants: DataFrame) -> DataFrame:
    runs = log.where(F.col("export_type") == V.COMPACTION)
    return (_named_rows(runs, tenants)
            .select("refresh_timestamp", "tenant_id", "tenant_name", "rows_affected", "files_created", "files_deleted",
                    "duplicates_removed", "duration_seconds", "status", "error_message")
            .orderBy(F.desc("refresh_timestamp")))


def recent_exports(log: DataFrame, tenants: DataFrame, as_of: Clock) -> DataFrame:
    return (_named_rows(_exports(_since(log, as_of, "24 hours")), tenants)
            .select("refresh_timestamp", "tenant_id", "tenant_name", "view_name", "export_type", "rows_affected",
                    "files_created", "duration_seconds", "status", "file_path")
            .orderBy(F.desc("refresh_timestamp")))


def export_failures(log: DataFrame, tenants: DataFrame, as_of: Clock) -> DataFrame:
    failures = _exports(_since(log, as_of, "7 days")).where(F.col("status") == V.ERROR)
    return (_named_rows(failures, tenants)
            .select("refresh_timestamp", "tenant_id", "tenant_name", "view_name", "export_type", "error_message",
                    "job_id", "task_id")
            .orderBy(F.desc("refresh_timestamp")))


def daily_export_summary(log: DataFrame, as_of: Clock) -> DataFrame:
    return (_exports(_since(log, as_of, "30 days")).groupBy(as_date(F.col(RAN_AT)).alias("export_date"))
            .agg(_runs().alias("total_exports"),
                 F.sum("rows_affected").alias("total_rows"),
                 F.sum("files_created").alias("total_files"),
                 F.count_distinct("tenant_id").alias("tenants_exported"),
                 six_places(F.avg(DURATION)).alias("avg_duration_seconds"))
            .orderBy(F.desc("export_date")))


def weekly_compaction_stats(log: DataFrame, as_of: Clock) -> DataFrame:
    runs = _since(log, as_of, "7 days").where(F.col("export_type") == V.COMPACTION)
    return (runs.groupBy(as_date(F.col(RAN_AT)).alias("compaction_date"))
            .agg(F.count_distinct("tenant_id").alias("tenants_compacted"),
                 F.sum("files_deleted").alias("total_files_removed"),
                 F.sum("duplicates_removed").alias("total_duplicates_removed"),
                 F.sum("rows_affected").alias("total_rows_processed"))
            .orderBy(F.desc("compaction_date")))


def recent_runs(log: DataFrame, as_of: Clock, top: int = 20) -> DataFrame:
    """Newest runs of the last day; the log id settles equal timestamps."""
    return (_since(log, as_of, "24 hours")
            .orderBy(F.desc("refresh_timestamp"), F.desc("id")).limit(top)
            .select("view_name", "refresh_timestamp", "status", "rows_affected", "duration_seconds", "job_id"))


def run_status_stats(log: DataFrame, as_of: Clock) -> DataFrame:
    return (_since(log, as_of, "24 hours").groupBy("view_name", "status")
            .agg(_runs().alias("executions"), six_places(F.avg(DURATION)).alias("avg_duration_sec"),
                 F.max(DURATION).alias("max_duration_sec"))
            .orderBy("view_name", "status"))


def runs_last_minutes(log: DataFrame, as_of: Clock, span: str = "5 minutes") -> DataFrame:
    return (_since(log, as_of, span)
            .select("view_name", "status", "rows_affected", "duration_seconds", "refresh_timestamp")
            .orderBy(F.desc("refresh_timestamp")))


def activity_report(log: DataFrame, tickets: DataFrame, as_of_log: Clock, as_of_tickets: Clock) -> DataFrame:
    """Completed refreshes and single runs of the last 30 days, and tickets open or finished within a day."""
    recent = _since(log, as_of_log, "30 days")
    counted = recent.agg(F.count_if(F.col("view_name") == V.ALL_VIEWS).alias("refreshes_30_days"),
                         _runs().alias("runs_30_days"))
    from_log = counted.unpivot([], ["refreshes_30_days", "runs_30_days"], "measure", "total")
    live = tickets.where(F.col("finish_time").isNull() | (F.col("finish_time") >= ago(as_of_tickets, "1 day")))
    from_tickets = live.agg(_runs().alias("total")).select(F.lit("open_or_recent_tickets").alias("measure"), "total")
    return from_log.unionByName(from_tickets)
