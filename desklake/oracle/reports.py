"""DuckDB counterparts of the registered queries."""

from __future__ import annotations

from desklake.oracle.views import over

WEEK = "refresh_timestamp >= TIMESTAMP '2024-01-24'"
MONTH = "refresh_timestamp >= TIMESTAMP '2024-01-01'"
DAY = "refresh_timestamp >= TIMESTAMP '2024-01-30'"
EXPORTS = "export_destination = 'AZURE_DATALAKE'"
EXPORT_TOTALS = """COUNT(*) AS total_exports, CAST(SUM(rows_affected) AS BIGINT) AS total_rows_exported,
    CAST(SUM(files_created) AS BIGINT) AS total_files_created, MAX(refresh_timestamp) AS last_export_date,
    ROUND(AVG(duration_seconds), 6) AS avg_duration_seconds,
    COUNT(CASE WHEN status = 'SUCCESS' THEN 1 END) AS successful_exports,
    COUNT(CASE WHEN status = 'ERROR' THEN 1 END) AS failed_exports"""
SETTINGS_TEXT = "array_to_string(list_sort(export_formats), ',') AS export_formats"


def two_places(expression: str) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,12)), 2) AS DOUBLE)"


def share(part: str, whole: str) -> str:
    """Hundredths of a percent as quotient and remainder of whole numbers."""
    scaled, whole = f"(10000 * CAST({part} AS HUGEINT))", f"CAST({whole} AS HUGEINT)"
    return f"CAST({scaled} // ({whole}) + CASE WHEN 2 * ({scaled} % ({whole})) >= ({whole}) THEN 1 ELSE 0 END AS DOUBLE) / 100"


SHARE = share("total_tickets", "(SUM(total_tickets) OVER ())")

ORACLE_SQL = {
    # tickets
    "tickets_flat": over("measured", "users", sql="""
        SELECT m.id, m.tenant_id, m.title, m.coverage_time, m.assignee_name, m.created_at, m.finish_time,
               m.status AS ticket_status, m.duration_minutes, m.due AS sla_deadline, m.sla_status, m.sla_breach_minutes,
               u.name AS requester_name,
               CAST(year(created_at) AS INT) AS created_year, CAST(month(created_at) AS INT) AS created_month,
               CAST(day(created_at) AS INT) AS created_day, CAST(dayofweek(created_at) AS INT) AS created_day_of_week,
               CAST(hour(created_at) AS INT) AS created_hour, strftime(created_at, '%Y-%m') AS created_year_month,
               strftime(created_at, '%Y-%m-%d') AS created_date, rpad(strftime(created_at, '%A'), 9, ' ') AS created_day_name,
               rpad(strftime(created_at, '%B'), 9, ' ') AS created_month_name,
               CAST(year(finish_time) AS INT) AS finish_year, CAST(month(finish_time) AS INT) AS finish_month,
               strftime(finish_time, '%Y-%m-%d') AS finish_date
        FROM measured m LEFT JOIN users u ON u.id = m.requester_id"""),
    "flat_row_count": over("tickets", sql="SELECT 'bi_tickets_flat' AS view_name, COUNT(*) AS total_rows FROM tickets"),
    "tickets_by_status": over("tickets", sql=f"""
        SELECT ticket_status, total_tickets, {SHARE} AS percentage
        FROM (SELECT status AS ticket_status, COUNT(*) AS total_tickets FROM tickets GROUP BY 1)"""),
    "active_by_sla": over("measured", sql=f"""
        SELECT sla_status, total_tickets, {SHARE} AS percentage, {two_places("mean")} AS avg_duration_minutes
        FROM (SELECT sla_status, COUNT(*) AS total_tickets, AVG(duration_minutes) AS mean
              FROM measured WHERE status = 'Active' GROUP BY 1)"""),
    "top_requesters": over("measured", "users", sql=f"""
        SELECT u.name AS requester_name, COUNT(*) AS active_tickets, {two_places("AVG(duration_minutes)")} AS avg_duration_minutes,
               COUNT(*) FILTER (sla_status IN ('SLA Breached', 'SLA At Risk')) AS sla_violations
        FROM measured m LEFT JOIN users u ON u.id = m.requester_id WHERE m.status = 'Active'
        GROUP BY 1 ORDER BY active_tickets DESC, requester_name ASC NULLS LAST LIMIT 10"""),
    "tickets_per_tenant": over("tickets", "tenants", sql="""
        SELECT t.tenant_id, n.name AS tenant_name, COUNT(*) AS tickets_exported, MAX(t.created_at) AS last_change
        FROM tickets t LEFT JOIN tenants n ON n.id = t.tenant_id GROUP BY 1, 2"""),
    "tenant_search": over("tickets", "tenants", sql="""
        SELECT n.id AS tenant_id, n.name AS tenant_name, COUNT(t.id) AS ticket_count
        FROM tenants n LEFT JOIN tickets t ON t.tenant_id = n.id
        WHERE n.name ILIKE '%Nation_1%' OR n.name ILIKE '%_7%' GROUP BY 1, 2"""),
    "tenant_search_by_id": over("tickets", "tenants", sql="""
        SELECT n.id AS tenant_id, n.name AS tenant_name, COUNT(t.id) AS ticket_count
        FROM tenants n LEFT JOIN tickets t ON t.tenant_id = n.id WHERE n.id IN ('3', '14', '99') GROUP BY 1, 2"""),
    "tenant_slug": over("tenants", "users", sql=r"""
        SELECT name, left(trim(regexp_replace(regexp_replace(lower('  Empresa ' || name || ' Ção & X! -- Ltd'),
                    '[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '-'), 50) AS slug
        FROM (SELECT name FROM tenants UNION ALL SELECT name FROM users)"""),
    "partition_path": over("tickets", sql="""
        SELECT id, 'tenant_' || tenant_id || strftime(created_at,
               '/tickets/format=parquet/year=%Y/month=%m/day=%d/tickets_%Y%m%d_%H%M%S.parquet') AS path FROM tickets"""),
    # run log
    "refresh_duration_stats": over("runlog", sql=f"""
        SELECT view_name, COUNT(*) AS total_executions, ROUND(AVG(duration_seconds), 6) AS avg_duration_sec,
               MIN(duration_seconds) AS min_duration_sec, MAX(duration_seconds) AS max_duration_sec,
               ROUND(STDDEV_SAMP(duration_seconds), 6) AS stddev_duration_sec,
               COUNT(*) FILTER (status = 'SUCCESS') AS successful, COUNT(*) FILTER (status = 'FAILED') AS failed
        FROM runlog WHERE {WEEK} AND view_name <> 'ALL_VIEWS' GROUP BY 1"""),
    "growth_trend": over("runlog", sql=f"""
        SELECT CAST(refresh_timestamp AS DATE) AS date, view_name, ROUND(AVG(rows_affected), 6) AS avg_rows,
               MAX(rows_affected) AS max_rows
        FROM runlog WHERE {MONTH} AND view_name <> 'ALL_VIEWS' AND status = 'SUCCESS' GROUP BY 1, 2"""),
    "failed_runs": over("runlog", sql=f"""
        SELECT refresh_timestamp, view_name, error_message, job_id, task_id FROM runlog WHERE {WEEK} AND status = 'FAILED'"""),
    "hourly_performance": over("runlog", sql=f"""
        SELECT CAST(hour(refresh_timestamp) AS INT) AS hour_of_day, view_name, COUNT(*) AS executions,
               ROUND(AVG(duration_seconds), 6) AS avg_duration_sec
        FROM runlog WHERE {WEEK} AND view_name <> 'ALL_VIEWS' AND status = 'SUCCESS' GROUP BY 1, 2"""),
    "daily_success_rate": over("runlog", sql=f"""
        SELECT date, total_runs, successful_runs, {share("successful_runs", "total_runs")} AS success_rate_percent
        FROM (SELECT CAST(refresh_timestamp AS DATE) AS date, COUNT(*) AS total_runs,
                     COUNT(*) FILTER (status = 'SUCCESS') AS successful_runs
              FROM runlog WHERE {MONTH} AND view_name = 'ALL_VIEWS' GROUP BY 1)"""),
    "export_stats_by_tenant": over("runlog", "tenants", sql=f"""
        SELECT r.tenant_id, n.name AS tenant_name, {EXPORT_TOTALS}
        FROM runlog r LEFT JOIN tenants n ON n.id = r.tenant_id WHERE {EXPORTS} AND r.tenant_id IS NOT NULL GROUP BY 1, 2"""),
    "export_stats_by_format": over("runlog", "tenants", sql=f"""
        SELECT r.tenant_id, n.name AS tenant_name, r.file_format, {EXPORT_TOTALS}
        FROM runlog r LEFT JOIN tenants n ON n.id = r.tenant_id WHERE {EXPORTS} GROUP BY 1, 2, 3"""),
    "compaction_history": over("runlog", "tenants", sql="""
        SELECT refresh_timestamp, tenant_id, name AS tenant_name, rows_affected, files_created, files_deleted,
               duplicates_removed, duration_seconds, status, error_message
        FROM runlog r LEFT JOIN tenants n ON n.id = r.tenant_id WHERE export_type = 'COMPACTION'"""),
    "recent_exports": over("runlog", "tenants", sql=f"""
        SELECT refresh_timestamp, tenant_id, name AS tenant_name, view_name, export_type, rows_affected, files_created,
               duration_seconds, status, file_path
        FROM runlog r LEFT JOIN tenants n ON n.id = r.tenant_id WHERE {EXPORTS} AND {DAY}"""),
    "export_failures": over("runlog", "tenants", sql=f"""
        SELECT refresh_timestamp, tenant_id, name AS tenant_name, view_name, export_type, error_message, job_id, task_id
        FROM runlog r LEFT JOIN tenants n ON n.id = r.tenant_id WHERE {EXPORTS} AND {WEEK} AND status = 'ERROR'"""),
    "daily_export_summary": over("runlog", sql=f"""
        SELECT CAST(refresh_timestamp AS DATE) AS export_date, COUNT(*) AS total_exports,
               CAST(SUM(rows_affected) AS BIGINT) AS total_rows, CAST(SUM(files_created) AS BIGINT) AS total_files,
               COUNT(DISTINCT tenant_id) AS tenants_exported, ROUND(AVG(duration_seconds), 6) AS avg_duration_seconds
        FROM runlog WHERE {EXPORTS} AND {MONTH} GROUP BY 1"""),
    "weekly_compaction_stats": over("runlog", sql=f"""
        SELECT CAST(refresh_timestamp AS DATE) AS compaction_date, COUNT(DISTINCT tenant_id) AS tenants_compacted,
               CAST(SUM(files_deleted) AS BIGINT) AS total_files_removed,
               CAST(SUM(duplicates_removed) AS BIGINT) AS total_duplicates_removed,
               CAST(SUM(rows_affected) AS BIGINT) AS total_rows_processed
        FROM runlog WHERE export_type = 'COMPACTION' AND {WEEK} GROUP BY 1"""),
    "recent_runs": over("runlog", sql=f"""
        SELECT view_name, refresh_timestamp, status, rows_affected, duration_seconds, job_id
        FROM runlog WHERE {DAY} ORDER BY refresh_timestamp DESC, id DESC LIMIT 20"""),
    "run_status_stats": over("runlog", sql=f"""
        SELECT view_name, status, COUNT(*) AS executions, ROUND(AVG(duration_seconds), 6) AS avg_duration_sec,
               MAX(duration_seconds) AS max_duration_sec
        FROM runlog WHERE {DAY} GROUP BY 1, 2"""),
    "runs_last_minutes": over("runlog", sql="""
        SELECT view_name, status, rows_affected, duration_seconds, refresh_timestamp
        FROM runlog WHERE refresh_timestamp >= TIMESTAMP '2024-01-30 23:55:00'"""),
    "activity_report": over("runlog", "tickets", sql=f"""
        SELECT 'refreshes_30_days' AS measure, COUNT(*) AS total FROM runlog WHERE {MONTH} AND view_name = 'ALL_VIEWS'
        UNION ALL SELECT 'runs_30_days', COUNT(*) FROM runlog WHERE {MONTH}
        UNION ALL SELECT 'open_or_recent_tickets', COUNT(*) FROM tickets
                  WHERE COALESCE(finish_time, TIMESTAMP '2001-08-02') >= TIMESTAMP '2001-08-01'"""),
    "evolve_runlog": over("runlog", sql="""
        SELECT id, status, CAST(CAST(duration_seconds AS DECIMAL(10,2)) AS DOUBLE) AS duration_seconds, 0 AS files_created,
               0 AS files_deleted, CAST(0 AS BIGINT) AS duplicates_removed, 'parquet' AS file_format,
               CAST(NULL AS VARCHAR) AS tenant_id, CAST(NULL AS VARCHAR) AS export_type FROM runlog"""),
    "runlog_retention": over("runlog", sql="""
        SELECT view_name, COUNT(*) AS rows_kept, MIN(refresh_timestamp) AS oldest
        FROM runlog WHERE refresh_timestamp >= TIMESTAMP '2024-01-16' GROUP BY 1"""),
    "failure_streaks": over("runlog", sql="""
        , numbered AS (
            SELECT job_id, refresh_timestamp, status <> 'SUCCESS' AS failed,
                   SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY job_id ORDER BY refresh_timestamp, id) AS successes_before
            FROM runlog)
        SELECT job_id, COUNT(*) AS failures, MIN(refresh_timestamp) AS first_failure, MAX(refresh_timestamp) AS last_failure
        FROM numbered WHERE failed GROUP BY job_id, successes_before HAVING COUNT(*) >= 3"""),
    # settings
    "export_config": over("tenants", "settings", sql="""
        SELECT n.id AS tenant_id, array_to_string(list_sort(COALESCE(s.export_formats, ['parquet'])), ',') AS export_formats,
               COALESCE(csv_delimiter, ',') AS csv_delimiter, COALESCE(csv_encoding, 'utf-8') AS csv_encoding,
               COALESCE(csv_date_format, 'YYYY-MM-DD HH24:MI:SS') AS csv_date_format,
               COALESCE(parquet_compression, 'snappy') AS parquet_compression
        FROM tenants n LEFT JOIN settings s ON s.tenant_id = n.id AND s.active"""),
    "settings_bootstrap": over("tenants", "settings", sql=f"""
        SELECT tenant_id, {SETTINGS_TEXT}, csv_delimiter, csv_encoding, active, CAST(NULL AS VARCHAR) AS notes FROM settings
        UNION ALL SELECT id, 'parquet', ',', 'utf-8', true, 'default settings' FROM tenants
                  WHERE id NOT IN (SELECT tenant_id FROM settings)"""),
    "settings_enable_csv": over("changes", "settings", sql="""
        SELECT COALESCE(s.tenant_id, c.tenant_id) AS tenant_id,
               CASE WHEN s.tenant_id IS NULL THEN 'csv,parquet'
                    ELSE array_to_string(list_sort(CASE WHEN c.tenant_id IS NULL OR list_contains(export_formats, 'csv')
                         THEN export_formats ELSE list_append(export_formats, 'csv') END), ',') END AS export_formats,
               COALESCE(c.csv_delimiter, s.csv_delimiter) AS csv_delimiter, COALESCE(c.csv_encoding, s.csv_encoding) AS csv_encoding,
               CASE WHEN c.tenant_id IS NULL THEN active ELSE true END AS active,
               CASE WHEN s.tenant_id IS NULL THEN 'CSV enabled'
                    WHEN c.tenant_id IS NOT NULL THEN ' | CSV enabled at 2024-01-31 00:00:00' END AS notes
        FROM settings s FULL JOIN changes c ON c.tenant_id = s.tenant_id"""),
    "settings_enable_csv_for_all": over("tenants", "settings", sql="""
        SELECT n.id AS tenant_id,
               CASE WHEN s.export_formats = ['csv'] OR s.export_formats = CAST([] AS VARCHAR[]) THEN 'csv' ELSE 'csv,parquet' END AS export_formats,
               ',' AS csv_delimiter, 'utf-8' AS csv_encoding, true AS active,
               CASE WHEN s.tenant_id IS NULL THEN 'CSV enabled' ELSE ' | CSV enabled at 2024-01-31 00:00:00' END AS notes
        FROM tenants n LEFT JOIN settings s ON s.tenant_id = n.id"""),
    "settings_disable_csv": over("changes", "settings", sql="""
        SELECT s.tenant_id,
               array_to_string(list_sort(CASE WHEN c.tenant_id IS NULL THEN export_formats
                    ELSE list_filter(export_formats, lambda f: f <> 'csv') END), ',') AS export_formats,
               s.csv_delimiter, s.csv_encoding, active,
               CASE WHEN c.tenant_id IS NOT NULL THEN ' | CSV disabled at 2024-01-31 00:00:00' END AS notes
        FROM settings s LEFT JOIN changes c ON c.tenant_id = s.tenant_id"""),
    "settings_change_outcomes": over("changes", "settings", sql="""
        SELECT tenant_id, tenant_id IN (SELECT tenant_id FROM settings) AS done FROM changes"""),
    "csv_enabled_tenants": over("tenants", "settings", sql=f"""
        SELECT tenant_id, name AS tenant_name, {SETTINGS_TEXT}, csv_delimiter, csv_encoding, active
        FROM settings JOIN tenants ON id = tenant_id WHERE active AND list_contains(export_formats, 'csv')"""),
    "formats_summary": over("tenants", "settings", sql="""
        , kept AS (
            SELECT id, CASE WHEN export_formats IS NULL THEN 'default' WHEN len(export_formats) = 1 THEN 'single' ELSE 'multi' END AS format_strategy,
                   CASE WHEN export_formats IS NULL THEN ['parquet'] WHEN len(export_formats) = 0 THEN ['NULL'] ELSE export_formats END AS used
            FROM tenants LEFT JOIN settings ON tenant_id = id WHERE active IS NOT false)
        SELECT format_strategy, COUNT(DISTINCT id) AS tenants_count, string_agg(DISTINCT f, ',' ORDER BY f) AS formats_used
        FROM (SELECT id, format_strategy, unnest(used) AS f FROM kept) GROUP BY 1"""),
    "settings_totals": over("settings", sql="""
        SELECT COUNT(*) AS total_tenants_configured,
               COUNT(*) FILTER (list_contains(export_formats, 'csv')) AS with_csv_enabled,
               COUNT(*) FILTER (list_contains(export_formats, 'parquet')) AS with_parquet_enabled FROM settings"""),
    "tenant_formats": over("tenants", "settings", sql="""
        SELECT id AS tenant_id, name AS tenant_name, array_to_string(list_sort(COALESCE(export_formats, ['parquet'])), ',') AS formats,
               csv_delimiter, csv_encoding, active FROM tenants LEFT JOIN settings ON tenant_id = id"""),
    "tenant_detail": over("tenants", "settings", sql="""
        SELECT id AS tenant_id, name AS tenant_name, array_to_string(list_sort(COALESCE(export_formats, ['parquet'])), ',') AS formats,
               csv_delimiter, csv_encoding, csv_quoting, csv_date_format, parquet_compression, active, CAST(NULL AS VARCHAR) AS notes
        FROM tenants LEFT JOIN settings ON tenant_id = id WHERE id = '7'"""),
    "dq_settings": over("settings", sql="""
        SELECT tenant_id, 'export_formats' AS rule FROM settings WHERE CAST(tenant_id AS INT) % 4 = 0
        UNION ALL SELECT tenant_id, 'csv_delimiter' FROM settings WHERE CAST(tenant_id AS INT) % 6 = 0
        UNION ALL SELECT tenant_id, 'csv_encoding' FROM settings WHERE CAST(tenant_id AS INT) % 9 = 0
        UNION ALL SELECT tenant_id, 'parquet_compression' FROM settings WHERE CAST(tenant_id AS INT) % 8 = 0"""),
    # marks and slices
    "watermark_bootstrap": over("tenants", "marks", sql="""
        SELECT n.id AS tenant_id, COALESCE(MAX(t.created_at), TIMESTAMP '2001-07-26') AS last_exported_created_at,
               COUNT(t.id) AS rows_exported, 'FULL' AS export_type
        FROM tenants n LEFT JOIN tickets t ON t.tenant_id = n.id
        WHERE n.id NOT IN (SELECT tenant_id FROM marks) GROUP BY n.id"""),
    "watermark_bootstrap_replay": over("tenants", "marks", sql="""
        SELECT id AS tenant_id, TIMESTAMP '2001-07-26' AS last_exported_created_at, CAST(0 AS BIGINT) AS rows_exported,
               'FULL' AS export_type
        FROM tenants WHERE id NOT IN (SELECT tenant_id FROM marks)"""),
    "watermark_reset": over("marks", sql="""
        SELECT tenant_id, CASE WHEN hit THEN TIMESTAMP '2001-07-26' ELSE last_exported_created_at END AS last_exported_created_at,
               rows_exported, CASE WHEN hit THEN 'FULL' ELSE export_type END AS export_type,
               CASE WHEN hit THEN 'manual reset, forced re-export' END AS notes
        FROM (SELECT *, tenant_id IN ('4', '12') AS hit FROM marks)"""),
    "incremental_slice": over("slice", "users", sql="""
        SELECT s.id, s.tenant_id, s.created_at, s.finish_time, s.status AS ticket_status, s.sla_status, s.duration_minutes,
               u.name AS requester_name, s.export_type
        FROM slice s LEFT JOIN users u ON u.id = s.requester_id"""),
    "next_watermark": over("new_marks", sql="SELECT * FROM new_marks"),
    "export_summary": over("slice", "outcomes", sql="""
        , each AS (
            SELECT id, (SELECT COUNT(*) FROM slice s WHERE s.tenant_id = n.id) AS rows,
                   (SELECT COUNT(*) FROM outcomes o WHERE o.tenant_id = n.id AND o.status = 'SUCCESS') AS ok
            FROM tenants n)
        SELECT CAST(COALESCE(SUM(rows) FILTER (ok > 0), 0) AS BIGINT) AS rows_exported,
               COUNT(*) FILTER (rows > 0 AND ok > 0) AS tenants_exported, COUNT(*) FILTER (rows = 0) AS tenants_without_news,
               COUNT(*) FILTER (rows > 0 AND ok = 0) AS tenants_failed, COUNT(*) AS tenants_total
        FROM each"""),
    "watermark_upsert": over("new_marks", sql="""
        SELECT COALESCE(n.tenant_id, m.tenant_id) AS tenant_id,
               COALESCE(n.last_exported_created_at, m.last_exported_created_at) AS last_exported_created_at,
               CASE WHEN n.tenant_id IS NULL THEN m.last_export_success_at ELSE TIMESTAMP '2001-08-02' END AS last_export_success_at,
               COALESCE(n.rows_exported, m.rows_exported) AS rows_exported, COALESCE(n.export_type, m.export_type) AS export_type
        FROM marks m FULL JOIN new_marks n ON n.tenant_id = m.tenant_id"""),
    "watermark_latest": over("runlog", sql="""
        SELECT tenant_id, refresh_timestamp AS updated_at, id AS log_id, rows_affected AS rows_exported
        FROM runlog WHERE tenant_id IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY tenant_id ORDER BY refresh_timestamp DESC, id DESC) = 1"""),
    "missed_rows": over("marks", sql="""
        SELECT t.id, t.tenant_id, t.created_at, t.title FROM tickets t JOIN marks m ON m.tenant_id = t.tenant_id
        WHERE t.created_at <= m.last_exported_created_at AND minute(t.created_at) >= 45"""),
    "stale_tenants": over("tenants", "marks", sql="""
        SELECT id, name, last_export, date_diff('microsecond', last_export, TIMESTAMP '2001-08-02') / 3600000000.0 AS hours_since_last_export
        FROM (SELECT id, name, COALESCE(last_export_success_at, TIMESTAMP '1970-01-01') AS last_export
              FROM tenants LEFT JOIN marks ON tenant_id = id)
        WHERE last_export < TIMESTAMP '2001-08-01 22:00:00'"""),
    "tenant_reconciliation": over("tenants", "tickets", sql="""
        , folders AS (SELECT CAST(CAST(id AS INT) * 2 AS VARCHAR) AS tenant_id FROM tenants),
          counts AS (SELECT tenant_id, COUNT(*) AS n FROM tickets GROUP BY 1)
        SELECT COALESCE(f.tenant_id, c.tenant_id) AS tenant_id,
               CASE WHEN c.tenant_id IS NULL THEN 'lake_only' WHEN f.tenant_id IS NULL THEN 'source_only' ELSE 'both' END AS presence,
               COALESCE(n, 0) AS tickets
        FROM folders f FULL JOIN counts c ON c.tenant_id = f.tenant_id"""),
    "export_full": over("tickets", sql="""
        SELECT tenant_id, 'FULL' AS export_type, COUNT(*) AS rows, MAX(created_at) AS newest
        FROM tickets GROUP BY 1"""),
    # files
    "compaction_candidates": over("inventory", sql="""
        SELECT tenant_id, format, day, COUNT(*) AS files, CAST(SUM(size_bytes) AS BIGINT) AS total_bytes,
               CASE WHEN COUNT(*) = 1 THEN 'single_file' END AS skip_reason, COUNT(*) > 1 AS compact
        FROM inventory GROUP BY 1, 2, 3"""),
    "lifecycle_plan": over("inventory", sql="""
        SELECT path, day, modified_at,
               CASE WHEN modified_at < TIMESTAMP '2024-01-31' - INTERVAL 730 DAY THEN 'delete'
                    WHEN compaction_status = 'superseded' AND modified_at < TIMESTAMP '2024-01-24' THEN 'delete'
                    WHEN modified_at < TIMESTAMP '2024-01-31' - INTERVAL 90 DAY THEN 'archive'
                    WHEN modified_at < TIMESTAMP '2024-01-01' THEN 'cool' ELSE 'hot' END AS tier
        FROM inventory"""),
    "lifecycle_totals": over("inventory", sql="""
        SELECT CASE WHEN days > 730 OR (compaction_status = 'superseded' AND days > 7) THEN 'delete'
                    WHEN days > 90 THEN 'archive' WHEN days > 30 THEN 'cool' ELSE 'hot' END AS tier,
               COUNT(*) AS files, CAST(SUM(size_bytes) AS BIGINT) AS total_bytes
        FROM (SELECT *, date_diff('microsecond', modified_at, TIMESTAMP '2024-01-31') / 86400000000.0 AS days FROM inventory)
        GROUP BY 1"""),
    "file_retention": over("inventory", sql="""
        SELECT COUNT(*) AS files_before, COUNT(*) FILTER (days > 30) AS files_deleted, COUNT(*) FILTER (days <= 30) AS files_after
        FROM (SELECT floor(date_diff('microsecond', modified_at, TIMESTAMP '2024-01-31') / 86400000000.0) AS days FROM inventory)"""),
    "largest_prefixes": over("inventory", sql="""
        SELECT regexp_replace(path, '/[^/]*$', '') AS prefix, CAST(SUM(size_bytes) AS BIGINT) AS total_bytes, COUNT(*) AS files,
               CASE WHEN SUM(size_bytes) < 10240 THEN SUM(size_bytes) || ' bytes'
                    WHEN CAST(floor(SUM(size_bytes) / 1024.0 + 0.5) AS BIGINT) < 10240
                         THEN CAST(floor(SUM(size_bytes) / 1024.0 + 0.5) AS BIGINT) || ' kB'
                    ELSE CAST(floor(SUM(size_bytes) / 1048576.0 + 0.5) AS BIGINT) || ' MB' END AS size_text
        FROM inventory GROUP BY 1 ORDER BY total_bytes DESC, prefix LIMIT 10"""),
    "growth_alerts": over("inventory", sql="""
        , daily AS (SELECT day, SUM(size_bytes) AS b FROM inventory GROUP BY 1),
          stored AS (SELECT day, SUM(b) OVER (ORDER BY day) AS stored_bytes FROM daily)
        SELECT t.day, CAST(t.stored_bytes AS BIGINT) AS stored_bytes, CAST(y.stored_bytes AS BIGINT) AS previous_bytes,
               ROUND((t.stored_bytes - y.stored_bytes) / CAST(y.stored_bytes AS DOUBLE), 6) AS growth
        FROM stored t JOIN stored y ON y.day = t.day - 1 WHERE t.stored_bytes > 1.5 * y.stored_bytes"""),
    # access log
    "access_per_hour": over("access_log", sql="""
        SELECT caller_ip, date_trunc('hour', time_generated) AS hour, COUNT(*) AS access_count
        FROM access_log WHERE operation_name IN ('GetBlob', 'ListBlobs') GROUP BY 1, 2"""),
    "access_quality": over("access_log", sql="""
        SELECT date_trunc('hour', time_generated) AS hour, operation_name, caller_ip, COUNT(*) AS total_requests,
               ROUND(COUNT(*) FILTER (status_code < 400) * 100.0 / COUNT(*), 6) AS success_rate,
               ROUND(AVG(duration_ms), 6) AS avg_latency
        FROM access_log WHERE time_generated >= TIMESTAMP '2024-01-30' GROUP BY 1, 2, 3"""),
    "access_by_tenant": over("access_log", sql=r"""
        SELECT caller_ip, authentication_type, regexp_extract(uri, 'tenant_([a-f0-9\-]+)', 1) AS tenant_folder,
               date_trunc('hour', time_generated) AS hour, COUNT(*) AS access_count, MAX(time_generated) AS last_access
        FROM access_log WHERE operation_name IN ('GetBlob', 'ListBlobs') AND time_generated >= TIMESTAMP '2024-01-24'
        GROUP BY 1, 2, 3, 4"""),
    "access_alerts": over("access_log", sql="""
        , hourly AS (
            SELECT caller_ip, date_trunc('hour', time_generated) AS hour, COUNT(*) AS requests,
                   COUNT(*) FILTER (status_code = 403) AS denied FROM access_log GROUP BY 1, 2)
        SELECT *, denied > 0 AS any_denied, requests > 10 * (SELECT AVG(requests) FROM hourly) AS high_volume
        FROM hourly WHERE denied > 0 OR requests > 10 * (SELECT AVG(requests) FROM hourly)"""),
    # data quality
    "dq_duplicate_ids": over("tickets", "runlog", sql="""
        SELECT t.id, CAST(2 AS BIGINT) AS copies FROM tickets t JOIN runlog r ON r.id = t.id"""),
    "dq_keys": over("users", "tenants", "runlog", "marks", sql="\n        UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({key}) AS null_keys, "
        f"COUNT({key}) - COUNT(DISTINCT {key}) AS repeated_keys FROM {view}"
        for name, view, key in [("tickets", "tickets", "id"), ("users", "users", "id"), ("tenants", "tenants", "id"),
                                ("runlog_by_tenant", "runlog", "tenant_id"), ("marks", "marks", "tenant_id")])),
    "dq_orphans": over("tenants", "runlog", "tickets", "settings", sql="\n        UNION ALL ".join(
        f"SELECT '{view}' AS table_name, tenant_id, COUNT(*) AS orphan_rows FROM {view} "
        f"WHERE tenant_id NOT IN (SELECT id FROM tenants) GROUP BY tenant_id" for view in ("runlog", "tickets", "settings"))),
}

_STATUS = """
    SELECT m.tenant_id, n.name AS tenant_name, m.last_exported_created_at, m.last_export_success_at, m.rows_exported,
           m.export_type, date_diff('microsecond', m.last_export_success_at, TIMESTAMP '2001-08-02') / 3600000000.0 AS hours_since_last_export,
           (SELECT COUNT(*) FROM tickets t WHERE t.tenant_id = m.tenant_id AND t.created_at > m.last_exported_created_at) AS pending_tickets,
           m.notes
    FROM marks m JOIN tenants n ON n.id = m.tenant_id"""
ORACLE_SQL["watermark_status"] = over("marks", "tenants", sql=_STATUS)
ORACLE_SQL["lagging_exports"] = over("marks", "tenants", sql=f"SELECT * FROM ({_STATUS}) WHERE hours_since_last_export > 6")

# --- the stored lake ----------------------------------------------------------------------------

_LAKE_ROWS = """
    SELECT s.id, s.tenant_id AS tenant_key, s.created_at, s.finish_time, s.duration_minutes, s.sla_status, u.name AS requester_name,
           rpad(strftime(s.created_at, '%A'), 9, ' ') AS created_day_name, f.format, '2001' AS year, '08' AS month, '02' AS day,
           '20010802_000000' AS run
    FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id LEFT JOIN users u ON u.id = s.requester_id"""
_EXPORTED = """
    SELECT s.tenant_id, f.format AS file_format, 'SUCCESS' AS status, COUNT(*) AS rows_affected, MAX(s.export_type) AS export_type,
           MAX(s.created_at) AS last_exported_created_at
    FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id GROUP BY 1, 2"""

_DATE_FORMATS = ["%Y-%m-%d %H:%M:%S", "%d/%m/%y", "%b %d, %Y %I:%M %p", "%B (%j) %Y", "%Y%m%dT%H%M%S.%f", "on %d at %H h", "100%% %Y", "%d.%m.%Y"]
_TWO_MONTHS = """
        , kept AS (
            SELECT tenant_id, 'parquet' AS format, day FROM (SELECT DISTINCT tenant_id FROM tickets),
                   (VALUES (DATE '2001-06-02'), (DATE '2001-07-02'), (DATE '2001-08-02')) x(day)
            UNION ALL SELECT DISTINCT s.tenant_id, f.format, DATE '2001-08-02' FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id)"""

ORACLE_SQL.update({
    "dq_isolation": over("tickets", sql="""
        SELECT '0' AS tenant_key, tenant_id, COUNT(*) AS foreign_rows FROM tickets WHERE id % 97 = 0 AND tenant_id <> '0' GROUP BY 2"""),
    "dedup_stats": over("tickets", sql="""
        SELECT tenant_id, 2 * COUNT(*) AS rows_before, 2 * COUNT(*) - COUNT(*) FILTER (hour(created_at) = 13) AS rows_after,
               COUNT(*) FILTER (hour(created_at) = 13) AS duplicates_removed FROM tickets GROUP BY 1"""),
    "compaction_summary": over("runlog", sql="""
        , each AS (
            SELECT tenant_id, MAX(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS done,
                   COALESCE(SUM(files_deleted) FILTER (status = 'SUCCESS'), 0) AS fb,
                   COALESCE(SUM(files_created) FILTER (status = 'SUCCESS'), 0) AS fa,
                   COALESCE(SUM(duplicates_removed) FILTER (status = 'SUCCESS'), 0) AS dr
            FROM runlog WHERE export_type = 'COMPACTION' AND tenant_id IS NOT NULL GROUP BY 1)
        SELECT COUNT(*) AS tenants_total, CAST(SUM(done) AS BIGINT) AS tenants_compacted,
               CAST(COUNT(*) - SUM(done) AS BIGINT) AS tenants_skipped, CAST(SUM(fb) AS BIGINT) AS files_before,
               CAST(SUM(fa) AS BIGINT) AS files_after, CAST(SUM(dr) AS BIGINT) AS duplicates_removed,
               ROUND(CAST((SUM(fb) - SUM(fa)) * 100.0 / SUM(fb) AS DOUBLE), 6) AS files_saved_percent FROM each"""),
    "drop_orphans": over("runlog", "tenants", sql="""
        SELECT tenant_id, COUNT(*) AS rows, MAX(refresh_timestamp) AS newest
        FROM runlog WHERE tenant_id IN (SELECT id FROM tenants) GROUP BY 1"""),
    "refresh_flat": ORACLE_SQL["tickets_flat"],
    "refresh_months": over("tickets", "users", sql="""
        , t AS (SELECT *, date_trunc('month', created_at) AS month, created_at >= TIMESTAMP '2001-05-01' AND finish_time IS NULL AS open
                FROM tickets)
        SELECT v.*, (SELECT COUNT(*) FROM t WHERE month = DATE '1996-03-01') AS retitled_rows,
               (SELECT COUNT(*) FROM t JOIN users u ON u.id = t.requester_id WHERE u.id = 2) AS renamed_rows
        FROM (
            SELECT CAST(1 AS BIGINT) AS version, COUNT(DISTINCT month) AS months, COUNT(DISTINCT month) AS months_rewritten, COUNT(*) AS total_rows
            FROM t WHERE created_at < TIMESTAMP '2001-06-01'
            UNION ALL
            SELECT 2, COUNT(DISTINCT month), COUNT(DISTINCT month) FILTER (WHERE open OR created_at >= TIMESTAMP '2001-06-01'), COUNT(*) FROM t
            UNION ALL
            SELECT 3, COUNT(DISTINCT month), COUNT(DISTINCT month) FILTER (WHERE open OR month = DATE '1996-03-01'
                   OR (requester_id = 2 AND EXISTS (SELECT 1 FROM users WHERE id = 2))), COUNT(*) FROM t) v
        WHERE v.total_rows > 0"""),
    "read_flat": over("measured", "users", sql="""
        SELECT m.tenant_id, m.id, m.created_at, m.sla_status, u.name AS requester_name
        FROM measured m LEFT JOIN users u ON u.id = m.requester_id"""),
    "lake_tenants": over("tenants", sql="SELECT id AS tenant_id FROM tenants"),
    "lake_combine": over("slice", "formats", sql="""
        SELECT t.tenant_id,
               COUNT(*) + (SELECT COUNT(*) FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id
                           WHERE f.format = 'parquet' AND s.tenant_id = t.tenant_id) AS rows, COUNT(*) AS ids
        FROM tickets t GROUP BY t.tenant_id"""),
    "export_replay": over("slice", "tenants", sql="""
        SELECT n.id AS tenant_id, CASE WHEN COUNT(s.id) > 0 THEN 'SUCCESS' ELSE 'ERROR' END AS status, COUNT(s.id) AS rows_affected,
               COUNT(s.id) AS stored_rows, MAX(s.created_at) AS newest
        FROM tenants n LEFT JOIN slice s ON s.tenant_id = n.id WHERE CAST(n.id AS INT) % 5 = 1 GROUP BY 1"""),
    "snapshot_stats": over("tickets", sql="""
        SELECT 'bi_tickets_flat' AS view_name, COUNT(*) AS total_rows, COUNT(*) > 0 AS is_populated, true AS has_files, true AS sized
        FROM tickets"""),
    "settings_stamps": over("settings", "tenants", sql="""
        SELECT n.id AS tenant_id, 'desklake' AS updated_by, TIMESTAMP '2024-01-31' AS updated_at
        FROM tenants n WHERE CAST(n.id AS INT) % 3 = 0"""),
    "lake_combine_first": over("slice", "formats", sql="""
        SELECT s.tenant_id, COUNT(*) AS rows FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id AND f.format = 'parquet'
        GROUP BY 1 ORDER BY s.tenant_id || '/' LIMIT 1"""),
    "csv_date_formats": over("tickets", sql=" UNION ALL ".join(
        f"SELECT id, '{text}' AS date_format, strftime(created_at, '{text}') AS shown FROM tickets WHERE id % 8 = {number}"
        for number, text in enumerate(_DATE_FORMATS))),
    "export_run": over("slice", "formats", sql=f"""
        SELECT *, 1 AS files_created FROM ({_EXPORTED})"""),
    "logged_files": over("slice", "formats", sql=f"""
        SELECT tenant_id, file_format, CAST(1 AS BIGINT) AS files, true AS same_count, true AS same_folder FROM ({_EXPORTED})"""),
    "stored_candidates": over("slice", "formats", sql=f"""{_TWO_MONTHS}
        SELECT tenant_id, format, day, COUNT(*) AS files, CASE WHEN COUNT(*) = 1 THEN 'single_file' END AS skip_reason, COUNT(*) > 1 AS compact
        FROM kept GROUP BY 1, 2, 3"""),
    "stored_lifecycle_plan": over("slice", "formats", sql=f"""{_TWO_MONTHS}
        SELECT tenant_id, format, day, CAST(CASE WHEN merged THEN 1 ELSE COUNT(*) END AS BIGINT) AS files,
               CASE WHEN day = DATE '2001-06-02' THEN 'archive' WHEN merged THEN 'hot' ELSE 'cool' END AS tier
        FROM (SELECT k.*, day = DATE '2001-08-02' AND k.format = 'parquet' AND EXISTS (
                  SELECT 1 FROM slice s JOIN formats f ON f.tenant_id = s.tenant_id
                  WHERE s.tenant_id = k.tenant_id AND f.format = 'parquet') AS merged FROM kept k)
        GROUP BY tenant_id, format, day, merged"""),
    "stored_file_purge": over("slice", "formats", sql=f"""{_TWO_MONTHS}
        SELECT day AS file_day, COUNT(*) AS files_left, COUNT(*) AS files_there, (SELECT COUNT(*) FROM kept) AS files_before,
               (SELECT COUNT(*) FROM kept WHERE day = DATE '2001-06-02') AS files_deleted
        FROM kept WHERE day > DATE '2001-06-02' GROUP BY 1"""),
    "compact_recovered": over("slice", "formats", sql="""
        , present AS (
            SELECT f.tenant_id, f.format, (SELECT COUNT(*) FROM slice s WHERE s.tenant_id = f.tenant_id) AS part,
                   (SELECT COUNT(*) FROM tickets t WHERE t.tenant_id = f.tenant_id) AS whole
            FROM formats f WHERE f.format = 'parquet')
        SELECT tenant_id, format AS file_format, 'SUCCESS' AS status, whole AS rows_affected, 1 AS files_created, 2 AS files_deleted,
               part AS duplicates_removed, TIMESTAMP '2001-08-03 01:00:00' AS refresh_timestamp FROM present WHERE part > 0"""),
    "lake_read_parquet": over("slice", "formats", "users", sql=f"SELECT * FROM ({_LAKE_ROWS}) WHERE format = 'parquet'"),
    "lake_read_csv": over("slice", "formats", "users", sql=f"SELECT * FROM ({_LAKE_ROWS}) WHERE format = 'csv'"),
    "watermark_after_export": over("slice", sql="""
        , fresh AS (SELECT tenant_id, MAX(created_at) AS newest, COUNT(*) AS n, MAX(export_type) AS kind FROM slice GROUP BY 1),
          again AS (
            SELECT f.tenant_id, MAX(t.created_at) AS newest, COUNT(*) AS n
            FROM fresh f JOIN tickets t ON t.tenant_id = f.tenant_id AND t.created_at > f.newest GROUP BY 1)
        SELECT COALESCE(f.tenant_id, m.tenant_id) AS tenant_id,
               COALESCE(a.newest, f.newest, m.last_exported_created_at) AS last_exported_created_at,
               COALESCE(a.n, f.n, m.rows_exported) AS rows_exported,
               CASE WHEN a.n IS NOT NULL THEN 'INCREMENTAL' ELSE COALESCE(f.kind, m.export_type) END AS export_type
        FROM marks m FULL JOIN fresh f ON f.tenant_id = m.tenant_id LEFT JOIN again a ON a.tenant_id = f.tenant_id"""),
    "runlog_append": over("slice", "formats", sql=f"""
        SELECT 'export_tickets' AS view_name, status, file_format, export_type, 1 AS files_created, COUNT(*) AS entries,
               CAST(SUM(rows_affected) AS BIGINT) AS rows_affected, COUNT(*) AS ids
        FROM ({_EXPORTED}) GROUP BY 2, 3, 4
        UNION ALL SELECT v, 'SUCCESS', 'parquet', NULL, 0, 1, (SELECT COUNT(*) FROM tickets), 1
                  FROM (VALUES ('bi_tickets_flat'), ('ALL_VIEWS')) x(v)"""),
    "lake_status_counts": over("tickets", sql="""
        SELECT status AS ticket_status, COUNT(*) AS total FROM tickets WHERE created_at >= TIMESTAMP '1998-01-01' GROUP BY 1"""),
    "compact": over("slice", "formats", sql="""
        , present AS (
            SELECT n.id AS tenant_id, f.format, (SELECT COUNT(*) FROM slice s WHERE s.tenant_id = n.id) AS part,
                   (SELECT COUNT(*) FROM tickets t WHERE t.tenant_id = n.id AND f.format = 'parquet') AS whole
            FROM tenants n JOIN formats f ON f.tenant_id = n.id)
        SELECT tenant_id, format AS file_format, CASE WHEN part > 0 AND whole > 0 THEN 'success' ELSE 'skipped' END AS status,
               CASE WHEN part = 0 AND whole = 0 THEN 'no_files' WHEN part = 0 OR whole = 0 THEN 'single_file' END AS reason,
               CASE WHEN part > 0 AND whole > 0 THEN part + whole ELSE 0 END AS rows_before,
               CASE WHEN part > 0 AND whole > 0 THEN whole ELSE 0 END AS rows_after,
               CASE WHEN part > 0 AND whole > 0 THEN part ELSE 0 END AS duplicates_removed
        FROM present"""),
    "compact_mismatch": over("slice", "formats", sql="""
        , present AS (
            SELECT n.id AS tenant_id, f.format, (SELECT COUNT(*) FROM slice s WHERE s.tenant_id = n.id) AS part,
                   (SELECT COUNT(*) FROM tickets t WHERE t.tenant_id = n.id AND f.format = 'parquet') AS whole
            FROM tenants n JOIN formats f ON f.tenant_id = n.id)
        SELECT tenant_id, format AS file_format, whole AS rows_expected, CASE WHEN tenant_id IN ('6', '12') THEN 0 ELSE whole END AS rows_staged,
               tenant_id NOT IN ('6', '12') AS matches
        FROM present WHERE part > 0 AND whole > 0"""),
    "lake_read_dialects": over("measured", "users", sql="""
        SELECT m.id, m.tenant_id, CASE (CAST(m.tenant_id AS INT) % 12) // 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'utf-8-sig'
                    WHEN 2 THEN 'latin1' ELSE 'iso-8859-1' END AS encoding,
               CASE CAST(m.tenant_id AS INT) % 3 WHEN 0 THEN 'minimal' WHEN 1 THEN 'all' ELSE 'nonnumeric' END AS quoting,
               CASE WHEN m.id % 7 <> 0 THEN md5(m.title || ' "ã" ;,|' || chr(9) || chr(13) || chr(10) || CAST(m.id AS VARCHAR)) END AS title_md5,
               m.created_at, m.finish_time, m.duration_minutes, u.name AS requester_name
        FROM measured m LEFT JOIN users u ON u.id = m.requester_id"""),
    "lake_after_compaction": over("tickets", "formats", sql="""
        SELECT t.tenant_id AS tenant_key,
               COUNT(*) * CASE WHEN f.tenant_id IS NULL THEN 2 ELSE 1 END AS rows, COUNT(*) AS ids,
               CAST(CASE WHEN f.tenant_id IS NULL THEN 2 ELSE 1 END AS BIGINT) AS runs, MAX(t.created_at) AS newest
        FROM tickets t LEFT JOIN formats f ON f.tenant_id = t.tenant_id AND f.format = 'parquet' GROUP BY t.tenant_id, f.tenant_id"""),
    "file_inventory": over("slice", "formats", sql=f"""
        SELECT tenant_id, file_format AS format, DATE '2001-08-02' AS file_day, CAST(1 AS BIGINT) AS folders, true AS all_filled
        FROM ({_EXPORTED})"""),
    "stream_export": over("slice", "formats", sql=f"""
        SELECT tenant_id, file_format, status, rows_affected, export_type, TIMESTAMP '2001-08-02' AS refresh_timestamp
        FROM ({_EXPORTED})"""),
})
