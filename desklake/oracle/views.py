"""DuckDB text of the help-desk views, and the helper that puts the needed ones before a query."""

from __future__ import annotations

VIEWS = {
    "tenants": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "users": "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 20 <> 0",
    "tickets": """
        SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS VARCHAR) AS tenant_id, o.o_orderpriority AS title,
               o.o_custkey AS requester_id, 'agent_' || CAST(o.o_orderkey % 17 AS VARCHAR) AS assignee_name,
               CASE o.o_orderpriority WHEN '1-URGENT' THEN 14400 WHEN '2-HIGH' THEN 43200 WHEN '3-MEDIUM' THEN 86400
                    WHEN '4-NOT SPECIFIED' THEN 0 END AS coverage_time,
               CASE o.o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Pending' END AS status,
               o.o_orderdate + INTERVAL '1' MINUTE * CAST(o.o_orderkey % 1440 AS INT) AS created_at,
               CASE WHEN o.o_orderstatus <> 'O' THEN o.o_orderdate
                    + INTERVAL '1' MINUTE * CAST(o.o_orderkey % 1440 + l.q * 240 AS INT) END AS finish_time
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey""",
    "runlog": """
        SELECT event_id AS id, ts AS refresh_timestamp,
               CASE event_id % 4 WHEN 0 THEN 'bi_tickets_flat' WHEN 1 THEN 'ALL_VIEWS'
                    WHEN 2 THEN 'export_tickets' ELSE 'lake_compaction' END AS view_name,
               CASE WHEN event_type <> 'error' THEN 'SUCCESS' WHEN event_id % 4 < 2 THEN 'FAILED' ELSE 'ERROR' END AS status,
               CAST(event_id % 1000 AS BIGINT) AS rows_affected, value AS duration_seconds,
               CASE WHEN event_type = 'error' THEN 'boom ' || CAST(event_id % 7 AS VARCHAR) END AS error_message,
               'job_' || CAST(event_id % 4 AS VARCHAR) AS job_id, 'task_' || CAST(event_id % 3 AS VARCHAR) AS task_id,
               CASE WHEN event_id % 4 >= 2 THEN CAST(user_id % 30 AS VARCHAR) END AS tenant_id,
               CASE WHEN event_id % 4 = 3 THEN 'COMPACTION' WHEN event_id % 8 = 2 THEN 'FULL'
                    WHEN event_id % 4 = 2 THEN 'INCREMENTAL' END AS export_type,
               CASE WHEN event_id % 3 = 0 THEN 'csv' ELSE 'parquet' END AS file_format,
               CAST(1 AS INT) AS files_created, CAST(event_id % 5 AS INT) AS files_deleted,
               CAST(event_id % 11 AS BIGINT) AS duplicates_removed,
               CASE WHEN event_id % 4 = 2 THEN 'AZURE_DATALAKE' END AS export_destination,
               'lake/' || CAST(event_id AS VARCHAR) AS file_path
        FROM events""",
    "marks": """
        SELECT tenant_id, MAX(created_at) AS last_exported_created_at,
               TIMESTAMP '2001-08-01 00:00:00' + INTERVAL '1' HOUR * CAST(tenant_id AS INT) AS last_export_success_at,
               COUNT(*) AS rows_exported, 'INCREMENTAL' AS export_type, CAST(NULL AS VARCHAR) AS notes
        FROM tickets WHERE created_at < TIMESTAMP '2001-01-01 00:00:00' AND CAST(tenant_id AS INT) % 5 <> 0
        GROUP BY tenant_id""",
    "settings": """
        SELECT CAST(n_nationkey AS VARCHAR) AS tenant_id,
               CASE n_nationkey % 5 WHEN 1 THEN ['parquet'] WHEN 2 THEN ['parquet', 'csv']
                    WHEN 3 THEN CAST([] AS VARCHAR[]) ELSE ['csv'] END AS export_formats,
               CASE WHEN n_nationkey % 2 = 0 THEN ';' ELSE ',' END AS csv_delimiter,
               CASE WHEN n_nationkey % 3 = 0 THEN 'iso-8859-1' ELSE 'utf-8' END AS csv_encoding,
               'minimal' AS csv_quoting, '%Y-%m-%d %H:%M:%S' AS csv_date_format, 'snappy' AS parquet_compression,
               CASE WHEN n_nationkey % 7 = 0 THEN CAST(NULL AS BOOLEAN) ELSE n_nationkey % 11 <> 0 END AS active
        FROM nation WHERE n_nationkey % 5 <> 0""",
    "access_log": """
        SELECT ts AS time_generated,
               CASE event_type WHEN 'click' THEN 'GetBlob' WHEN 'view' THEN 'ListBlobs' ELSE 'PutBlob' END AS operation_name,
               CASE WHEN event_type = 'error' THEN 403 ELSE 200 END AS status_code, value AS duration_ms,
               '10.0.0.' || CAST(user_id % 50 AS VARCHAR) AS caller_ip, 'OAuth' AS authentication_type,
               'https://acct.dfs.example.net/tickets-data/tenant_' || CAST(user_id % 25 AS VARCHAR) || '-ab/tickets/x.parquet' AS uri
        FROM events""",
    "inventory": """
        SELECT 'tenant_key=' || CAST(user_id % 25 AS VARCHAR) || '/format=' || CASE WHEN event_id % 3 = 0 THEN 'csv' ELSE 'parquet' END
               || '/f' || CAST(event_id AS VARCHAR) AS path,
               CAST(user_id % 25 AS VARCHAR) AS tenant_id, CAST(ts AS DATE) AS day,
               CASE WHEN event_id % 3 = 0 THEN 'csv' ELSE 'parquet' END AS format, CAST(event_id % 4096 AS BIGINT) AS size_bytes,
               ts - INTERVAL '1' DAY * CAST((event_id % 40) * 25 AS INT) AS modified_at,
               CASE WHEN event_id % 9 = 0 THEN 'superseded' END AS compaction_status
        FROM events""",
    # The wide view, measured at the fixed ticket clock.
    "measured": """
        SELECT *, date_diff('microsecond', created_at, COALESCE(finish_time, TIMESTAMP '2001-08-02')) / 60000000.0 AS duration_minutes,
               CASE WHEN due IS NULL THEN 'No SLA'
                    WHEN finish_time IS NOT NULL THEN CASE WHEN finish_time > due THEN 'SLA Breached' ELSE 'Within SLA' END
                    WHEN due < TIMESTAMP '2001-08-02' THEN 'SLA At Risk' ELSE 'On Track' END AS sla_status,
               date_diff('microsecond', due, COALESCE(finish_time, TIMESTAMP '2001-08-02')) / 60000000.0 AS sla_breach_minutes
        FROM (SELECT *, created_at + INTERVAL '1' MINUTE * NULLIF(coverage_time, 0) AS due FROM tickets)""",
    "slice": """
        SELECT t.*, CASE WHEN m.tenant_id IS NULL THEN 'FULL' ELSE 'INCREMENTAL' END AS export_type
        FROM measured t LEFT JOIN marks m ON m.tenant_id = t.tenant_id
        WHERE t.created_at > m.last_exported_created_at
           OR (m.tenant_id IS NULL AND GREATEST(t.created_at, t.finish_time) >= TIMESTAMP '2001-08-01 23:30:00')""",
    "outcomes": """
        SELECT id AS tenant_id, f AS format,
               CASE WHEN CAST(id AS INT) % 4 = 0 OR (CAST(id AS INT) % 4 = 1 AND f = 'csv') THEN 'ERROR' ELSE 'SUCCESS' END AS status
        FROM tenants CROSS JOIN (VALUES ('parquet'), ('csv')) v(f)""",
    "new_marks": """
        SELECT s.tenant_id, MAX(s.created_at) AS last_exported_created_at, COUNT(*) AS rows_exported, MAX(s.export_type) AS export_type
        FROM slice s WHERE s.tenant_id IN (SELECT tenant_id FROM outcomes WHERE status = 'SUCCESS') GROUP BY s.tenant_id""",
    # Formats per tenant: active settings with a list that is not empty, else parquet.
    "formats": """
        SELECT n.id AS tenant_id, unnest(CASE WHEN len(s.export_formats) > 0 THEN s.export_formats ELSE ['parquet'] END) AS format
        FROM tenants n LEFT JOIN settings s ON s.tenant_id = n.id AND s.active""",
    "changes": """
        SELECT id AS tenant_id, ';' AS csv_delimiter, CASE WHEN CAST(id AS INT) % 2 = 0 THEN 'latin1' ELSE 'utf-8' END AS csv_encoding
        FROM tenants WHERE CAST(id AS INT) % 3 = 0""",
}

NEEDS = {"marks": ["tickets"], "measured": ["tickets"], "slice": ["measured", "marks"], "outcomes": ["tenants"],
         "new_marks": ["slice", "outcomes"], "changes": ["tenants"], "formats": ["tenants", "settings"]}


def _closure(names: tuple[str, ...]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for needed in [*_closure(tuple(NEEDS.get(name, []))), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def over(*names: str, sql: str) -> str:
    """``sql`` with the named views, and what they need, as common table expressions."""
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in _closure(names)) + "\n" + sql
