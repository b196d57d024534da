"""The stored tables and monitoring views under their usual SQL names, for users of ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from desklake.functions.clock import Clock
from desklake.operators import settings as options
from desklake.operators import watermark
from desklake.plans import runlog


def register_views(tenants: DataFrame, tickets: DataFrame, flat: DataFrame, log: DataFrame, marks: DataFrame,
                   settings: DataFrame, as_of: Clock) -> list[str]:
    """Temporary views over lazily evaluated frames; returns their names."""
    views = {
        "tenants": tenants,
        "tickets": tickets,
        "bi_tickets_flat": flat,
        "bi_refresh_log": log,
        "export_watermark": marks,
        "tenant_export_settings": settings,
        "vw_export_watermark_status": watermark.watermark_status(marks, tenants, tickets, as_of),
        "vw_export_stats_by_tenant": runlog.export_stats_by_format(log, tenants),
        "vw_compaction_history": runlog.compaction_history(log, tenants),
        "vw_recent_exports": runlog.recent_exports(log, tenants, as_of),
        "vw_export_failures": runlog.export_failures(log, tenants, as_of),
        "vw_tenants_csv_enabled": options.csv_enabled_tenants(settings, tenants),
        "vw_export_formats_summary": options.formats_summary(tenants, settings),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)
