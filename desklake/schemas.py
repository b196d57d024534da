"""Declared schemas. Timestamps carry no zone and mean UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "TIMESTAMP_NTZ": T.TimestampNTZType(), "MONEY": T.DecimalType(10, 2),
    "STRINGS": T.ArrayType(T.StringType()),
}


def _schema(listing: str) -> T.StructType:
    """A schema from "name TYPE, name TYPE"; needs no running session."""
    pairs = [item.split() for item in listing.split(",")]
    return T.StructType([T.StructField(name, _TYPES[word]) for name, word in pairs])


TICKETS = _schema("""id BIGINT, tenant_id STRING, title STRING, coverage_time INT, assignee_name STRING,
    created_at TIMESTAMP_NTZ, finish_time TIMESTAMP_NTZ, status STRING, requester_id BIGINT""")

USERS = _schema("id BIGINT, name STRING")

TENANTS = _schema("id STRING, name STRING")

FLAT = _schema("""id BIGINT, tenant_id STRING, title STRING, coverage_time INT, assignee_name STRING,
    created_at TIMESTAMP_NTZ, finish_time TIMESTAMP_NTZ, ticket_status STRING, duration_minutes DOUBLE,
    sla_deadline TIMESTAMP_NTZ, sla_status STRING, sla_breach_minutes DOUBLE, requester_name STRING,
    created_year INT, created_month INT, created_day INT, created_day_of_week INT, created_hour INT,
    created_year_month STRING, created_date STRING, created_day_name STRING, created_month_name STRING,
    finish_year INT, finish_month INT, finish_date STRING""")

# Where a lake file lies: tenant, format, the dialect it was written in, and the run that wrote it.
LAKE_PARTITIONS = ["tenant_key", "format", "dialect", "year", "month", "day", "run"]
LAKE = T.StructType(FLAT.fields + [T.StructField(name, T.StringType()) for name in LAKE_PARTITIONS])

# Which folder holds a month of the stored wide view, and what its tickets were when that was written.
MONTHS = _schema("month STRING, folder STRING, rows BIGINT, open_rows BIGINT, print STRING")

RUN_LOG = _schema("""id BIGINT, refresh_timestamp TIMESTAMP_NTZ, view_name STRING, status STRING,
    rows_affected BIGINT, duration_seconds MONEY, error_message STRING, job_id STRING, task_id STRING,
    run_ts TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, tenant_id STRING, export_type STRING, files_created INT,
    files_deleted INT, duplicates_removed BIGINT, export_destination STRING, store_account STRING,
    container STRING, file_path STRING, file_format STRING""")

WATERMARK = _schema("""tenant_id STRING, last_exported_created_at TIMESTAMP_NTZ, last_export_success_at TIMESTAMP_NTZ,
    rows_exported BIGINT, export_type STRING, notes STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""")

# What an export run took per tenant (created after ``lower``, NULL in a first export, up to ``upper``), and what became of it.
EXPORT_BOUNDS = _schema("tenant_id STRING, lower TIMESTAMP_NTZ, upper TIMESTAMP_NTZ")
EXPORT_RESULTS = _schema("""tenant_id STRING, file_format STRING, status STRING, duration_seconds DOUBLE, error_message STRING,
    rows_exported BIGINT, last_exported_created_at TIMESTAMP_NTZ, export_type STRING, rows_affected BIGINT, files_created INT, file_path STRING""")

# What the manifest says of a file: its state, which run brought it there, and when by that run's clock.
MANIFEST = _schema("""path STRING, tenant_id STRING, format STRING, dialect STRING, run STRING, size_bytes BIGINT, state STRING,
    state_by STRING, state_at TIMESTAMP_NTZ, file_day STRING, entry STRING""")

SETTINGS = _schema("""tenant_id STRING, export_formats STRINGS, csv_delimiter STRING, csv_encoding STRING,
    csv_quoting STRING, csv_date_format STRING, parquet_compression STRING, parquet_engine STRING, active BOOLEAN,
    notes STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, created_by STRING, updated_by STRING""")

# Values that rows get in columns added after they were written.
RUN_LOG_DEFAULTS = {"files_created": 0, "files_deleted": 0, "duplicates_removed": 0, "file_format": "parquet"}


def evolve(frame: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """The frame in the column order and types of ``schema``; missing columns get a default or NULL."""
    defaults = defaults or {}
    present = set(frame.columns)
    return frame.select(*[
        (F.col(f.name) if f.name in present else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def evolve_runlog(log: DataFrame) -> DataFrame:
    return evolve(log, RUN_LOG, RUN_LOG_DEFAULTS)
