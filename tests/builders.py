"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from desklake import schemas
from desklake.operators.flat import tickets_flat

T0 = datetime(2026, 1, 4, 10, 0, 0)  # a Sunday
MINUTE = timedelta(minutes=1)


def ticket(id, tenant="a", coverage=60, created=T0, finish=None, status="Active", requester=1, title="t"):
    return (id, tenant, title, coverage, "agent", created, finish, status, requester)


def tickets(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TICKETS)


def users(spark, *rows):
    return spark.createDataFrame(list(rows) or [(1, "Ana")], schemas.USERS)


def tenants(spark, **names):
    return spark.createDataFrame(list(names.items()), schemas.TENANTS)


def flat(spark, *rows, as_of=T0 + 60 * MINUTE, people=None):
    return tickets_flat(tickets(spark, *rows), people if people is not None else users(spark), as_of)


def marks(spark, **created):
    rows = [(t, c, c, 1, "INCREMENTAL", None, None, None) for t, c in created.items()]
    return spark.createDataFrame(rows, schemas.WATERMARK)


def settings(spark, *rows):
    """Rows of tenant, formats and optional further columns by name."""
    complete = []
    for tenant, formats, extra in rows:
        values = {"tenant_id": tenant, "export_formats": formats, "csv_delimiter": ",", "csv_encoding": "utf-8",
                  "csv_quoting": "minimal", "csv_date_format": "%Y-%m-%d %H:%M:%S", "parquet_compression": "snappy",
                  "parquet_engine": "pyarrow", "active": True, **extra}
        complete.append(tuple(values.get(name) for name in schemas.SETTINGS.names))
    return spark.createDataFrame(complete, schemas.SETTINGS)


def rows_by(frame, key, *columns):
    return {row[key]: tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in frame.collect()}
