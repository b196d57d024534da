"""The wide ticket view: one row per ticket, with service-level and calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake.functions import sla
from desklake.functions.clock import Clock, day_of_week, padded_name


def with_measures(tickets: DataFrame, as_of: Clock) -> DataFrame:
    """Tickets plus the four service-level columns; needs no join."""
    coverage, created, finished = F.col("coverage_time"), F.col("created_at"), F.col("finish_time")
    return tickets.withColumnRenamed("status", "ticket_status").withColumns({
        "duration_minutes": sla.duration_minutes(created, finished, as_of),
        "sla_deadline": sla.deadline(coverage, created),
        "sla_status": sla.status(coverage, created, finished, as_of),
        "sla_breach_minutes": sla.breach_minutes(coverage, created, finished, as_of),
    })


def with_requester(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """Adds requester_name and keeps tickets whose requester is NULL or unknown.

    No hint: users grow with the data. Hot or NULL requesters are split by adaptive skew handling,
    which may divide the ticket side of a left join.
    """
    names = users.select(F.col("id").alias("requester_id"), F.col("name").alias("requester_name"))
    return tickets.join(names, "requester_id", "left")


def with_calendar(tickets: DataFrame) -> DataFrame:
    created, finished = F.col("created_at"), F.col("finish_time")
    return tickets.withColumns({
        "created_year": F.year(created),
        "created_month": F.month(created),
        "created_day": F.dayofmonth(created),
        "created_day_of_week": day_of_week(created),
        "created_hour": F.hour(created),
        "created_year_month": F.date_format(created, "yyyy-MM"),
        "created_date": F.date_format(created, "yyyy-MM-dd"),
        "created_day_name": padded_name(created, "EEEE"),
        "created_month_name": padded_name(created, "MMMM"),
        "finish_year": F.year(finished),
        "finish_month": F.month(finished),
        "finish_date": F.date_format(finished, "yyyy-MM-dd"),
    })


FLAT_COLUMNS = [
    "id", "tenant_id", "title", "coverage_time", "assignee_name", "created_at", "finish_time", "ticket_status",
    "duration_minutes", "sla_deadline", "sla_status", "sla_breach_minutes", "requester_name",
    "created_year", "created_month", "created_day", "created_day_of_week", "created_hour",
    "created_year_month", "created_date", "created_day_name", "created_month_name",
    "finish_year", "finish_month", "finish_date",
]


def tickets_flat(tickets: DataFrame, users: DataFrame, as_of: Clock) -> DataFrame:
    return with_calendar(with_measures(with_requester(tickets, users), as_of)).select(*FLAT_COLUMNS)
