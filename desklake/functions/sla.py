"""Service-level columns of one ticket. ``as_of`` stands for "now"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.clock import Clock, add_minutes, clock, minutes_between


def without_sla(coverage: Column) -> Column:
    return coverage.isNull() | (coverage == 0)


def deadline(coverage: Column, created: Column) -> Column:
    """Creation plus coverage minutes; NULL without an agreement."""
    return F.when(~without_sla(coverage), add_minutes(created, coverage))


def duration_minutes(created: Column, finished: Column, as_of: Clock) -> Column:
    return minutes_between(created, F.coalesce(finished, clock(as_of)))


def breach_minutes(coverage: Column, created: Column, finished: Column, as_of: Clock) -> Column:
    """Minutes past the deadline, negative while inside it."""
    return minutes_between(deadline(coverage, created), F.coalesce(finished, clock(as_of)))


def status(coverage: Column, created: Column, finished: Column, as_of: Clock) -> Column:
    """Finishing exactly at the deadline is within; an open ticket is at risk only after it."""
    due = add_minutes(created, coverage)
    closed = F.when(finished <= due, V.WITHIN_SLA).otherwise(V.SLA_BREACHED)
    still_open = F.when(clock(as_of) > due, V.SLA_AT_RISK).otherwise(V.ON_TRACK)
    return (F.when(without_sla(coverage), V.NO_SLA)
             .when(finished.isNotNull(), closed)
             .otherwise(still_open))
