"""Time arithmetic. Every relative window takes an explicit clock, never the wall clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Clock = str | date | datetime | Column

DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def clock(at: Clock) -> Column:
    """A zone-less timestamp for a literal moment; columns pass through."""
    if isinstance(at, Column):
        return at
    text = at.isoformat(sep=" ") if isinstance(at, datetime) else str(at)
    return F.lit(text).cast("timestamp_ntz")


def ago(at: Clock, span: str) -> Column:
    """The moment ``span`` (such as '7 days') before ``at``."""
    amount, unit = span.split()
    return clock(at) - F.expr(f"INTERVAL '{int(amount)}' {unit.rstrip('s').upper()}")


def minutes_between(start: Column, end: Column) -> Column:
    """Signed, fractional minutes."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3_600_000_000.0)


def add_minutes(moment: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, moment)


def day_of_week(moment: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(moment) - F.lit(1)


def padded_name(moment: Column, pattern: str) -> Column:
    """English day (``EEEE``) or month (``MMMM``) name, blank-padded to nine characters; looked up by number, as formatting a row takes far longer."""
    names, number = {"EEEE": (DAYS, F.weekday(moment)), "MMMM": (MONTHS, F.month(moment) - F.lit(1))}[pattern]
    return F.get(F.array(*[F.lit(name.ljust(9)) for name in names]), number)


def as_date(moment: Column) -> Column:
    return moment.cast("date")
