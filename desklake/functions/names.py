"""Text rules for tenant names and lake paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """Lower-case name with every run of other characters as one hyphen, at most 50 characters."""
    hyphenated = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return F.substring(F.btrim(hyphenated, F.lit("-")), 1, 50)


def matches_any(name: Column, needles: list[str]) -> Column:
    """Case-insensitive substring match on any needle; % and _ in a needle are wildcards."""
    lowered = F.lower(name)
    return reduce(lambda a, b: a | b, [lowered.like(f"%{needle.lower()}%") for needle in needles])


def lake_path(tenant: Column, file_format: Column, run_ts: Column, stem: str = "tickets") -> Column:
    """Logical object name of one export: tenant, format and *run* date, then the run timestamp."""
    return F.concat(
        F.lit("tenant_"), tenant, F.lit("/tickets/format="), file_format,
        F.lit("/year="), F.date_format(run_ts, "yyyy"),
        F.lit("/month="), F.date_format(run_ts, "MM"),
        F.lit("/day="), F.date_format(run_ts, "dd"),
        F.lit(f"/{stem}_"), F.date_format(run_ts, "yyyyMMdd_HHmmss"), F.lit("."), file_format)


def tenant_in_uri(uri: Column) -> Column:
    return F.regexp_extract(uri, r"tenant_([a-f0-9\-]+)", 1)
