"""Joins of large row sets with one-row-per-tenant frames.

Tenants are few keys with very uneven weight, so shuffling the large side by tenant would put
whole tenants into single tasks. The small side is broadcast when its row count proves it small;
beyond that bound both sides are salted, which keeps any tenant spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 64
TENANT_TASKS = 16  # tasks over kept frames of a row per tenant, which later jobs read again and again


def is_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``rows`` rows; reads no more than it needs to decide."""
    return frame.select(F.lit(1)).limit(rows + 1).count() <= rows


def join_per_tenant(facts: DataFrame, per_tenant: DataFrame, key: str = "tenant_id", how: str = "left",
                    bound: DataFrame | None = None, small: bool | None = None, spread_by: str = "id",
                    max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``facts`` with a frame that has at most one row per ``key``.

    The size check counts ``per_tenant``, or ``bound``, a frame known to hold all its keys that is cheaper
    to count (the tenants table). ``small`` passes on the result of a check already made.
    """
    if small is None:
        small = is_small(per_tenant if bound is None else bound, max_rows)
    if small:
        return facts.join(F.broadcast(per_tenant), key, how)
    return salted_join(facts, per_tenant, key, how, spread_by)


def salted_join(facts: DataFrame, per_key: DataFrame, key: str, how: str, spread_by: str,
                salts: int = SALTS) -> DataFrame:
    """Equi-join with each key of ``facts`` spread over ``salts`` tasks and ``per_key`` repeated as often."""
    spread = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")
