"""Data-quality jobs for rules that a database would enforce as constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(frame: DataFrame, key: str = "id") -> DataFrame:
    """Keys held by more than one row. Reads the key column only."""
    return (frame.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1).orderBy(key))


def key_violations(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, rows with a NULL key, and surplus rows of repeated keys."""
    def check(name: str, frame: DataFrame, key: str) -> DataFrame:
        per_key = frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        filled = F.col(key).isNotNull()
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(filled, F.col("n") - 1)), F.lit(0)).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), "total_rows", "null_keys", "repeated_keys")

    checks = [check(name, frame, key) for name, (frame, key) in tables.items()]
    return reduce(DataFrame.unionByName, checks).orderBy("table_name")


def orphan_counts(tables: dict[str, DataFrame], tenants: DataFrame) -> DataFrame:
    """Tenant ids without a tenant, with their rows. Each table is folded to one row per id before the join."""
    known = tenants.select(F.col("id").alias("tenant_id"))

    def check(name: str, frame: DataFrame) -> DataFrame:
        counts = frame.where(F.col("tenant_id").isNotNull()).groupBy("tenant_id").agg(F.count(F.lit(1)).alias("orphan_rows"))
        return counts.join(known, "tenant_id", "left_anti").select(F.lit(name).alias("table_name"), "tenant_id", "orphan_rows")

    return reduce(DataFrame.unionByName, [check(n, f) for n, f in tables.items()]).orderBy("table_name", "tenant_id")


def drop_orphans(frame: DataFrame, tenants: DataFrame) -> DataFrame:
    """Rows of existing tenants only, the effect of a cascading delete."""
    return frame.join(tenants.select(F.col("id").alias("tenant_id")), "tenant_id", "left_semi")


def isolation_breaches(lake: DataFrame) -> DataFrame:
    """Rows stored under another tenant's folder, counted per folder and owner."""
    return (lake.where(~F.col("tenant_key").eqNullSafe(F.col("tenant_id")))
            .groupBy("tenant_key", "tenant_id").agg(F.count(F.lit(1)).alias("foreign_rows"))
            .orderBy("tenant_key", "tenant_id"))
