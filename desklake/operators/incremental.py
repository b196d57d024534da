"""Which rows an export run takes, and what it leaves behind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago
from desklake.functions.names import matches_any
from desklake.operators.bands import bands
from desklake.operators.joins import join_per_tenant


def incremental_slice(flat: DataFrame, marks: DataFrame, as_of: Clock, bound: DataFrame | None = None) -> DataFrame:
    """Rows to export for all tenants at once, with their export_type.

    A tenant with a mark gives rows created after it; one without gives rows created or finished within the first-export window.
    Tenants are taken in bands by the age of their marks, each with a bound of its own at the scan, so Parquet skips the row groups
    that are older than the band's oldest mark.
    """
    window = ago(as_of, V.FIRST_EXPORT_WINDOW)
    recent = (F.col("created_at") >= window) | (F.col("finish_time") >= window)
    marked = marks.where(F.col("last_exported_created_at").isNotNull()).select("tenant_id")
    first = join_per_tenant(flat.where(recent), marked, how="left_anti", bound=bound).withColumn("export_type", F.lit(V.FULL))
    parts = [join_per_tenant(flat.where(band.reach()), band.limits, how="inner", bound=bound)
             .where(F.col("created_at") > F.col("_mark")).drop("_mark").withColumn("export_type", F.lit(V.INCREMENTAL))
             for band in bands(marks, as_of)]
    return reduce(DataFrame.unionByName, parts, first)


def slice_totals(taken: DataFrame) -> DataFrame:
    """Per tenant of a slice: rows, newest creation and export type. Tenants without news do not appear.

    The type is a key of a first fold, as the greatest of texts would have all rows sorted by tenant.
    """
    by_type = taken.groupBy("tenant_id", "export_type").agg(
        F.count(F.lit(1)).alias("rows_exported"), F.max("created_at").alias("last_exported_created_at"))
    return by_type.groupBy("tenant_id").agg(
        F.sum("rows_exported").alias("rows_exported"), F.max("last_exported_created_at").alias("last_exported_created_at"),
        F.max("export_type").alias("export_type"))


def next_watermark(totals: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Mark updates: the newest creation of the slice, for tenants with at least one successful format."""
    good = outcomes.where(F.col("status") == V.SUCCESS).select("tenant_id").distinct()
    return (totals.join(good, "tenant_id", "left_semi")
            .select("tenant_id", "last_exported_created_at", "rows_exported", "export_type"))


def export_summary(totals: DataFrame, outcomes: DataFrame, tenants: DataFrame) -> DataFrame:
    """One row: rows exported, tenants done, without news, failed, and considered."""
    per_tenant = outcomes.groupBy("tenant_id").agg(F.count_if(F.col("status") == V.SUCCESS).alias("ok"))
    joined = (tenants.select("tenant_id").join(totals.select("tenant_id", "rows_exported"), "tenant_id", "left")
              .join(per_tenant, "tenant_id", "left"))
    news, done = F.col("rows_exported").isNotNull(), F.coalesce("ok", F.lit(0)) > 0
    return joined.agg(
        F.coalesce(F.sum(F.when(done, F.col("rows_exported"))), F.lit(0)).alias("rows_exported"),
        F.count_if(news & done).alias("tenants_exported"),
        F.count_if(~news).alias("tenants_without_news"),
        F.count_if(news & ~done).alias("tenants_failed"),
        F.count(F.lit(1)).alias("tenants_total"))


def missed_rows(source: DataFrame, lake: DataFrame, marks: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Source rows at or before their tenant's mark that the lake does not hold, so no later run takes them."""
    limits = marks.select("tenant_id", F.col("last_exported_created_at").alias("_mark"))
    behind = join_per_tenant(source, limits, how="inner", bound=bound).where(F.col("created_at") <= F.col("_mark")).drop("_mark")
    return behind.join(lake.select("id"), "id", "left_anti")


def tenant_reconciliation(lake_tenants: DataFrame, source: DataFrame) -> DataFrame:
    """Every tenant of lake or source, where it is present, and its source rows."""
    counts = source.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("tickets"))
    in_lake = lake_tenants.select("tenant_id", F.lit(True).alias("_lake"))
    presence = (F.when(F.col("_lake") & F.col("tickets").isNotNull(), "both")
                .when(F.col("_lake"), "lake_only").otherwise("source_only"))
    return (in_lake.join(counts, "tenant_id", "full")
            .select("tenant_id", presence.alias("presence"), F.coalesce("tickets", F.lit(0)).alias("tickets"))
            .orderBy("presence", "tenant_id"))


def full_slice(flat: DataFrame, lake_tenants: DataFrame) -> DataFrame:
    """All rows of tenants that have a place in the lake."""
    known = lake_tenants.select("tenant_id")
    return join_per_tenant(flat, known, how="left_semi").withColumn("export_type", F.lit(V.FULL))


def tenant_search(tenants: DataFrame, tickets: DataFrame, names: list[str] | None = None,
                  ids: list[str] | None = None) -> DataFrame:
    """Tenants by name part and id with their ticket counts, zero included."""
    found = tenants
    if names:
        found = found.where(matches_any(F.col("name"), names))
    if ids:
        found = found.where(F.col("id").isin(*ids))
    counts = tickets.groupBy(F.col("tenant_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return (found.join(counts, "id", "left")
            .select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"),
                    F.coalesce("n", F.lit(0)).alias("ticket_count"))
            .orderBy(F.desc("ticket_count"), "tenant_id"))
