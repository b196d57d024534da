"""Reports on the ticket table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.clock import Clock, clock
from desklake.functions.numbers import percent, round_half_up
from desklake.operators.flat import with_measures

def _with_share(grouped: DataFrame) -> DataFrame:
    """Share of the total; the frame has one row per status word, so one task suffices."""
    return grouped.withColumn("percentage", percent(F.col("total_tickets"), F.sum("total_tickets").over(Window.partitionBy())))


def tickets_by_status(tickets: DataFrame) -> DataFrame:
    counts = tickets.groupBy(F.col("status").alias("ticket_status")).agg(F.count(F.lit(1)).alias("total_tickets"))
    return _with_share(counts).orderBy(F.desc("total_tickets"), "ticket_status")


def active_by_sla(flat: DataFrame) -> DataFrame:
    """Open tickets per service-level state. Needs only columns that exist before the requester join."""
    counts = (flat.where(F.col("ticket_status") == V.ACTIVE).groupBy("sla_status")
              .agg(F.count(F.lit(1)).alias("total_tickets"), F.avg("duration_minutes").alias("_mean")))
    return (_with_share(counts)
            .select("sla_status", "total_tickets", "percentage", round_half_up(F.col("_mean")).alias("avg_duration_minutes"))
            .orderBy(F.desc("total_tickets"), "sla_status"))


def active_by_sla_from_tickets(tickets: DataFrame, as_of: Clock) -> DataFrame:
    return active_by_sla(with_measures(tickets, as_of))


def top_requesters(tickets: DataFrame, users: DataFrame, as_of: Clock, top: int = 10) -> DataFrame:
    """Requesters with most open tickets.

    Open tickets are first reduced to one row per requester id, so the join with users and the
    regrouping by name move requesters, not tickets, and a hot requester is folded before any shuffle.
    """
    open_tickets = with_measures(tickets.where(F.col("status") == V.ACTIVE), as_of)
    per_requester = open_tickets.groupBy("requester_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("duration_minutes").alias("minutes"),
        F.sum(F.when(F.col("sla_status").isin(*V.VIOLATIONS), 1).otherwise(0)).alias("violations"))
    names = users.select(F.col("id").alias("requester_id"), F.col("name").alias("requester_name"))
    return (per_requester.join(names, "requester_id", "left")
            .groupBy("requester_name")
            .agg(F.sum("n").alias("active_tickets"),
                 round_half_up(F.sum("minutes") / F.sum("n")).alias("avg_duration_minutes"),
                 F.sum("violations").alias("sla_violations"))
            .orderBy(F.desc("active_tickets"), F.asc_nulls_last("requester_name"))
            .limit(top))


def flat_row_count(flat: DataFrame) -> DataFrame:
    return flat.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(V.FLAT_VIEW).alias("view_name"), "total_rows")


def counts_per_tenant(tickets: DataFrame) -> DataFrame:
    """Rows and last creation per tenant, the building block of every tenant report."""
    return tickets.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("tickets"), F.max("created_at").alias("last_created_at"))


def tickets_per_tenant(tickets: DataFrame, tenants: DataFrame) -> DataFrame:
    names = tenants.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"))
    return (counts_per_tenant(tickets).join(names, "tenant_id", "left")
            .select("tenant_id", "tenant_name", F.col("tickets").alias("tickets_exported"),
                    F.col("last_created_at").alias("last_change"))
            .orderBy(F.desc("last_change"), "tenant_id"))


def status_counts_since(flat: DataFrame, since: Clock) -> DataFrame:
    return (flat.where(F.col("created_at") >= clock(since)).groupBy("ticket_status")
            .agg(F.count(F.lit(1)).alias("total")).orderBy("ticket_status"))
