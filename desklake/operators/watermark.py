"""Stored high-water marks: one row per tenant saying up to which creation time it was exported."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, ago, clock, hours_between
from desklake.operators.bands import bands
from desklake.operators.joins import join_per_tenant
from desklake.plans.tickets import counts_per_tenant

# Fixed value: the moment that stands for "never exported".
NEVER = "1970-01-01 00:00:00"


def _marks(frame: DataFrame) -> DataFrame:
    return schemas.evolve(frame, schemas.WATERMARK)


def _without_mark(tenants: DataFrame, marks: DataFrame) -> DataFrame:
    return tenants.select(F.col("id").alias("tenant_id")).join(marks, "tenant_id", "left_anti")


def _new_marks(frame: DataFrame, as_of: Clock, note: str) -> DataFrame:
    now = clock(as_of)
    return _marks(frame.withColumns({"last_export_success_at": now, "export_type": F.lit(V.FULL), "notes": F.lit(note),
                                     "created_at": now, "updated_at": now}))


def watermark_bootstrap(tenants: DataFrame, tickets: DataFrame, marks: DataFrame, as_of: Clock,
                        note: str = "initial mark from existing tickets") -> DataFrame:
    """Marks for tenants without one: their newest ticket, or a week ago when they have none."""
    missing = _without_mark(tenants, marks).join(counts_per_tenant(tickets), "tenant_id", "left")
    return _new_marks(missing.withColumns({
        "last_exported_created_at": F.coalesce("last_created_at", ago(as_of, V.REPLAY_WINDOW)),
        "rows_exported": F.coalesce("tickets", F.lit(0))}), as_of, note)


def watermark_bootstrap_replay(tenants: DataFrame, marks: DataFrame, as_of: Clock,
                               note: str = "initial mark, last week is exported again") -> DataFrame:
    """Marks a week back for tenants without one."""
    return _new_marks(_without_mark(tenants, marks).withColumns({
        "last_exported_created_at": ago(as_of, V.REPLAY_WINDOW), "rows_exported": F.lit(0)}), as_of, note)


def watermark_reset(marks: DataFrame, tenant_ids: list[str], as_of: Clock,
                    note: str = "manual reset, forced re-export") -> DataFrame:
    """All marks with the named tenants moved a week back and flagged for a full export."""
    hit = F.col("tenant_id").isin(*tenant_ids)
    new = {"last_exported_created_at": ago(as_of, V.REPLAY_WINDOW), "export_type": F.lit(V.FULL),
           "notes": F.lit(note), "updated_at": clock(as_of)}
    return _marks(marks).withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in new.items()})


def watermark_upsert(marks: DataFrame, updates: DataFrame, at: Clock) -> DataFrame:
    """All marks after one export: ``updates`` win (the latest of a tenant), other tenants keep theirs, notes and creation stay."""
    now = clock(at)
    old = _marks(marks).select("tenant_id", F.struct([c for c in schemas.WATERMARK.names if c != "tenant_id"]).alias("old"))
    new = updates.groupBy("tenant_id").agg(F.max(F.struct("last_exported_created_at", "rows_exported", "export_type")).alias("new"))
    changed = F.col("new").isNotNull()

    def pick(name: str) -> Column:
        return F.when(changed, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return _marks(old.join(new, "tenant_id", "full").select(
        "tenant_id", pick("last_exported_created_at"),
        F.when(changed, now).otherwise(F.col("old.last_export_success_at")).alias("last_export_success_at"),
        pick("rows_exported"), pick("export_type"), F.col("old.notes").alias("notes"),
        F.coalesce("old.created_at", F.when(F.col("old").isNull(), now)).alias("created_at"),
        F.when(changed, now).otherwise(F.col("old.updated_at")).alias("updated_at")))


def watermark_latest(ledger: DataFrame, order: tuple[str, ...] = ("updated_at", "last_exported_created_at")) -> DataFrame:
    """The newest entry per tenant of an append-only ledger.

    An aggregate, not a window: entries of a hot tenant are folded before the shuffle.
    """
    rest = [c for c in ledger.columns if c != "tenant_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*order, "rows_exported")).alias("entry")
    return ledger.groupBy("tenant_id").agg(newest).select("tenant_id", *[F.col(f"entry.{c}").alias(c) for c in rest])


def pending_per_tenant(tickets: DataFrame, marks: DataFrame, as_of: Clock, bound: DataFrame | None = None) -> DataFrame:
    """Tickets created after the tenant's mark, counted; each band of marks bounds its own scan."""
    source = tickets.select("id", "tenant_id", "created_at")
    late = [join_per_tenant(source.where(band.reach()), band.limits, how="inner", bound=bound).where(F.col("created_at") > F.col("_mark"))
            for band in bands(marks, as_of)] or [source.where(F.lit(False))]
    return reduce(DataFrame.unionByName, [part.select("tenant_id") for part in late]).groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("pending"))


def watermark_status(marks: DataFrame, tenants: DataFrame, tickets: DataFrame, as_of: Clock) -> DataFrame:
    """Mark, age and pending tickets per tenant; tenants with nothing pending show zero."""
    names = tenants.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"))
    return (marks.join(names, "tenant_id")
            .join(pending_per_tenant(tickets, marks, as_of, bound=tenants), "tenant_id", "left")
            .select("tenant_id", "tenant_name", "last_exported_created_at", "last_export_success_at", "rows_exported",
                    "export_type",
                    hours_between(F.col("last_export_success_at"), clock(as_of)).alias("hours_since_last_export"),
                    F.coalesce("pending", F.lit(0)).alias("pending_tickets"), "notes")
            .orderBy(F.desc("last_export_success_at"), "tenant_id"))


def lagging_exports(status: DataFrame, hours: float = 1.0) -> DataFrame:
    return status.where(F.col("hours_since_last_export") > hours)


def stale_tenants(tenants: DataFrame, marks: DataFrame, as_of: Clock, span: str = "2 hours") -> DataFrame:
    """Tenants, exported or never, whose last export lies before the span."""
    last = F.coalesce("last_export_success_at", clock(NEVER))
    marked = marks.select(F.col("tenant_id").alias("id"), "last_export_success_at")
    return (tenants.join(marked, "id", "left").where(last < ago(as_of, span))
            .select("id", "name", last.alias("last_export"),
                    hours_between(last, clock(as_of)).alias("hours_since_last_export"))
            .orderBy(F.desc("hours_since_last_export"), "id"))
