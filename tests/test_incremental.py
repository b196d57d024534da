from datetime import timedelta

from hypothesis import HealthCheck, given, settings as limits, strategies as st
from pyspark.sql import functions as F

from builders import MINUTE, T0, flat, marks, rows_by, tenants, ticket, tickets
from desklake.operators import incremental, watermark
from desklake.operators.joins import join_per_tenant, salted_join

NOW = T0 + timedelta(days=10)


def test_rows_at_the_mark_are_not_taken(spark):
    rows = flat(spark, ticket(1), ticket(2), ticket(3, created=T0 + MINUTE))
    taken = incremental.incremental_slice(rows, marks(spark, a=T0), NOW)
    assert rows_by(taken, "id", "export_type") == {3: "INCREMENTAL"}


def test_first_export_takes_recent_activity(spark):
    rows = flat(spark, ticket(1, created=NOW - timedelta(days=2), finish=NOW - 10 * MINUTE), ticket(2, created=NOW - timedelta(days=2)),
                ticket(3, created=NOW - 30 * MINUTE), ticket(4, created=NOW - 31 * MINUTE))
    taken = incremental.incremental_slice(rows, marks(spark), NOW)
    assert rows_by(taken, "id", "export_type") == {1: "FULL", 3: "FULL"}


def test_scan_filter_keeps_both_rules(spark):
    rows = flat(spark, ticket(1, tenant="old", created=T0 - timedelta(days=300)), ticket(2, tenant="b", finish=NOW),
                ticket(3, tenant="new", created=T0 + MINUTE))
    limits_ = marks(spark, old=T0 - timedelta(days=301), new=T0)
    assert set(rows_by(incremental.incremental_slice(rows, limits_, NOW), "id", "export_type")) == {1, 2, 3}


def test_mark_moves_only_with_a_success(spark):
    totals = incremental.slice_totals(incremental.incremental_slice(
        flat(spark, ticket(1), ticket(2, tenant="b")), marks(spark, a=T0 - MINUTE, b=T0 - MINUTE, c=T0), NOW))
    outcomes = spark.createDataFrame([("a", "SUCCESS"), ("a", "ERROR"), ("b", "ERROR")], "tenant_id string, status string")
    updates = incremental.next_watermark(totals, outcomes)
    merged = watermark.watermark_upsert(marks(spark, b=T0 - MINUTE, c=T0), updates, NOW)
    got = rows_by(merged, "tenant_id", "last_exported_created_at", "last_export_success_at", "created_at")
    assert got == {"a": (T0, NOW, NOW), "b": (T0 - MINUTE, T0 - MINUTE, None), "c": (T0, T0, None)}
    summary = incremental.export_summary(totals, outcomes, spark.createDataFrame([("a",), ("b",), ("c",)], "tenant_id string")).first()
    assert tuple(summary) == (1, 1, 1, 1, 3)


def test_upsert_twice_is_once(spark):
    updates = spark.createDataFrame([("a", T0, 5, "FULL")], "tenant_id string, last_exported_created_at timestamp_ntz, rows_exported bigint, export_type string")
    once = watermark.watermark_upsert(marks(spark, b=T0), updates, NOW)
    assert sorted(once.collect()) == sorted(watermark.watermark_upsert(once, updates, NOW).collect())


def test_status_keeps_tenants_without_pending(spark):
    rows = tickets(spark, ticket(1, created=T0 + MINUTE), ticket(2, tenant="b"))
    status = watermark.watermark_status(marks(spark, a=T0, b=T0), tenants(spark, a="A", b="B"), rows, NOW)
    assert rows_by(status, "tenant_id", "pending_tickets") == {"a": 1, "b": 0}


def test_latest_entry_of_a_ledger(spark):
    ledger = marks(spark, a=T0).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")).unionByName(
        marks(spark, a=T0 + MINUTE).withColumn("updated_at", F.col("last_exported_created_at")))
    assert rows_by(watermark.watermark_latest(ledger), "tenant_id", "last_exported_created_at") == {"a": T0 + MINUTE}


def test_reconciliation(spark):
    folders = spark.createDataFrame([("a",), ("z",)], "tenant_id string")
    got = incremental.tenant_reconciliation(folders, tickets(spark, ticket(1), ticket(2, tenant="b")))
    assert rows_by(got, "tenant_id", "presence", "tickets") == {"a": ("both", 1), "b": ("source_only", 1), "z": ("lake_only", 0)}


def test_missed_rows(spark):
    source = tickets(spark, ticket(1), ticket(2), ticket(3, created=T0 + MINUTE))
    lake = tickets(spark, ticket(1))
    assert {r.id for r in incremental.missed_rows(source, lake, marks(spark, a=T0)).collect()} == {2}


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, (F.col("id") % 20).cast("string")).alias("tenant_id"))
    per_tenant = spark.createDataFrame([("hot", 1), ("4", 2), ("none", 3)], "tenant_id string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = facts.join(per_tenant, "tenant_id", how)
        for other in (salted_join(facts, per_tenant, "tenant_id", how, "id"),
                      join_per_tenant(facts, per_tenant, how=how, max_rows=1), join_per_tenant(facts, per_tenant, how=how)):
            assert sorted(plain.collect(), key=str) == sorted(other.select(*plain.columns).collect(), key=str)


@limits(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=25), st.lists(st.integers(0, 40), min_size=1, max_size=3))
def test_runs_one_after_another_export_everything_once(spark, created, clocks):
    """Without late rows, slices of successive runs do not overlap and together give all rows after the first mark."""
    rows = [(i, tenant, T0 + minute * MINUTE) for i, (tenant, minute) in enumerate(created)]
    known = {t: T0 - MINUTE for t in "ab"}
    seen: list[int] = []
    for moment in sorted(clocks) + [41]:
        arrived = [r for r in rows if r[2] < T0 + moment * MINUTE]
        for tenant in "ab":
            fresh = [r for r in arrived if r[1] == tenant and r[2] > known[tenant]]
            expected = {r[0] for r in fresh}
            frame = spark.createDataFrame([r for r in arrived if r[1] == tenant] or [(-1, tenant, T0 - 5 * MINUTE)],
                                          "id bigint, tenant_id string, created_at timestamp_ntz").withColumn("finish_time", F.lit(None).cast("timestamp_ntz"))
            got = {r.id for r in incremental.incremental_slice(frame, marks(spark, **{tenant: known[tenant]}), NOW).collect()}
            assert got == expected
            seen += got
            known[tenant] = max([r[2] for r in fresh], default=known[tenant])
    assert sorted(seen) == [r[0] for r in rows]


def test_totals_are_folded_without_sorting_the_rows(spark):
    rows = spark.createDataFrame([("a", T0, "FULL"), ("a", T0 + MINUTE, "INCREMENTAL"), ("b", None, "FULL"), (None, T0, None)],
                                 "tenant_id string, created_at timestamp_ntz, export_type string")
    totals = incremental.slice_totals(rows)
    assert rows_by(totals, "tenant_id", "rows_exported", "last_exported_created_at", "export_type") == {
        "a": (2, T0 + MINUTE, "INCREMENTAL"), "b": (1, None, "FULL"), None: (1, T0, None)}
    first_step = totals._jdf.queryExecution().executedPlan().toString().rsplit("Exchange", 1)[1]
    assert "HashAggregate" in first_step and "Sort" not in first_step
