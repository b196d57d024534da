"""What the physical plans must and must not contain."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from builders import flat, marks, ticket, T0
from conftest import SMALL
from desklake.operators import incremental, settings as S, watermark, writer
from desklake.operators.flat import with_requester
from desklake.operators.settings import Dialect
from desklake.operators.writer import lake_rows, lake_write, write_partitions
from desklake.plans import registry
from desklake.sources import lake as L
from desklake.sources.fixtures import HelpDesk

STORED = {"refresh_flat", "snapshot_stats", "export_run", "lake_read_parquet", "lake_read_csv", "watermark_after_export",
          "runlog_append", "lake_status_counts", "compact", "lake_after_compaction", "file_inventory", "stream_export",
          "read_flat", "lake_tenants", "lake_combine", "export_replay", "logged_files", "stored_candidates",
          "stored_lifecycle_plan", "stored_file_purge", "compact_recovered", "lake_combine_first", "refresh_months",
          "lake_read_dialects", "compact_mismatch"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - STORED))
def test_no_query_multiplies_rows_or_runs_row_python(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name == "failure_streaks")


def test_columns_are_pruned_and_filters_pushed(spark):
    desk = HelpDesk(spark, SMALL)
    text = plan(registry.tickets_by_status(desk))
    assert "lineitem" not in text, "the outer join with unique keys is not needed"
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text
    text = plan(registry.refresh_duration_stats(desk))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-24T00:00", text)


def test_partitions_are_pruned(spark, lake):
    for run in "12":
        lake_write(flat(spark, ticket(1), ticket(2, tenant="b")), lake.data, Dialect("parquet"), "2026-01-05", run)
    frame = L.lake_read(lake).where("tenant_key = 'b' AND day = '05' AND created_at > '2026-01-01'").select("id")
    text = plan(frame)
    assert re.search(r"PartitionFilters: \[[^\]]*tenant_key[^\]]*= b", text) and re.search(r"PushedFilters: \[[^\]]*GreaterThan\(created_at", text)
    assert "ReadSchema: struct<id:bigint,created_at:timestamp_ntz>" in text
    assert L.lake_read(lake, tenant="b").count() == 2 and L.lake_read(lake, run="1", day="2026-01-05").count() == 2
    assert L.lake_read(lake, day="2026-01-06").count() == 0


def pushed(frame):
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        lines = [line for line in plan(frame).splitlines() if "FileScan parquet" in line and "/snapshot/" in line]
    finally:
        frame.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    return [re.search(r"PushedFilters: \[(.*)\], ReadSchema", line)[1] for line in lines]


def test_an_idle_tenant_does_not_widen_the_scan_of_the_others(spark, lake):
    lake.snapshot.replace(flat(spark, ticket(1), ticket(2, tenant="b")))
    old, young = datetime(2023, 1, 5), T0 - timedelta(hours=1)
    lake.marks.replace(marks(spark, **{f"t{n}": young for n in range(150)}, idle=old, idle2=old + timedelta(days=1), half=T0 - timedelta(days=200)))
    frame = incremental.incremental_slice(lake.snapshot.read(), lake.marks.read(), T0)
    scans = pushed(frame)
    assert len(scans) == 4  # tenants without a mark, and three bands
    assert [f"GreaterThan(created_at,{young.isoformat(timespec='minutes')}" in scan and "tenant_id,[" not in scan for scan in scans].count(True) == 1
    wide = [scan for scan in scans if f"GreaterThan(created_at,{old.isoformat(timespec='minutes')}" in scan]
    assert len(wide) == 1 and re.search(r"In\(tenant_id, ?\[idle2?,idle2?", wide[0])
    assert "BroadcastHashJoin" in plan(frame)
    pending = pushed(watermark.pending_per_tenant(lake.snapshot.read(), lake.marks.read(), T0))
    assert len(pending) == 3 and all("GreaterThan(created_at,20" in scan for scan in pending)


def test_bands_take_what_one_rule_per_tenant_takes(spark):
    ages = {"a": 0, "b": 20, "c": 200, "d": 2000, "e": 31}
    known = marks(spark, **{tenant: T0 - timedelta(days=age) for tenant, age in ages.items()})
    rows = flat(spark, *[ticket(k * 100 + n, tenant=tenant, created=T0 - timedelta(days=n * 97, hours=-1))
                         for k, tenant in enumerate([*ages, "new"]) for n in range(30)])
    got = {(r.id, r.export_type) for r in incremental.incremental_slice(rows, known, T0).collect()}
    want = {(r.id, "INCREMENTAL" if r.tenant_id in ages else "FULL") for r in rows.collect()
            if (r.created_at > T0 - timedelta(days=ages[r.tenant_id]) if r.tenant_id in ages else r.created_at >= T0 - timedelta(minutes=30))}
    assert got == want
    counts = {r.tenant_id: r.pending for r in watermark.pending_per_tenant(rows, known, T0).collect()}
    assert counts == {t: n for t in ages if (n := sum(1 for i, kind in want if kind == "INCREMENTAL" and i // 100 == list(ages).index(t)))}
    assert watermark.pending_per_tenant(rows, known.where("false"), T0).count() == 0


def test_a_hot_tenant_is_split_and_small_ones_stay_whole(spark, lake, monkeypatch):
    base = flat(spark, ticket(1))
    hot = F.when(F.col("id") % 3 == 0, F.concat(F.lit("t"), (F.col("id") % 30).cast("string"))).otherwise("hot")
    rows = (spark.range(20000).join(F.broadcast(base.drop("id"))).withColumn("tenant_id", hot).select(*base.columns).repartition(16))
    shaped = lake_rows(rows, Dialect("parquet"), "2026-01-05", "1")
    for limit in (writer.BROADCAST_ROWS, 0):  # the second makes the list of large tenants too long to broadcast
        monkeypatch.setattr(writer, "BROADCAST_ROWS", limit)
        write_partitions(shaped, lake.data, Dialect("parquet"), rows_per_file=1000)
        files = {r.tenant_id: r["count"] for r in L.scan_files(lake).groupBy("tenant_id").count().collect()}
        assert 7 <= files.pop("hot") <= 14
        assert len(files) == 10 and set(files.values()) == {1}
        assert L.lake_read(lake).count() == 20000


def test_one_sort_serves_the_partitioned_write(spark):
    shaped = lake_rows(flat(spark, ticket(1)), Dialect("parquet"), "2026-01-05", "1")
    assert plan(writer.spread(shaped, 10).sortWithinPartitions("tenant_key")).count("Exchange hashpartitioning(tenant_key") == 1


def test_a_hot_requester_is_split(spark):
    """Two thirds of all tickets share one requester, the rest has none; adaptive execution divides both."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tickets = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("title"), F.when(
            F.col("id") % 3 < 2, 7).otherwise(F.when(F.col("id") % 6 == 2, F.col("id"))).cast("bigint").alias("requester_id")).repartition(8)
        users = spark.range(50000).select("id", F.concat(F.lit("u"), "id").alias("name"))
        frame = with_requester(tickets, users)
        got = frame.agg(F.count(F.lit(1)), F.count("requester_name")).first()
        assert got[0] == 60000 and got[1] > 40000
        sink = with_requester(tickets, users)
        sink.write.format("noop").mode("overwrite").save()
        sink.collect()
        assert "skew=true" in sink._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_dialects_stay_few(spark):
    rows = [(f"t{i}", ["parquet", "csv"], {"csv_delimiter": ",;|#"[i % 4], "csv_encoding": ["utf-8", "latin1"][i % 2],
                                           "csv_date_format": f"%Y-%m-%d{'-' * (i % 5)}"}) for i in range(40)]
    from builders import settings
    stored = settings(spark, *rows)
    assigned = S.dialect_columns(S.export_config(stored.select("tenant_id"), stored))
    found = S.distinct_dialects(assigned)
    assert len([d for d in found if d.file_format == "csv"]) == 3 and len([d for d in found if d.file_format == "parquet"]) == 1


def test_stored_dialects_are_read_by_their_own_rows(spark, monkeypatch):
    """The view of the dialect query is made once; each write scans the stored rows of its tenants."""
    seen = []
    monkeypatch.setattr(registry, "lake_write", lambda rows, *args: (seen.append(plan(rows)), lake_write(rows, *args)))
    desk = HelpDesk(spark, SMALL)
    assert registry.lake_read_dialects(desk).count() == desk.tickets.count()
    assert len(seen) > 8 and all("lineitem" not in text and re.search(r"PartitionFilters: \[[^\]]*number", text) for text in seen)


def test_tickets_join_both_customers_and_users_after_one_shuffle(spark):
    desk, limit = HelpDesk(spark, SMALL), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan(with_requester(desk.tickets, desk.users))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Orders by their key and by customer, line items by order, customers and users.
    assert joined.count("Exchange hashpartitioning") == 5
