from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import MINUTE, T0, flat, rows_by, settings, ticket
from desklake.operators import compaction, retention, runlog
from desklake.operators.settings import Dialect
from desklake.operators.writer import lake_write, write_partitions, lake_rows
from desklake.sources import lake as L

DAY = "2026-01-05"
NIGHT = datetime(2026, 1, 6, 2, 0, 0)


def put(lake, rows, run, dialect=Dialect("parquet")):
    lake_write(rows, lake.data, dialect, DAY, run)


def test_skip_reasons(spark, lake):
    put(lake, flat(spark, ticket(1)), "1")
    L.register_tenants(lake, spark.createDataFrame([("b",)], "tenant_id string"))
    assert rows_by(compaction.compact(lake, DAY, NIGHT), "tenant_id", "status", "reason") == {
        "a": ("skipped", "single_file"), "b": ("skipped", "no_files")}
    assert L.lake_read(lake).count() == 1


def test_identical_rows_collapse(spark, lake):
    put(lake, flat(spark, ticket(1), ticket(2)), "1")
    put(lake, flat(spark, ticket(2), ticket(3)), "2")
    got = compaction.compact(lake, DAY, NIGHT).first()
    assert (got.status, got.files_before, got.files_after, got.rows_before, got.rows_after, got.duplicates_removed, got.files_deleted) == (
        "success", 2, 1, 4, 3, 1, 2)
    assert sorted(r.id for r in L.lake_read(lake).collect()) == [1, 2, 3]
    files = L.scan_files(lake, DAY)
    assert files.count() == 1 and files.first().run.startswith("20260105_consolidated")
    logged = runlog.runlog_read(lake).first()
    assert (logged.tenant_id, logged.export_type, logged.rows_affected, logged.duplicates_removed) == ("a", "COMPACTION", 3, 1)


def test_again_and_after_a_late_file(spark, lake):
    put(lake, flat(spark, ticket(1)), "1")
    put(lake, flat(spark, ticket(2)), "2")
    compaction.compact(lake, DAY, NIGHT)
    assert compaction.compact(lake, DAY, NIGHT.replace(hour=3)).first().reason == "single_file"
    put(lake, flat(spark, ticket(3)), "3")
    assert compaction.compact(lake, DAY, NIGHT.replace(hour=4)).first().status == "success"
    assert sorted(r.id for r in L.lake_read(lake).collect()) == [1, 2, 3]
    assert L.scan_files(lake, DAY).count() == 1


def test_open_tickets_need_keys(spark, lake):
    put(lake, flat(spark, ticket(1), as_of=T0 + MINUTE), "1")
    put(lake, flat(spark, ticket(1), as_of=T0 + 5 * MINUTE), "2")
    rows = L.lake_read(lake)
    assert compaction.deduplicate(rows).count() == 2
    latest = compaction.deduplicate(rows, keys=["id"]).collect()
    assert [r.duration_minutes for r in latest] == [5.0]


def test_csv_takes_the_present_dialect(spark, lake):
    put(lake, flat(spark, ticket(1, title="ç;,")), "1", Dialect("csv"))
    put(lake, flat(spark, ticket(2, title="ç;,")), "2", Dialect("csv", delimiter=";", encoding="iso-8859-1"))
    lake.settings.replace(settings(spark, ("a", ["csv"], {"csv_delimiter": "|"})))
    assert compaction.compact(lake, DAY, NIGHT).first().status == "success"
    assert rows_by(L.lake_read(lake, "csv"), "id", "title") == {1: "ç;,", 2: "ç;,"}
    assert {r.dialect.split(".")[0] for r in L.scan_files(lake).collect()} == {"pipe"}


def test_only_enabled_formats(spark, lake):
    for run in "12":
        put(lake, flat(spark, ticket(int(run))), run, Dialect("csv"))
    assert rows_by(compaction.compact(lake, DAY, NIGHT), "file_format", "reason") == {"parquet": "no_files"}
    assert L.scan_files(lake, DAY).count() == 2


def test_unreadable_input_keeps_everything(spark, lake):
    for run in "12":
        put(lake, flat(spark, ticket(int(run))), run)
    broken = lake.files.matches(f"{lake.data}/*/*/*/*/*/*/run=1/*.parquet")[0].removeprefix("file:")
    with open(broken, "wb") as file:
        file.write(b"not parquet at all")
    got = compaction.compact(lake, DAY, NIGHT).first()
    assert got.status == "error" and got.files_deleted == 0
    assert L.scan_files(lake, DAY).count() == 2
    assert runlog.runlog_read(lake).first().status == "ERROR"


@pytest.mark.parametrize("harm", ["lost", "twice", "other"])
@pytest.mark.parametrize("dialect", [Dialect("parquet"), Dialect("csv")])
def test_staged_rows_that_differ_keep_the_inputs(spark, lake, monkeypatch, harm, dialect):
    for run in "12":
        put(lake, flat(spark, ticket(int(run)), ticket(9)), run, dialect)
    lake.settings.replace(settings(spark, ("a", [dialect.file_format], {})))
    write = compaction.write_partitions
    harmed = {"lost": lambda rows: rows.where("id <> 9"), "twice": lambda rows: rows.unionAll(rows.where("id = 1")),
              "other": lambda rows: rows.withColumn("id", F.when(F.col("id") == 9, 8).otherwise(F.col("id")).cast("bigint"))}[harm]
    monkeypatch.setattr(compaction, "write_partitions", lambda rows, *args, **more: write(harmed(rows), *args, **more))
    got = compaction.compact(lake, DAY, NIGHT).first()
    assert got.status == "error" and got.reason.startswith("validation failed") and got.files_deleted == 0
    assert L.scan_files(lake, DAY).count() == 2
    monkeypatch.setattr(compaction, "write_partitions", write)
    assert compaction.compact(lake, DAY, NIGHT.replace(hour=5)).first().rows_after == 3


def test_staged_files_are_checked_again(spark, lake):
    for run in "12":
        put(lake, flat(spark, ticket(int(run)), ticket(9), ticket(int(run) + 20, tenant="b")), run)
    compaction.compact(lake, DAY, NIGHT, publish_now=False)
    rows = compaction.staged_check(lake, DAY)
    assert rows_by(rows, "tenant_id", "rows_expected", "rows_staged", "matches") == {"a": (3, 3, True), "b": (2, 2, True)}
    lake.files.delete(lake.files.matches(f"{lake.root}/compaction/*/*/data/tenant_key=b")[0])
    assert rows_by(compaction.staged_check(lake, DAY), "tenant_id", "rows_staged", "matches") == {"a": (3, True), "b": (0, False)}


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_fingerprint_does_not_depend_on_order_or_copies(spark, lake, keys):
    rows = [ticket(i, title=None if i % 3 else "", requester=i) for i in range(30)]
    put(lake, flat(spark, *rows), "1")
    put(lake, flat(spark, *reversed(rows)), "2")
    want = compaction.expected_rows(L.lake_read(lake), "parquet", keys).first()
    once = compaction.staged_rows(L.lake_read(lake, run="2"), "parquet", keys).first()
    assert (want.rows_before, want.rows_expected, want.print_expected) == (60, 30, once.print_after) and once.rows_after == 30


@pytest.mark.parametrize("moment", ["before_move", "after_move"])
def test_interrupted_publish_is_finished_by_the_next_call(spark, lake, monkeypatch, moment):
    for run in "12":
        put(lake, flat(spark, ticket(int(run)), ticket(9)), run)
    whole = compaction.publish

    def interrupted(lake, folder):
        if moment == "after_move":
            class Stop(Exception):
                pass
            real = type(lake.files).delete
            monkeypatch.setattr(type(lake.files), "delete", lambda self, path: (_ for _ in ()).throw(Stop()))
            try:
                whole(lake, folder)
            finally:
                monkeypatch.setattr(type(lake.files), "delete", real)
        raise KeyboardInterrupt

    monkeypatch.setattr(compaction, "publish", interrupted)
    with pytest.raises((KeyboardInterrupt, RuntimeError)):
        outcome = compaction.compact(lake, DAY, NIGHT)
        raise RuntimeError(outcome)
    monkeypatch.setattr(compaction, "publish", whole)
    assert {1, 2, 9} <= {r.id for r in L.lake_read(lake).collect()}
    compaction.compact(lake, DAY, NIGHT.replace(hour=5))
    assert sorted(r.id for r in L.lake_read(lake).collect()) == [1, 2, 9]
    assert L.scan_files(lake, DAY).count() == 1


def test_hot_tenant_is_split_over_files_and_not_compacted_again(spark, lake):
    many = [ticket(i, title=f"title {i} " * 20) for i in range(400)] + [ticket(1000, tenant="small")]
    rows = flat(spark, *many).repartition(4)
    write_partitions(lake_rows(rows, Dialect("parquet"), DAY, "1"), lake.data, Dialect("parquet"), rows_per_file=100)
    files = rows_by(L.scan_files(lake).groupBy("tenant_id").count(), "tenant_id", "count")
    assert 2 <= files["a"] <= 4 and files["small"] == 1
    listing = L.scan_files(lake).withColumn("run", F.lit("20260105_consolidated_x"))
    enabled = spark.createDataFrame([("a", "parquet")], "tenant_id string, format string")
    assert compaction.plan_day(listing, enabled).first().reason == "single_file"


def test_tiers_by_age(spark):
    ages = [30, 31, 90, 91, 730, 731]
    as_of = datetime(2026, 6, 1)
    files = spark.createDataFrame([(a, None) for a in ages] + [(-7, "superseded"), (-8, "superseded")], "age int, compaction_status string")
    moved = files.withColumn("modified_at", F.timestamp_add("DAY", -F.abs("age"), F.lit(str(as_of)).cast("timestamp_ntz")))
    assert rows_by(retention.lifecycle_plan(moved, as_of), "age", "tier") == {
        30: "hot", 31: "cool", 90: "cool", 91: "archive", 730: "archive", 731: "delete", -7: "hot", -8: "delete"}


@pytest.mark.parametrize("copies", [1, 5])
def test_rows_are_shuffled_once_where_most_stay(spark, lake, monkeypatch, copies):
    """Folding and writing share a shuffle by tenant and file; many copies are folded before the shuffle."""
    for run in range(copies):
        put(lake, flat(spark, *[ticket(i, title=None) for i in range(40)], ticket(50, tenant="b")), f"{run}")
    put(lake, flat(spark, *[ticket(i) for i in range(10, 20)], ticket(51, tenant="b")), "last")
    seen, write = [], compaction.write_partitions

    def noted(rows, *args, **more):
        seen.append((rows._jdf.queryExecution().executedPlan().toString(), more["ready"]))
        write(rows, *args, **more)

    monkeypatch.setattr(compaction, "write_partitions", noted)
    assert rows_by(compaction.compact(lake, DAY, NIGHT), "tenant_id", "status", "rows_before", "rows_after") == {
        "a": ("success", 40 * copies + 10, 50), "b": ("success", copies + 1, 2)}
    (text, ready), = seen
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(tenant_key" in line and "_slice" in line]
    assert ready == (copies == 1) == (len(wide) == 1)
    assert L.lake_read(lake).count() == 52 and L.scan_files(lake).count() == 2
