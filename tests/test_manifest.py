"""The file manifest: repeated entries, names to be escaped, foreign files, interrupted purges; date formats both ways."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from builders import MINUTE, T0, flat, marks, rows_by, settings, ticket
from desklake.functions.formats import date_pattern, valid_date_format
from desklake.operators import compaction, export, retention
from desklake.operators.settings import Dialect
from desklake.operators.writer import lake_write
from desklake.sources import lake as L, manifest

RUN, DAY = datetime(2026, 1, 5, 9, 15), "2026-01-05"
ODD_TENANT = "x:1 %{a}"


def prepared(lake, *names):
    L.register_tenants(lake, lake.spark.createDataFrame([(n,) for n in names], "tenant_id string"))
    lake.settings.replace(settings(lake.spark, *[(n, ["parquet", "csv"], {"csv_delimiter": "\t", "csv_date_format": "%d/%m/%Y %H:%M"}) for n in names]))


def files_of(frame):
    return sorted(row.path.removeprefix("file:") for row in frame.select("path").collect())


def test_the_manifest_is_what_the_file_system_shows(spark, lake):
    prepared(lake, "a", ODD_TENANT)
    rows = flat(spark, ticket(1), ticket(2, tenant=ODD_TENANT, created=T0 + MINUTE))
    lake.marks.replace(marks(spark, **{"a": T0 - MINUTE}))
    for _ in range(2):  # the second call repeats the run after its mark was set back
        export.export_run(lake, rows, RUN, as_of=T0 + 2 * MINUTE)
        lake.marks.replace(marks(spark, **{"a": T0 - MINUTE}))
    export.export_full(lake, rows, RUN + 15 * MINUTE)
    there = L.scan_files(lake)
    assert files_of(manifest.inventory(lake)) == files_of(there) and there.count() == 6
    assert files_of(manifest.inventory(lake, DAY, DAY)) == files_of(there) and manifest.inventory(lake, "2026-01-06").count() == 0
    assert {(r.tenant_id, r.tenant_key) for r in manifest.inventory(lake).collect()} == {("a", "a"), (ODD_TENANT, ODD_TENANT)}
    compaction.compact(lake, DAY, RUN + timedelta(days=1))
    assert files_of(manifest.inventory(lake)) == files_of(L.scan_files(lake)) and manifest.inventory(lake).count() == 4
    states = rows_by(manifest.entries(lake).groupBy("state").count(), "state", "count")
    assert states == {"live": 8, "superseded": 4, "deleted": 4}
    assert manifest.inventory(lake).where("compaction_status is not null").count() == 0


def test_files_written_without_the_manifest_are_adopted_once(spark, lake):
    prepared(lake, "a")
    for run in "12":
        lake_write(flat(spark, ticket(int(run))), lake.data, Dialect("parquet"), DAY, run)
    assert manifest.inventory(lake).count() == 0
    for _ in range(2):
        manifest.adopt(lake, DAY, RUN)
    assert files_of(manifest.inventory(lake)) == files_of(L.scan_files(lake))


def test_an_unlisted_file_in_an_input_folder_survives_compaction(spark, lake, monkeypatch):
    prepared(lake, "a")
    for run in "12":
        lake_write(flat(spark, ticket(int(run))), lake.data, Dialect("parquet"), DAY, run)
    compaction.compact(lake, DAY, RUN, publish_now=False)
    folder = L.scan_files(lake).where("run = '1'").first().folder.removeprefix("file:")
    late = flat(spark, ticket(9)).coalesce(1)
    late.write.mode("append").parquet(folder)
    assert compaction.finish_pending(lake, DAY, RUN) == 1
    assert {r.id for r in L.lake_read(lake).collect()} == {1, 2, 9}


def test_an_interrupted_purge_is_made_good(spark, lake, monkeypatch):
    prepared(lake, "a", "b")
    export.export_full(lake, flat(spark, ticket(1), ticket(2, tenant="b")), RUN)
    at = RUN + timedelta(days=800)
    plan = retention.lifecycle_plan(manifest.inventory(lake), at)
    deleted = []

    def fail(path):
        if deleted:
            raise OSError("gone")
        deleted.append(path)
    with monkeypatch.context() as patch:
        patch.setattr(lake.files, "delete", fail)
        with pytest.raises(OSError):
            retention.purge(lake, plan, at)
    assert manifest.inventory(lake).count() == 2
    assert retention.purge(lake, retention.lifecycle_plan(manifest.inventory(lake), at), at) == 2
    assert manifest.inventory(lake).count() == L.scan_files(lake).count() == 0


def test_a_replay_after_compaction_stays_within_the_stored_bounds(spark, lake):
    prepared(lake, "a")
    lake.marks.replace(marks(spark, a=T0))
    export.export_run(lake, flat(spark, ticket(1), ticket(2, created=T0 + MINUTE), ticket(3, created=T0 + 2 * MINUTE)), RUN)
    export.export_run(lake, flat(spark, ticket(4, created=T0 + 3 * MINUTE)), RUN + 15 * MINUTE)
    compaction.compact(lake, DAY, RUN + timedelta(days=1))
    again = export.export_replay(lake, spark.createDataFrame([("a",)], "tenant_id string"), RUN, "csv")
    assert rows_by(again, "tenant_id", "status", "rows_affected", "export_type") == {"a": ("SUCCESS", 2, "INCREMENTAL")}
    replayed = L.lake_read(lake, "csv", day=DAY, run="20260105_091500")
    assert {(r.id, r.dialect.split(".")[0]) for r in replayed.collect()} == {(2, "tab"), (3, "tab")}


def test_a_replay_is_read_from_the_lake_once(spark, lake, monkeypatch):
    prepared(lake, "a")
    lake.marks.replace(marks(spark, a=T0))
    export.export_run(lake, flat(spark, ticket(1), ticket(2, created=T0 + MINUTE), ticket(3, created=T0 + 2 * MINUTE)), RUN)
    real = export.write_all

    def then_without_source(*args):
        outcomes = real(*args)
        for folder in lake.files.matches(f"{lake.data}/tenant_key=*/format=parquet"):
            lake.files.delete(folder)
        return outcomes

    monkeypatch.setattr(export, "write_all", then_without_source)
    again = export.export_replay(lake, spark.createDataFrame([("a",)], "tenant_id string"), RUN, "csv")
    assert rows_by(again, "tenant_id", "status", "rows_affected") == {"a": ("SUCCESS", 2)}
    assert lake.files.folders(f"{lake.root}/replay") == []


FORMATS = ["%Y-%m-%d %H:%M:%S", "%d %b %Y %H:%M:%S", "%B %d %Y, %I:%M:%S %p", "%Y-%j %H.%M.%S.%f", "at 'noon' %Y%m%dT%H%M%S", "%y#%m[%d]{%H}%M%S",
           "%%%Y%%%m%d%H%M%S", "YYYY-MM-DD HH24:MI:SS"]


@pytest.mark.parametrize("text", FORMATS)
def test_date_formats_write_and_read_back(spark, text):
    moments = [datetime(2001, 8, 2, 0, 0, 5), datetime(2024, 12, 31, 13, 59, 59), datetime(2020, 2, 29, 12, 0, 0)]
    frame = spark.createDataFrame([(m, text) for m in moments], "at timestamp_ntz, format string")
    pattern = date_pattern(F.col("format"))
    shown = frame.select("at", "format", F.call_function("date_format", "at", pattern).alias("shown"), valid_date_format(F.col("format")).alias("valid"))
    for row in shown.select("*", F.to_timestamp_ntz("shown", pattern).alias("back")).collect():
        assert row.valid and row.back == row["at"]
        if "%" in text:
            assert row.shown == row["at"].strftime(text)


def test_unknown_tokens_are_refused(spark):
    frame = spark.createDataFrame([("%Q",), ("%Y %",), ("\u0001%Y",), ("DD Mon",)], "format string")
    assert not any(row[0] for row in frame.select(valid_date_format(F.col("format"))).collect())
