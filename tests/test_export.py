import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import MINUTE, T0, flat, marks, rows_by, settings, ticket, users
from desklake.operators import export, runlog, snapshot
from desklake.operators.settings import Dialect
from desklake.operators.writer import lake_rows, lake_write, write_partitions
from desklake.sources import lake as L

RUN = datetime(2026, 1, 5, 9, 15, 0)


def prepared(lake, *tenant_ids, stored=None, known=None):
    ids = lake.spark.createDataFrame([(t,) for t in tenant_ids], "tenant_id string")
    L.register_tenants(lake, ids)
    if stored is not None:
        lake.settings.replace(stored)
    if known is not None:
        lake.marks.replace(known)
    return lake


def test_run_writes_each_format_by_run_date(spark, lake):
    prepared(lake, "a", "b", stored=settings(spark, ("a", ["parquet", "csv"], {})), known=marks(spark, a=T0, b=T0, c=T0))
    rows = flat(spark, ticket(1), ticket(2, created=T0 + MINUTE), ticket(3, tenant="b", created=T0 + MINUTE), ticket(4, tenant="c", created=T0 + MINUTE))
    done = export.export_run(lake, rows, RUN)
    assert sorted((r.tenant_id, r.file_format, r.status, r.rows_affected) for r in done.collect()) == [
        ("a", "csv", "SUCCESS", 1), ("a", "parquet", "SUCCESS", 1), ("b", "parquet", "SUCCESS", 1)]
    stored = L.lake_read(lake)
    assert rows_by(stored, "id", "tenant_key", "year", "month", "day", "run") == {
        2: ("a", "2026", "01", "05", "20260105_091500"), 3: ("b", "2026", "01", "05", "20260105_091500")}
    assert lake.files.matches(f"{lake.data}/tenant_key=a/format=csv/*/year=2026/month=01/day=05/run=20260105_091500/*.csv")
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0 + MINUTE, "b": T0 + MINUTE, "c": T0}


def test_nothing_new_leaves_no_trace(spark, lake):
    prepared(lake, "a", known=marks(spark, a=T0))
    assert export.export_run(lake, flat(spark, ticket(1)), RUN).count() == 0
    assert L.lake_read(lake).count() == 0 and L.scan_files(lake).count() == 0
    assert runlog.runlog_read(lake).count() == 0
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0}


def test_unsupported_format_does_not_stop_the_other(spark, lake):
    prepared(lake, "a", "b", "c", known=marks(spark, a=T0, b=T0, c=T0), stored=settings(
        spark, ("a", ["parquet", "json"], {}), ("b", ["json"], {}), ("c", ["csv"], {"csv_date_format": "%U"})))
    rows = flat(spark, *[ticket(i, tenant=t, created=T0 + MINUTE) for i, t in enumerate("abc")])
    done = rows_by(export.export_run(lake, rows, RUN).withColumn("k", F.concat("tenant_id", "file_format")), "k", "status", "rows_affected")
    assert done == {"aparquet": ("SUCCESS", 1), "ajson": ("ERROR", 0), "bjson": ("ERROR", 0), "ccsv": ("ERROR", 0)}
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0 + MINUTE, "b": T0, "c": T0}
    errors = runlog.runlog_read(lake).where("status = 'ERROR'")
    assert errors.count() == 3 and errors.where("error_message LIKE '%not supported%'").count() == 3


def test_repeated_run_replaces_its_files(spark, lake):
    prepared(lake, "a", known=marks(spark, a=T0))
    rows = flat(spark, ticket(1, created=T0 + MINUTE), ticket(2, created=T0 + MINUTE))
    for _ in range(2):
        export.export_run(lake, rows, RUN)
        lake.marks.replace(marks(spark, a=T0))
    assert L.lake_read(lake).count() == 2
    assert runlog.runlog_read(lake).count() == 1


def test_repeated_run_keeps_what_it_exported(spark, lake):
    prepared(lake, "a", "b", known=marks(spark, a=T0, b=T0))
    first, late = [ticket(1, created=T0 + MINUTE), ticket(2, tenant="b", created=T0 + MINUTE)], ticket(3, created=T0 + 2 * MINUTE)
    export.export_run(lake, flat(spark, *first), RUN)
    done = export.export_run(lake, flat(spark, *first, late), RUN)
    assert sorted((r.tenant_id, r.rows_affected) for r in done.collect()) == [("a", 1), ("a", 1), ("b", 1)]
    name = "20260105_091500"
    assert rows_by(L.lake_read(lake), "id", "run") == {1: name, 2: name, 3: f"{name}_2"}
    assert runlog.runlog_read(lake).agg(F.count("id"), F.sum("rows_affected")).first() == (3, 3)
    # Nothing is left to do: the stored results come back and nothing is written.
    again = export.export_run(lake, flat(spark, *first, late), RUN)
    assert sorted(again.collect()) == sorted(done.collect())
    assert L.lake_read(lake).count() == 3 and runlog.runlog_read(lake).count() == 3
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0 + 2 * MINUTE, "b": T0 + MINUTE}


def test_unfinished_run_is_completed_within_its_bounds(spark, lake):
    prepared(lake, "a", "b", known=marks(spark, a=T0, b=T0))
    first = [ticket(1, created=T0 + MINUTE), ticket(2, tenant="b", created=T0 + MINUTE)]
    export.export_run(lake, flat(spark, *first), RUN)
    lake.marks.replace(marks(spark, a=T0 + MINUTE, b=T0))  # the mark of b was not moved
    export.export_run(lake, flat(spark, *first, ticket(3, tenant="b", created=T0 + 2 * MINUTE)), RUN)
    name = "20260105_091500"
    assert rows_by(L.lake_read(lake), "id", "run") == {1: name, 2: name, 3: f"{name}_2"}
    assert runlog.runlog_read(lake).count() == 3


def test_run_that_stopped_before_its_results(spark, lake, monkeypatch):
    prepared(lake, "a", known=marks(spark, a=T0))
    rows = flat(spark, ticket(1, created=T0 + MINUTE))
    with monkeypatch.context() as broken:
        broken.setattr(export, "_finish", None)
        with pytest.raises(TypeError):
            export.export_run(lake, rows, RUN)
    assert runlog.runlog_read(lake).count() == 0
    done = export.export_run(lake, rows, RUN)
    assert [(r.tenant_id, r.rows_affected) for r in done.collect()] == [("a", 1)]
    assert L.lake_read(lake).count() == 1 and runlog.runlog_read(lake).count() == 1


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "lz4", "none"])
def test_parquet_codecs(spark, lake, codec):
    rows = flat(spark, ticket(1), ticket(2, tenant="b/c:d"))
    lake_write(rows, lake.data, Dialect("parquet", codec=codec), "2026-01-05", "r")
    back = L.lake_read(lake)
    assert sorted(back.select(*rows.columns).collect()) == sorted(rows.collect())
    assert {r.tenant_key for r in back.collect()} == {"a", "b/c:d"}
    assert L.lake_tenants(lake).count() == 2


@pytest.mark.parametrize("dialect,pattern", [
    (Dialect("csv"), "%Y-%m-%d %H:%M:%S"), (Dialect("csv", delimiter=";", encoding="iso-8859-1"), "%d/%m/%Y %H:%M:%S"),
    (Dialect("csv", delimiter="|", encoding="latin1"), "YYYY-MM-DD HH24:MI:SS"), (Dialect("csv", delimiter="\t", quoting="all"), "%Y-%m-%d %H:%M:%S"),
    (Dialect("csv", encoding="utf-8-sig"), "%d/%m/%y %H:%M:%S"), (Dialect("csv", delimiter="|", encoding="utf-8-sig", quoting="all"), "%Y-%m-%d %H:%M:%S"),
    (Dialect("csv", delimiter=";", quoting="nonnumeric"), "%Y-%m-%d %H:%M:%S"), (Dialect("csv", delimiter="\t", encoding="utf-8-sig", quoting="nonnumeric"), "%Y-%m-%d %H:%M:%S"),
    (Dialect("csv", encoding="latin1", quoting="nonnumeric"), "%Y-%m-%d %H:%M:%S")])
def test_csv_round_trip(spark, lake, dialect, pattern):
    titles = ["ação;x", "a,b", 'say "hi"', "two\nlines", " padded ", "tab\there", "back\\slash", "pipe|x"]
    rows = flat(spark, *[ticket(i, title=t) for i, t in enumerate(titles)])
    lake_write(rows, lake.data, dialect, "2026-01-05", "r", F.lit(pattern))
    back = L.lake_read(lake, "csv").select(*rows.columns)
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)


def first_bytes(lake):
    return {open(path.removeprefix("file:"), "rb").read() for path in lake.files.matches(f"{lake.data}/*/*/*/*/*/*/*/*.csv")}


def test_lines_start_with_header_and_mark(spark, lake):
    rows = flat(spark, *[ticket(i, tenant=f"t{i % 5}:x", title=f"ç {i}") for i in range(4000)], ticket(9000, tenant="", title=None))
    dialect = Dialect("csv", encoding="utf-8-sig", quoting="nonnumeric")
    write_partitions(lake_rows(rows, dialect, "2026-01-05", "r"), lake.data, dialect, rows_per_file=100)
    contents = first_bytes(lake)
    assert len(contents) == 41 and all(text.startswith(b'\xef\xbb\xbf"id","tenant_id","title"') for text in contents)
    assert all(text.count(b'"tenant_id"') == 1 for text in contents)
    back = L.lake_read(lake, "csv")
    assert sorted(back.select(*rows.columns).collect(), key=str) == sorted(rows.collect(), key=str)
    first = min(contents, key=len).decode("utf-8-sig").split("\n")[1]
    assert first.startswith('9000,"",,60,"agent","2026-01-04 10:00:00",,"Active",60.0,')


def test_lines_are_sorted_once(spark, lake):
    rows = flat(spark, *[ticket(i, tenant=f"t{i % 3}") for i in range(50)])
    lake_write(rows, lake.data, Dialect("csv", quoting="nonnumeric"), "2026-01-05", "r")
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsCount())]
    written = [text for text in plans if "InsertIntoHadoopFsRelationCommand" in text and "Text" in text][-1]
    above = re.split("ShuffleQueryStage|AQEShuffleRead|Exchange", written[written.index("WriteFiles"):])[0]
    assert len(re.findall(r"\bSort \(", above)) == 1, "one sort between the shuffle and the files"


def test_latin1_lines_replace_what_they_lack(spark, lake):
    lake_write(flat(spark, ticket(1, title="ação 漢")), lake.data, Dialect("csv", encoding="latin1", quoting="nonnumeric"), "2026-01-05", "r")
    assert "ação ?".encode("latin1") in first_bytes(lake).pop()
    assert rows_by(L.lake_read(lake, "csv"), "id", "title") == {1: "ação ?"}


@pytest.mark.parametrize("dialect", [Dialect("csv", delimiter=";"), Dialect("csv", encoding="utf-8-sig"), Dialect("csv", quoting="nonnumeric")])
def test_csv_keeps_null_and_empty_apart(spark, lake, dialect):
    rows = flat(spark, ticket(1, title=None), ticket(2, title=""))
    lake_write(rows, lake.data, dialect, "2026-01-05", "r")
    assert rows_by(L.lake_read(lake, "csv"), "id", "title") == {1: None, 2: ""}


def test_old_csv_files_stay_readable_after_settings_change(spark, lake):
    for run, dialect in (("1", Dialect("csv")), ("2", Dialect("csv", delimiter=";", encoding="iso-8859-1"))):
        lake_write(flat(spark, ticket(int(run), title="ç;,")), lake.data, dialect, "2026-01-05", run)
    assert rows_by(L.lake_read(lake, "csv"), "id", "title") == {1: "ç;,", 2: "ç;,"}


def test_full_export_and_reconciliation(spark, lake):
    prepared(lake, "a", "z")
    done = export.export_full(lake, flat(spark, ticket(1), ticket(2, created=T0 - MINUTE), ticket(3, tenant="b")), RUN)
    assert [(r.tenant_id, r.rows_affected, r.export_type) for r in done.collect()] == [("a", 2, "FULL")]
    assert done.first().file_path.endswith("/run=full_20260105_091500") and done.first().files_created == 1
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0}
    with pytest.raises(ValueError):
        export.export_full(lake, flat(spark, ticket(1)), RUN, "json")


def test_replay_of_a_failed_format(spark, lake):
    prepared(lake, "a", "b", known=marks(spark, a=T0, b=T0))
    rows = flat(spark, ticket(1, created=T0 + MINUTE), ticket(2, tenant="b", created=T0 + MINUTE))
    export.export_run(lake, rows, RUN)
    failed = spark.createDataFrame([("a", "csv")], "tenant_id string, file_format string")
    replayed = export.export_replay(lake, failed.union(failed.select(F.lit("none"), "file_format")), RUN, "csv")
    assert rows_by(replayed, "tenant_id", "status", "rows_affected", "files_created") == {"a": ("SUCCESS", 1, 1), "none": ("ERROR", 0, 0)}
    assert {r.id for r in L.lake_read(lake, "csv").collect()} == {1}
    assert rows_by(runlog.runlog_read(lake).where("view_name = 'export_replay'"), "tenant_id", "status") == {"a": "SUCCESS", "none": "ERROR"}


def test_combine(spark, lake):
    assert L.lake_combine(spark, f"{lake.root}/none").count() == 0
    for run in ("1", "2", "3"):
        lake_write(flat(spark, ticket(int(run))), lake.data, Dialect("parquet"), "2026-01-05", run)
    lake_write(flat(spark, ticket(9)), lake.data, Dialect("csv"), "2026-01-05", "4")
    assert L.lake_combine(spark, lake.data).count() == 3
    assert L.lake_combine(spark, lake.data, limit_files=2).count() == 2
    broken = lake.files.matches(f"{lake.data}/*/*/*/*/*/*/run=1/*.parquet")[0].removeprefix("file:")
    with open(broken, "wb") as file:
        file.write(b"not parquet")
    crc = broken.rsplit("/", 1)[0] + "/." + broken.rsplit("/", 1)[1] + ".crc"
    with open(crc, "wb") as file:
        file.write(b"")
    assert L.lake_combine(spark, lake.data, skip_corrupt=True).count() == 2


def test_external_table(spark, lake):
    prepared(lake, "a", "b")
    export.export_full(lake, flat(spark, ticket(1), ticket(2, tenant="b", status="Closed")), RUN)
    spark.sql("DROP TABLE IF EXISTS tickets_external")
    L.external_table(lake, "tickets_external")
    got = spark.sql("SELECT ticket_status, count(*) AS n FROM tickets_external WHERE month = '01' AND created_at >= '2026-01-01' GROUP BY 1")
    assert rows_by(got, "ticket_status", "n") == {"Active": 1, "Closed": 1}
    spark.sql("DROP TABLE tickets_external")


def test_snapshot_versions(spark, lake):
    with pytest.raises(ValueError, match="bi_tickets_flat"):
        snapshot.require_tables({"bi_tickets_flat": lake.snapshot})
    from builders import tickets
    people = users(spark)
    snapshot.refresh_flat(lake, tickets(spark, ticket(1)), people, T0, "r1")
    before = lake.snapshot.read()
    snapshot.refresh_flat(lake, tickets(spark, ticket(1), ticket(2)), people, T0, "r2")
    assert before.count() == 1 and lake.snapshot.read().count() == 2
    with pytest.raises(ValueError, match="repeated"):
        snapshot.refresh_flat(lake, tickets(spark, ticket(1), ticket(1)), people, T0, "r3")
    assert lake.snapshot.read().count() == 2
    log = runlog.runlog_read(lake).groupBy("view_name", "status").count()
    assert {(r[0], r[1]): r[2] for r in log.collect()} == {
        ("bi_tickets_flat", "SUCCESS"): 2, ("ALL_VIEWS", "SUCCESS"): 2, ("bi_tickets_flat", "FAILED"): 1}
    stats = snapshot.snapshot_stats(lake).first()
    assert stats.total_rows == 2 and stats.is_populated and stats.total_bytes > 0
    assert lake.snapshot.expire(keep=1) == 1 and lake.snapshot.read().count() == 2
    snapshot.analyze_snapshot(lake)
    assert spark.table("bi_tickets_flat").count() == 2
    spark.sql("DROP TABLE bi_tickets_flat")


def test_runlog_purge_and_old_layout(spark, lake):
    events = spark.createDataFrame([("v", "SUCCESS", 5)], "view_name string, status string, rows_affected bigint")
    for day in (1, 20):
        runlog.runlog_append(lake, runlog.log_rows(events, f"r{day}", datetime(2026, 1, day), "job"), f"r{day}")
    # A file of the first layout lacks the later columns.
    old = runlog.runlog_read(lake).limit(1).select("id", "refresh_timestamp", "view_name", "status", "rows_affected")
    old.write.parquet(f"{lake.log}/log_day=2026-01-21/run_id=old")
    assert rows_by(runlog.runlog_read(lake).where("files_created = 0").groupBy("file_format").count(), "file_format", "count") == {"parquet": 3}
    assert runlog.runlog_purge(lake, datetime(2026, 2, 5)) == 1
    assert runlog.runlog_read(lake).count() == 2
