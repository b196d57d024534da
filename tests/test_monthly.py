from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from builders import MINUTE, T0, ticket, tickets, users
from desklake import schemas
from desklake.operators import snapshot
from desklake.operators.flat import tickets_flat

MAY, JUNE, JULY = (datetime(2025, month, 10, 8, 0) for month in (5, 6, 7))
DONE = timedelta(hours=5)
AS_OF = datetime(2025, 8, 1)


def closed(id, created, **more):
    return ticket(id, created=created, finish=created + DONE if created else JULY, status="Closed", **more)


def versions(lake):
    rows = lake.snapshot.versions().orderBy("version").collect()
    return [(row.version, row.months, row.months_rewritten, row.total_rows) for row in rows]


def same_as_view(spark, lake, rows, people, as_of):
    want = tickets_flat(tickets(spark, *rows), people, as_of).collect()
    return sorted(map(str, lake.snapshot.read().collect())) == sorted(map(str, want))


def test_only_months_that_differ_are_written(spark, lake):
    people = users(spark, (1, "Ana"), (2, "Bo"))
    rows = [closed(1, MAY), closed(2, JUNE, requester=2), ticket(3, created=JULY), closed(4, None)]
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r1")
    assert versions(lake) == [(1, 4, 4, 4)]
    # The clock moves on: only the month of the open ticket follows it.
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF + 5 * MINUTE, "r2")
    assert versions(lake)[-1] == (2, 4, 1, 4) and same_as_view(spark, lake, rows, people, AS_OF + 5 * MINUTE)
    # A changed text, and a ticket that moves to another month.
    rows[0] = closed(1, MAY, title="other")
    rows[3] = closed(4, JUNE)
    rows[2] = closed(3, JULY)
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r3")
    assert versions(lake)[-1] == (3, 3, 3, 4) and same_as_view(spark, lake, rows, people, AS_OF)
    # A requester with another name, and nothing else.
    people = users(spark, (1, "Ana"), (2, "Beatriz"))
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r4")
    assert versions(lake)[-1] == (4, 3, 1, 4) and same_as_view(spark, lake, rows, people, AS_OF)
    # Nothing at all, then a requester that leaves, then everything on request.
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r5")
    people = users(spark, (1, "Ana"))
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r6")
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r7", full=True)
    assert [made[2] for made in versions(lake)[-3:]] == [0, 1, 3] and same_as_view(spark, lake, rows, people, AS_OF)


def test_old_versions_go_but_not_the_months_in_use(spark, lake):
    people, rows = users(spark), [closed(1, MAY), closed(2, JUNE), ticket(3, created=JULY)]
    for number in range(4):
        snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF + number * MINUTE, f"r{number}", keep=2)
    assert [made[0] for made in versions(lake)] == [3, 4]
    folders = lake.files.folders(lake.snapshot.path)
    assert folders == [f"v={n:010d}" for n in (1, 3, 4)], "the second held nothing that is still named"
    assert lake.files.folders(f"{lake.snapshot.path}/{folders[0]}") == ["month=2025-05", "month=2025-06"]
    assert same_as_view(spark, lake, rows, people, AS_OF + 3 * MINUTE)
    snapshot.refresh_flat(lake, tickets(spark, *rows), people, AS_OF, "r9", keep=1, full=True)
    assert lake.files.folders(lake.snapshot.path) == [f"v={5:010d}"]


def test_id_that_stands_in_a_carried_month_is_refused(spark, lake):
    people = users(spark)
    snapshot.refresh_flat(lake, tickets(spark, closed(1, MAY)), people, AS_OF, "r1")
    with pytest.raises(ValueError, match="repeated"):
        snapshot.refresh_flat(lake, tickets(spark, closed(1, MAY), closed(1, JUNE)), people, AS_OF, "r2")
    assert versions(lake) == [(1, 1, 1, 1)] and lake.snapshot.read().count() == 1
    # The refused folder is passed over and goes with the next refresh that is committed.
    snapshot.refresh_flat(lake, tickets(spark, closed(1, MAY), closed(2, JUNE)), people, AS_OF, "r3")
    assert lake.files.folders(lake.snapshot.path) == [f"v={n:010d}" for n in (1, 3)]


def test_empty_view_and_return(spark, lake):
    none = spark.createDataFrame([], schemas.TICKETS)
    snapshot.refresh_flat(lake, none, users(spark), AS_OF, "r1")
    stats = snapshot.snapshot_stats(lake).first()
    assert lake.snapshot.read().count() == 0 and (stats.files, stats.total_rows, stats.is_populated) == (0, 0, False)
    snapshot.refresh_flat(lake, tickets(spark, closed(1, MAY)), users(spark), AS_OF, "r2")
    snapshot.refresh_flat(lake, none, users(spark), AS_OF, "r3")
    assert lake.snapshot.read().count() == 0 and [made[0] for made in versions(lake)] == [2]


def test_scan_of_stale_months_is_bounded(spark, lake):
    path = f"{lake.root}/tickets"
    tickets(spark, closed(1, MAY), closed(2, JUNE), closed(3, JULY), closed(4, None)).write.parquet(path)
    source = spark.read.schema(schemas.TICKETS).parquet(path)
    kept = source.where(snapshot.in_months(F.col("created_at"), {"2025-05", "2025-06", "none"}))
    assert sorted(row.id for row in kept.collect()) == [1, 2, 4]
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in text and "GreaterThanOrEqual(created_at,2025-05-01T00:00)" in text
    assert source.where(snapshot.in_months(F.col("created_at"), set())).count() == 0


def test_registered_table_prunes_months(spark, lake):
    rows = [closed(1, MAY), closed(2, JUNE), closed(3, None)]
    snapshot.refresh_flat(lake, tickets(spark, *rows), users(spark), AS_OF, "r1")
    snapshot.analyze_snapshot(lake, "monthly_view")
    frame = spark.table("monthly_view").where("created_year_month = '2025-06'").select("id")
    assert [row.id for row in frame.collect()] == [2] and "PartitionFilters: [isnotnull(created_year_month" in frame._jdf.queryExecution().executedPlan().toString()
    assert [row.id for row in spark.table("monthly_view").where("created_year_month IS NULL").collect()] == [3]
    spark.sql("DROP TABLE monthly_view")
    assert lake.snapshot.read().count() == 3


def test_a_first_refresh_reads_the_source_once_in_full(spark, lake, monkeypatch):
    rows, people = [closed(1, MAY), closed(2, MAY, title=None), ticket(3, created=JULY), closed(4, None)], users(spark)
    source, real = tickets(spark, *rows), snapshot.month_prints
    want = sorted(real(source).collect())

    def from_stored_rows_alone(frame, *more):
        assert set(frame.columns) == {"finish_time", "_print", "month"}, "the source was read for fingerprints"
        return real(frame, *more)

    monkeypatch.setattr(snapshot, "month_prints", from_stored_rows_alone)
    snapshot.refresh_flat(lake, source, people, AS_OF, "r1")
    stored = lake.snapshot.months().select("month", "rows", "open_rows", "print")
    assert sorted(stored.collect()) == want and same_as_view(spark, lake, rows, people, AS_OF)
    # The next refresh compares the source with them.
    monkeypatch.setattr(snapshot, "month_prints", real)
    snapshot.refresh_flat(lake, source, people, AS_OF + MINUTE, "r2")
    assert versions(lake)[-1] == (2, 3, 1, 4)
