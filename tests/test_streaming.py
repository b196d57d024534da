from datetime import datetime

from builders import MINUTE, T0, marks, rows_by, ticket, tickets, users
from desklake.operators import runlog, snapshot
from desklake.sources import lake as L
from desklake.streaming.export_stream import stream_export


def drain(lake):
    stream_export(lake, f"{lake.root}/checkpoint").awaitTermination()


def test_each_refresh_is_exported_once(spark, lake):
    L.register_tenants(lake, spark.createDataFrame([("a",)], "tenant_id string"))
    lake.marks.replace(marks(spark, a=T0))
    people = users(spark)
    first = [ticket(1), ticket(2, created=T0 + MINUTE)]
    snapshot.refresh_flat(lake, tickets(spark, *first), people, datetime(2026, 1, 5, 9, 0), "r1")
    drain(lake)
    drain(lake)
    assert {r.id for r in L.lake_read(lake).collect()} == {2}
    # Two refreshes before the next drain: only the newest is exported.
    second = [*first, ticket(3, created=T0 + 2 * MINUTE)]
    snapshot.refresh_flat(lake, tickets(spark, *second), people, datetime(2026, 1, 5, 9, 15), "r2")
    snapshot.refresh_flat(lake, tickets(spark, *second, ticket(4, created=T0 + 3 * MINUTE)), people, datetime(2026, 1, 5, 9, 30), "r3")
    drain(lake)
    assert rows_by(L.lake_read(lake), "id", "run") == {2: "20260105_090000", 3: "20260105_093000", 4: "20260105_093000"}
    assert runlog.runlog_read(lake).where("view_name = 'export_tickets'").count() == 2
    assert rows_by(lake.marks.read(), "tenant_id", "last_exported_created_at") == {"a": T0 + 3 * MINUTE}


def test_two_refreshes_of_one_clock(spark, lake):
    L.register_tenants(lake, spark.createDataFrame([("a",)], "tenant_id string"))
    lake.marks.replace(marks(spark, a=T0))
    rows = [ticket(1, created=T0 + MINUTE), ticket(2, created=T0 + 2 * MINUTE)]
    for count in (1, 2):
        snapshot.refresh_flat(lake, tickets(spark, *rows[:count]), users(spark), datetime(2026, 1, 5, 9, 0), f"r{count}")
        drain(lake)
    assert rows_by(L.lake_read(lake), "id", "run") == {1: "20260105_090000", 2: "20260105_090000_2"}
