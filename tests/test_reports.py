from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from builders import tenants
from desklake.operators import quality
from desklake.plans import access, alerts, runlog

NOW = datetime(2026, 1, 31)


def log(spark, *rows):
    """Rows of (minutes before NOW, job, status, tenant)."""
    return spark.createDataFrame(
        [(i, NOW - timedelta(minutes=m), "export", s, 10, 1.0, job, t, "AZURE_DATALAKE", "parquet", 1)
         for i, (m, job, s, t) in enumerate(rows)],
        """id bigint, refresh_timestamp timestamp_ntz, view_name string, status string, rows_affected bigint,
        duration_seconds double, job_id string, tenant_id string, export_destination string, file_format string, files_created int""")


def test_rows_without_tenant_count_only_by_format(spark):
    runs = log(spark, (1, "j", "SUCCESS", "a"), (2, "j", "ERROR", None), (3, "j", "SUCCESS", "gone"))
    names = tenants(spark, a="A")
    assert {r.tenant_id for r in runlog.export_stats_by_tenant(runs, names).collect()} == {"a", "gone"}
    by_format = {r.tenant_id: (r.tenant_name, r.failed_exports) for r in runlog.export_stats_by_format(runs, names).collect()}
    assert by_format == {"a": ("A", 0), None: (None, 1), "gone": (None, 0)}


@pytest.mark.parametrize("partitions", [1, 3, 7, None])
def test_streaks_equal_a_plain_scan(spark, partitions):
    outcome = lambda job, i: "FAILED" if (i * 7919 + len(job)) % 11 < 7 else "SUCCESS"
    runs = [(i, job, outcome(job, i), None) for job in ("hot", "b", "c") for i in range(700 if job == "hot" else 20)]
    runs += [(m, "always", "ERROR", None) for m in range(300)] + [(1, "never", "SUCCESS", None)]
    frame = log(spark, *runs)
    got = {(r.job_id, r.failures, r.first_failure, r.last_failure) for r in alerts.failure_streaks(frame, partitions=partitions).collect()}
    plain = frame.toPandas().sort_values(["job_id", "refresh_timestamp", "id"])
    plain["failed"] = plain.status != "SUCCESS"
    plain["island"] = (~plain.failed).groupby(plain.job_id).cumsum()
    want = {(job, len(g), g.refresh_timestamp.iloc[0].to_pydatetime(), g.refresh_timestamp.iloc[-1].to_pydatetime())
            for (job, _), g in plain[plain.failed].groupby(["job_id", "island"]) if len(g) >= 3}
    assert got == want and ("always", 300) in {(j, n) for j, n, *_ in got}


def test_small_batches_carry_the_open_stretch():
    rows = pd.DataFrame({"job_id": ["a"] * 5 + ["b"] * 2, "refresh_timestamp": pd.date_range("2026-01-01", periods=7),
                         "id": range(7), "failed": [True, True, True, False, True, True, True]})
    for size in (1, 2, 7):
        parts = [rows.iloc[i:i + size] for i in range(0, 7, size)]
        got = pd.concat(list(alerts._pieces(iter(parts), 1)))
        assert list(zip(got.job_id, got.runs, got.edge)) == [("a", 3, True), ("a", 1, False), ("b", 2, True)]


def test_growth_alert_needs_the_day_before(spark):
    days = [("2026-01-01", 100), ("2026-01-02", 60), ("2026-01-04", 900)]
    files = spark.createDataFrame(days, "day string, size_bytes bigint").withColumn("day", F.to_date("day"))
    got = alerts.growth_alerts(files).collect()
    assert [(str(r.day), r.previous_bytes, r.growth) for r in got] == [("2026-01-02", 100, 0.6)]


def test_access_alerts(spark):
    rows = [(NOW, "GetBlob", 200, "busy")] * 300 + [(NOW, "GetBlob", 403, "bad")] + [(NOW, "GetBlob", 200, f"ip{i}") for i in range(40)]
    frame = spark.createDataFrame(rows, "time_generated timestamp_ntz, operation_name string, status_code int, caller_ip string")
    assert {r.caller_ip: (r.any_denied, r.high_volume) for r in access.access_alerts(frame).collect()} == {
        "busy": (False, True), "bad": (True, False)}


def test_quality(spark):
    frame = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", None), (None, "c")], "tenant_key string, tenant_id string")
    assert {tuple(r) for r in quality.isolation_breaches(frame).collect()} == {("a", "b", 1), ("c", None, 1), (None, "c", 1)}
    keys = quality.key_violations({"t": (frame, "tenant_key"), "empty": (frame.limit(0), "tenant_id")}).collect()
    assert [tuple(r) for r in keys] == [("empty", 0, 0, 0), ("t", 4, 1, 1)]
    assert {r.tenant_id for r in quality.drop_orphans(frame, tenants(spark, a="A", b="B")).collect()} == {"a", "b"}


def test_sql_names(spark):
    from builders import T0, flat, marks, settings, ticket, tickets
    from desklake.plans.views import register_views
    runs = log(spark, (1, "j", "SUCCESS", "a"), (2, "j", "ERROR", "a")).withColumns({
        "export_type": F.lit("COMPACTION"), "error_message": F.lit("e"), "task_id": F.lit("t"), "file_path": F.lit("p"),
        "files_deleted": F.lit(1), "duplicates_removed": F.lit(0)})
    names = register_views(tenants(spark, a="A"), tickets(spark, ticket(1)), flat(spark, ticket(1)), runs, marks(spark, a=T0),
                           settings(spark, ("a", ["csv"], {})), NOW)
    for name in names:
        assert spark.sql(f"SELECT * FROM {name}").count() >= 1, name
    assert spark.sql("SELECT tenant_id FROM vw_export_watermark_status WHERE hours_since_last_export > 1").count() == 1


def test_jdbc_options():
    from desklake.sources.relational import jdbc_options
    assert "numPartitions" not in jdbc_options("jdbc:x", "t")
    split = jdbc_options("jdbc:x", "t", lower=1, upper=100, partitions=4, user="u")
    assert (split["partitionColumn"], split["numPartitions"], split["user"]) == ("id", "4", "u")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partitions=4)
