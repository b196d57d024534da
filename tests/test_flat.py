from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from builders import MINUTE, T0, flat, rows_by, ticket, tickets, users
from desklake.functions.clock import padded_name
from desklake.functions.names import matches_any, slug
from desklake.functions.numbers import exact_sum, format_bytes
from desklake.operators.flat import FLAT_COLUMNS
from desklake.plans import tickets as reports


def test_boundaries_of_service_level(spark):
    due = T0 + 60 * MINUTE
    rows = [ticket(1, finish=due, status="Closed"), ticket(2, finish=due + timedelta(microseconds=1), status="Closed"), ticket(3)]
    got = rows_by(flat(spark, *rows, as_of=due), "id", "sla_status", "sla_breach_minutes")
    assert got[1] == ("Within SLA", 0.0)
    assert got[2][0] == "SLA Breached" and got[2][1] > 0
    assert got[3] == ("On Track", 0.0)
    late = rows_by(flat(spark, ticket(3), as_of=due + timedelta(seconds=1)), "id", "sla_status")
    assert late[3] == "SLA At Risk"


def test_no_agreement_and_open_ticket(spark):
    got = rows_by(flat(spark, ticket(1, coverage=None), ticket(2, coverage=0)), "id",
                  "sla_status", "sla_deadline", "sla_breach_minutes", "duration_minutes", "finish_year", "finish_month", "finish_date")
    assert got[1] == got[2] == ("No SLA", None, None, 60.0, None, None, None)


def test_breach_is_negative_inside(spark):
    got = rows_by(flat(spark, ticket(1, finish=T0 + 45 * MINUTE)), "id", "sla_breach_minutes", "duration_minutes", "finish_date")
    assert got[1] == (-15.0, 45.0, "2026-01-04")


def test_calendar_columns(spark):
    row = flat(spark, ticket(1)).first()
    assert (row.created_day_of_week, row.created_day_name, row.created_month_name) == (0, "Sunday   ", "January  ")
    assert (row.created_year, row.created_month, row.created_day, row.created_hour) == (2026, 1, 4, 10)
    assert (row.created_year_month, row.created_date) == ("2026-01", "2026-01-04")


def test_tickets_without_known_requester_stay(spark):
    frame = flat(spark, ticket(1), ticket(2, requester=None), ticket(3, requester=99))
    assert frame.columns == FLAT_COLUMNS
    assert rows_by(frame, "id", "requester_name") == {1: "Ana", 2: None, 3: None}


def test_top_requesters_break_ties_and_keep_null(spark):
    people = users(spark, *[(i, f"user{i:02d}") for i in range(1, 13)])
    rows = [ticket(i, requester=i) for i in range(1, 13)] + [ticket(100, requester=None), ticket(101, requester=77)]
    got = reports.top_requesters(tickets(spark, *rows), people, T0 + 61 * MINUTE).collect()
    assert len(got) == 10
    assert (got[0].requester_name, got[0].active_tickets, got[0].sla_violations) == (None, 2, 2)
    assert [r.requester_name for r in got[1:]] == [f"user{i:02d}" for i in range(1, 10)]


def test_two_ids_with_one_name_are_one_requester(spark):
    people = users(spark, (1, "Ana"), (2, "Ana"))
    rows = [ticket(1, requester=1, created=T0), ticket(2, requester=2, created=T0 + 30 * MINUTE)]
    got = reports.top_requesters(tickets(spark, *rows), people, T0 + 60 * MINUTE).collect()
    assert [(r.requester_name, r.active_tickets, r.avg_duration_minutes) for r in got] == [("Ana", 2, 45.0)]


def test_name_search_and_slug(spark):
    names = spark.createDataFrame([("New Tenant Ltd",), ("NewTech",), ("Old",)], "name string")
    assert {r.name for r in names.where(matches_any(F.col("name"), ["new"])).collect()} == {"New Tenant Ltd", "NewTech"}
    odd = spark.createDataFrame([("Empresa  Ção & X!",), ("--a__b--",), ("x" * 60,)], "name string")
    assert [r[0] for r in odd.select(slug(F.col("name"))).collect()] == ["empresa-o-x", "a-b", "x" * 50]


@pytest.mark.parametrize("size,text", [(0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10485247, "10239 kB"),
                                       (10485248, "10 MB"), (5 * 1024 ** 4, "5120 GB")])
def test_size_text(spark, size, text):
    assert spark.range(1).select(format_bytes(F.lit(size).cast("bigint"))).first()[0] == text


def test_names_of_days_and_months(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1999-12-20', DATE'2001-01-10')) AS day").select(F.col("day").cast("timestamp_ntz").alias("at"))
    days = days.unionAll(spark.createDataFrame([(None,)], "at timestamp_ntz"))
    for pattern in ("EEEE", "MMMM"):
        assert days.where(~padded_name(F.col("at"), pattern).eqNullSafe(F.rpad(F.date_format("at", pattern), 9, " "))).count() == 0


def test_sums_beyond_a_bigint(spark):
    values = [2 ** 63 - 1, 2 ** 63 - 1, -(2 ** 63), -(2 ** 63), -(2 ** 63), -1, 1, 0, 4194303, 4194304, -4194305]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    assert frame.agg(exact_sum(F.col("v"))).first()[0] == str(sum(values))
    assert frame.where("v > 4194304").agg(exact_sum(F.col("v"))).first()[0] == str(2 ** 64 - 2)
