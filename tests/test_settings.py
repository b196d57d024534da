import pytest
from pyspark.sql import functions as F

from builders import T0, rows_by, settings, tenants
from desklake.functions.formats import date_pattern, valid_date_format
from desklake.operators import settings as S


def test_inactive_falls_back_to_defaults(spark):
    stored = settings(spark, ("a", ["csv"], {"csv_delimiter": ";", "active": False}), ("b", [], {}), ("n", ["csv"], {"active": None}))
    wanted = spark.createDataFrame([("a",), ("b",), ("n",), ("x",)], "tenant_id string")
    got = rows_by(S.export_config(wanted, stored), "tenant_id", "export_formats", "csv_delimiter", "csv_encoding", "parquet_compression")
    default = (["parquet"], ",", "utf-8", "snappy")
    assert got["a"] == default and got["x"] == default and got["n"] == default
    assert got["b"][0] == []


def test_empty_list_exports_parquet_and_counts_as_multi(spark):
    stored = settings(spark, ("a", [], {}), ("b", ["csv"], {}), ("c", ["csv"], {"active": False}))
    config = S.export_config(stored.select("tenant_id"), stored)
    assert rows_by(S.dialect_columns(config), "tenant_id", "format") == {"a": "parquet", "b": "csv", "c": "parquet"}
    summary = S.formats_summary(tenants(spark, a="A", b="B", c="C", d="D"), stored)
    assert rows_by(summary, "format_strategy", "tenants_count", "formats_used") == {
        "default": (1, ["parquet"]), "multi": (1, [None]), "single": (1, ["csv"])}


def test_enable_csv_twice_adds_it_once(spark):
    stored = settings(spark, ("a", ["parquet"], {"active": False, "notes": "n"}))
    change = spark.createDataFrame([("a", ";"), ("new", None)], "tenant_id string, csv_delimiter string")
    once = S.settings_enable_csv(stored, change, T0)
    twice = rows_by(S.settings_enable_csv(once, change, T0), "tenant_id", "export_formats", "active", "csv_delimiter", "notes", "updated_at")
    assert twice["a"] == (["parquet", "csv"], True, ";",
                          "n | CSV enabled at 2026-01-04 10:00:00 | CSV enabled at 2026-01-04 10:00:00", T0)
    assert twice["new"][:3] == (["parquet", "csv"], True, ",")


def test_enable_csv_ignores_unknown_tenants(spark):
    change = spark.createDataFrame([("a",), ("ghost",)], "tenant_id string")
    got = S.settings_enable_csv(settings(spark, ("b", ["csv"], {})), change, T0, tenants=tenants(spark, a="A", b="B"))
    assert {r.tenant_id for r in got.collect()} == {"a", "b"}


def test_disable_csv(spark):
    stored = settings(spark, ("a", ["csv"], {}), ("b", ["parquet", "csv"], {}))
    change = spark.createDataFrame([("a",), ("ghost",)], "tenant_id string")
    got = rows_by(S.settings_disable_csv(stored, change, T0), "tenant_id", "export_formats")
    assert got == {"a": [], "b": ["parquet", "csv"]}
    assert rows_by(S.change_outcomes(change, stored), "tenant_id", "done") == {"a": True, "ghost": False}


def test_writer_options():
    assert S.Dialect("parquet", codec="lz4").writer_options() == {"compression": "lz4_raw"}
    assert S.Dialect("parquet", codec="none").writer_options() == {"compression": "uncompressed"}
    assert S.Dialect("csv", delimiter="\\t").writer_options()["sep"] == "\t"
    assert S.Dialect("csv", encoding="latin1").writer_options()["encoding"] == "ISO-8859-1"
    assert S.Dialect("csv", quoting="all").writer_options()["quoteAll"] == "true"


@pytest.mark.parametrize("dialect", [
    S.Dialect("json"), S.Dialect("parquet", codec="brotli"), S.Dialect("csv", delimiter="#"),
    S.Dialect("csv", encoding="utf-16"), S.Dialect("csv", quoting="none")])
def test_unsupported_words_are_refused(dialect):
    with pytest.raises(ValueError, match="not supported"):
        dialect.writer_options()


@pytest.mark.parametrize("stored,pattern,valid", [
    ("%Y-%m-%d %H:%M:%S", "yyyy-MM-dd HH:mm:ss", True), ("YYYY-MM-DD HH24:MI:SS", "yyyy-MM-dd HH:mm:ss", True),
    ("%d/%m/%Y", "dd/MM/yyyy", True), ("%Y-%j", "yyyy-DDD", True), ("week %W", None, False)])
def test_date_formats(spark, stored, pattern, valid):
    row = spark.createDataFrame([(stored,)], "f string").select(date_pattern(F.col("f")), valid_date_format(F.col("f"))).first()
    assert row[1] is valid
    if valid:
        assert row[0] == pattern


def test_violations(spark):
    stored = settings(spark, ("a", ["parquet", "xml"], {"csv_delimiter": "#"}), ("b", [], {"parquet_compression": "lzo"}), ("c", ["csv"], {}))
    assert sorted(map(tuple, S.settings_violations(stored).collect())) == [
        ("a", "csv_delimiter"), ("a", "export_formats"), ("b", "parquet_compression")]


def test_bootstrap_inserts_only_absent(spark):
    stored = settings(spark, ("a", ["csv"], {}))
    got = rows_by(S.settings_bootstrap(tenants(spark, a="A", b="B"), stored, T0), "tenant_id", "export_formats", "created_by")
    assert got == {"a": (["csv"], None), "b": (["parquet"], "desklake")}


def test_a_tenant_named_twice_keeps_one_row(spark):
    changes = spark.createDataFrame([("x", ";"), ("x", "|"), ("y", ";"), ("y", ";")], "tenant_id string, csv_delimiter string")
    once = S.settings_enable_csv(settings(spark, ("old", [], {})).where("tenant_id <> 'old'"), changes, T0)
    assert sorted((r.tenant_id, r.csv_delimiter) for r in once.collect()) == [("x", "|"), ("y", ";")]
    assert S.settings_enable_csv(once, changes, T0).count() == 2
    assert S.settings_disable_csv(once, changes, T0).count() == 2
