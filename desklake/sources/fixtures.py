"""The help-desk tables, derived lazily from the star-schema tables in one folder.

Each view is a plain projection, so filters and column pruning reach the Parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from desklake.functions.clock import add_minutes, as_date, clock

AS_OF_TICKETS = "2001-08-02 00:00:00"
AS_OF_LOG = "2024-01-31 00:00:00"

# The columns the views need. A declared schema saves the job that would read file footers to infer one.
COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_quantity double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def _pick(key: Column, choices: dict, other=None) -> Column:
    chosen = None
    for value, result in choices.items():
        test = key == value
        chosen = F.when(test, result) if chosen is None else chosen.when(test, result)
    return chosen if other is None else chosen.otherwise(other)


@dataclass
class HelpDesk:
    """Views over one test-data folder."""

    spark: SparkSession
    folder: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def tenants(self) -> DataFrame:
        return self._table("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))

    @cached_property
    def users(self) -> DataFrame:
        return (self._table("customer").where(F.col("c_custkey") % 20 != 0)
                .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))

    @cached_property
    def tickets(self) -> DataFrame:
        quantity = (self._table("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")))
        owner = self._table("customer").select("c_custkey", "c_nationkey")
        placed = self._table("orders")
        minute = F.col("o_orderkey") % 1440
        return (
            # Joined by customer last, so that a join with users, by the same key, needs no further shuffle.
            placed.join(quantity, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(owner, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("c_nationkey").cast("string").alias("tenant_id"),
                F.col("o_orderpriority").alias("title"),
                F.col("o_custkey").alias("requester_id"),
                F.concat(F.lit("agent_"), (F.col("o_orderkey") % 17).cast("string")).alias("assignee_name"),
                _pick(F.col("o_orderpriority"), {
                    "1-URGENT": 14400, "2-HIGH": 43200, "3-MEDIUM": 86400, "4-NOT SPECIFIED": 0,
                }).alias("coverage_time"),
                _pick(F.col("o_orderstatus"), {"F": "Closed", "O": "Active"}, "Pending").alias("status"),
                add_minutes(F.col("o_orderdate"), minute.cast("int")).alias("created_at"),
                F.when(F.col("o_orderstatus") != "O",
                       add_minutes(F.col("o_orderdate"), (minute + F.col("q") * 240).cast("int"))).alias("finish_time"),
            ))

    @cached_property
    def runlog(self) -> DataFrame:
        n = F.col("event_id")
        quarter = n % 4
        failed = F.col("event_type") == "error"
        return self._table("events").select(
            n.alias("id"),
            F.col("ts").alias("refresh_timestamp"),
            _pick(quarter, {0: "bi_tickets_flat", 1: "ALL_VIEWS", 2: "export_tickets"}, "lake_compaction").alias("view_name"),
            F.when(~failed, "SUCCESS").when(quarter < 2, "FAILED").otherwise("ERROR").alias("status"),
            (n % 1000).cast("bigint").alias("rows_affected"),
            F.col("value").alias("duration_seconds"),
            F.when(failed, F.concat(F.lit("boom "), (n % 7).cast("string"))).alias("error_message"),
            F.concat(F.lit("job_"), quarter.cast("string")).alias("job_id"),
            F.concat(F.lit("task_"), (n % 3).cast("string")).alias("task_id"),
            F.when(quarter >= 2, (F.col("user_id") % 30).cast("string")).alias("tenant_id"),
            F.when(quarter == 3, "COMPACTION").when(n % 8 == 2, "FULL").when(quarter == 2, "INCREMENTAL").alias("export_type"),
            F.when(n % 3 == 0, "csv").otherwise("parquet").alias("file_format"),
            F.lit(1).alias("files_created"),
            (n % 5).cast("int").alias("files_deleted"),
            (n % 11).cast("bigint").alias("duplicates_removed"),
            F.when(quarter == 2, "AZURE_DATALAKE").alias("export_destination"),
            F.concat(F.lit("lake/"), n.cast("string")).alias("file_path"),
        )

    @cached_property
    def marks(self) -> DataFrame:
        tenant_no = F.col("tenant_id").cast("int")
        return (
            self.tickets.where((F.col("created_at") < clock("2001-01-01 00:00:00")) & (tenant_no % 5 != 0))
            .groupBy("tenant_id")
            .agg(F.max("created_at").alias("last_exported_created_at"), F.count(F.lit(1)).alias("rows_exported"))
            .select(
                "tenant_id", "last_exported_created_at",
                F.timestamp_add("HOUR", tenant_no, clock("2001-08-01 00:00:00")).alias("last_export_success_at"),
                "rows_exported", F.lit("INCREMENTAL").alias("export_type"), F.lit(None).cast("string").alias("notes"),
            ))

    @cached_property
    def settings(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self._table("nation").where(n % 5 != 0).select(
            n.cast("string").alias("tenant_id"),
            _pick(n % 5, {
                1: F.array(F.lit("parquet")), 2: F.array(F.lit("parquet"), F.lit("csv")),
                3: F.array().cast("array<string>"),
            }, F.array(F.lit("csv"))).alias("export_formats"),
            F.when(n % 2 == 0, ";").otherwise(",").alias("csv_delimiter"),
            F.when(n % 3 == 0, "iso-8859-1").otherwise("utf-8").alias("csv_encoding"),
            F.lit("minimal").alias("csv_quoting"),
            F.lit("%Y-%m-%d %H:%M:%S").alias("csv_date_format"),
            F.lit("snappy").alias("parquet_compression"),
            F.when(n % 7 != 0, n % 11 != 0).alias("active"),
        )

    @cached_property
    def access_log(self) -> DataFrame:
        return self._table("events").select(
            F.col("ts").alias("time_generated"),
            _pick(F.col("event_type"), {"click": "GetBlob", "view": "ListBlobs"}, "PutBlob").alias("operation_name"),
            F.when(F.col("event_type") == "error", 403).otherwise(200).alias("status_code"),
            F.col("value").alias("duration_ms"),
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 50).cast("string")).alias("caller_ip"),
            F.lit("OAuth").alias("authentication_type"),
            F.concat(F.lit("https://acct.dfs.example.net/tickets-data/tenant_"),
                     (F.col("user_id") % 25).cast("string"), F.lit("-ab/tickets/x.parquet")).alias("uri"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        n, owner = F.col("event_id"), (F.col("user_id") % 25).cast("string")
        file_format = F.when(n % 3 == 0, "csv").otherwise("parquet")
        return self._table("events").select(
            F.concat(F.lit("tenant_key="), owner, F.lit("/format="), file_format, F.lit("/f"), n.cast("string")).alias("path"),
            owner.alias("tenant_id"),
            as_date(F.col("ts")).alias("day"),
            file_format.alias("format"),
            (n % 4096).cast("bigint").alias("size_bytes"),
            F.timestamp_add("DAY", -((n % 40) * 25).cast("int"), F.col("ts")).alias("modified_at"),
            F.when(n % 9 == 0, "superseded").alias("compaction_status"),
        )
