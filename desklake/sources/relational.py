"""Reading the source tables: the stored wide view, or tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from desklake import vocabulary as V
from desklake.operators.snapshot import require_tables
from desklake.sources.lake import Lake


def read_flat(lake: Lake) -> DataFrame:
    """The whole current wide view, sorted by tenant and id."""
    require_tables({V.FLAT_VIEW: lake.snapshot})
    return lake.snapshot.read().orderBy("tenant_id", "id")


def jdbc_options(url: str, table: str, partition_column: str = "id", lower: int = 0, upper: int = 0,
                 partitions: int = 1, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options for a table. With several partitions, each task reads its own range of the column.

    ``lower`` and ``upper`` only place the ranges; rows beyond them are read by the outermost tasks.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partitions > 1:
        if upper <= lower:
            raise ValueError("several partitions need lower < upper")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A database table; filters and column selections are pushed into the database."""
    return spark.read.format("jdbc").options(**options).load()
