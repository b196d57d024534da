"""Writing rows of many tenants into the lake in one job."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.formats import date_pattern
from desklake.operators.csv_lines import write_lines, write_tasks
from desklake.operators.joins import BROADCAST_ROWS, salted_join
from desklake.operators.settings import Dialect
from desklake.sources.lake import dialect_folder

# A CSV file with line breaks inside fields is read by one task, so files stay moderate.
ROWS_PER_FILE = 2_000_000


def lake_rows(rows: DataFrame, dialect: Dialect, day: str, run: str, date_format: Column | None = None,
              folder_of: str = "tenant_id") -> DataFrame:
    """Flat rows with their partition values. ``day`` is the run's date, not the ticket's."""
    year, month, date = day.split("-")
    formats = F.lit(V.DEFAULT_DATE_FORMAT) if date_format is None else date_format
    moments = {f.name for f in schemas.FLAT.fields if isinstance(f.dataType, T.TimestampNTZType)}
    as_text = dialect.file_format == V.CSV
    columns = [F.call_function("date_format", F.col(name), date_pattern(formats)).alias(name) if as_text and name in moments else F.col(name)
               for name in schemas.FLAT.names]
    return rows.select(
        *columns, F.col(folder_of).alias("tenant_key"), F.lit(dialect.file_format).alias("format"),
        dialect_folder(dialect, formats).alias("dialect"), F.lit(year).alias("year"), F.lit(month).alias("month"),
        F.lit(date).alias("day"), F.lit(run).alias("run"))


def spread(rows: DataFrame, rows_per_file: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows of the lake's layout, gathered for :func:`write_partitions`."""
    return gathered(rows, rows_per_file, counts).select(*schemas.LAKE.names)


def gathered(rows: DataFrame, rows_per_file: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows gathered, by tenant and a column ``_slice``, so that a small tenant is in one task and a large one in as many as it needs files.

    The number of files of a tenant follows from its row count, ``counts`` if given (an upper bound will do),
    so a tenant of any size is divided evenly and its neighbours are not cut up with it.
    """
    if counts is None:
        counts = rows.groupBy("tenant_key").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        large = F.col("n") > rows_per_file
        total, tenants, many = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(large)).first()
        files = F.lit(1)
        if many:
            split = counts.where(large).select("tenant_key", F.ceil(F.col("n") / rows_per_file).alias("_files"))
            if many > BROADCAST_ROWS:
                rows = salted_join(rows, split, "tenant_key", "left", "id")
            else:
                # At most ``many`` rows, which was just counted; frozen here as the counts are released.
                listed = rows.sparkSession.createDataFrame(split.collect(), split.schema)
                rows = rows.join(F.broadcast(listed), "tenant_key", "left")
            files = F.coalesce("_files", F.lit(1))
    finally:
        counts.unpersist()
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64("id"), files)).drop("_files")
    return sliced.repartition(write_tasks(rows, total, tenants, rows_per_file), "tenant_key", "_slice")


def write_partitions(rows: DataFrame, folder: str, dialect: Dialect, rows_per_file: int = ROWS_PER_FILE,
                     counts: DataFrame | None = None, under: str = "year=*/month=*/day=*/run=*", ready: bool = False) -> None:
    """Write rows that carry their partition values; a repeated run replaces exactly its own folders.

    ``under`` names the folders below a tenant's dialect that the rows go to, where the caller knows them. ``ready`` rows
    are :func:`gathered` already and are not shuffled again, save those that are formed as lines.
    """
    options = dialect.writer_options()
    if dialect.as_lines:
        write_lines(rows, folder, dialect, rows_per_file, counts, under)
        return
    ((rows.select(*schemas.LAKE.names) if ready else spread(rows, rows_per_file, counts))
     .sortWithinPartitions(*schemas.LAKE_PARTITIONS, "created_at", "id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file)
     .options(**options).partitionBy(*schemas.LAKE_PARTITIONS).format(dialect.file_format).save(folder))


def lake_write(rows: DataFrame, folder: str, dialect: Dialect, day: str, run: str, date_format: Column | None = None,
               counts: DataFrame | None = None) -> None:
    dialect.writer_options()  # refuse unsupported words before any job starts
    year, month, date = day.split("-")
    write_partitions(lake_rows(rows, dialect, day, run, date_format), folder, dialect, counts=counts,
                     under=f"year={year}/month={month}/day={date}/run={run}")
