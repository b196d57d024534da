"""CSV files whose rows are formed as lines of text: with a byte-order mark, or with texts quoted and numbers bare.

Spark's text writer takes the lines as they are, so the header is a row of its own that comes first in each file. For that
a file must be one slice of one tenant: slices of a tenant are dealt to different tasks, never two to the same.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.operators.joins import join_per_tenant
from desklake.operators.settings import SPARK_ENCODINGS, Dialect
from desklake.sources.files import Files, blocks
from desklake.sources.lake import csv_stem, folder_value

BYTE_ORDER_MARK = "\ufeff"
NO_TENANT = "__HIVE_DEFAULT_PARTITION__"  # the folder name of a missing partition value
MOVERS = 16


def write_tasks(rows: DataFrame, total: int, tenants: int, rows_per_file: int) -> int:
    """Tasks for files dealt by hash: four times as many as files or cores call for, so that few tasks get two files."""
    return 4 * max(math.ceil(total / rows_per_file), min(rows.sparkSession.sparkContext.defaultParallelism, tenants), 1)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def _folder_key(name: str) -> Column:
    """A partition value as the writer names its folder: missing and empty ones alike."""
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(NO_TENANT)).alias(name)


def csv_line(dialect: Dialect) -> Column:
    """The wide view's columns as one line. NULL is an empty field without quotes, save where every field is quoted."""
    separator = dialect.csv_options()["sep"]
    special = F.lit(rf'["\r\n{re.escape(separator)}]')
    fields = []
    for field in schemas.FLAT.fields:
        text = F.col(field.name).cast("string")
        if dialect.quoting == "all":
            shown, missing = _quoted(text), '""'
        elif dialect.quoting == "nonnumeric":
            shown, missing = text if isinstance(field.dataType, T.NumericType) else _quoted(text), ""
        else:
            shown, missing = F.when((text == "") | F.regexp_like(text, special), _quoted(text)).otherwise(text), ""
        fields += [F.lit(separator), F.coalesce(shown, F.lit(missing))]
    return F.concat(*fields[1:])


def header_line(dialect: Dialect) -> str:
    names = schemas.FLAT.names if dialect.quoting == "minimal" else [f'"{name}"' for name in schemas.FLAT.names]
    return (BYTE_ORDER_MARK if dialect.encoding == "utf-8-sig" else "") + dialect.csv_options()["sep"].join(names)


def encoded(line: Column, dialect: Dialect) -> Column:
    """The line in the bytes of the encoding, which the text writer passes on; characters it lacks become question marks."""
    name = SPARK_ENCODINGS[dialect.encoding]
    if name == "UTF-8":
        return line
    return F.encode(F.regexp_replace(line, r"[^\x{0}-\x{FF}]", "?"), name).cast("string")


def write_lines(rows: DataFrame, folder: str, dialect: Dialect, rows_per_file: int, counts: DataFrame | None, under: str) -> None:
    """Write rows that carry their partition values, then give the files their ``.csv`` names.

    ``counts`` holds every tenant of the rows, with its number of rows or more. A call that stopped before all files had
    their names is repeated like any other: it replaces its folders.
    """
    if counts is None:
        counts = rows.groupBy("tenant_key").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy(_folder_key("tenant_key")).agg(F.sum("n").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total, tenants = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        tasks = write_tasks(rows, total, tenants, rows_per_file)
        # Values that cannot be NULL keep the writer from sorting once more, which would part headers from their files.
        kept = [_folder_key(name) for name in schemas.LAKE_PARTITIONS]
        files = counts.select("tenant_key", F.ceil(F.greatest("n", F.lit(1)) / rows_per_file).alias("_files"))
        lines = rows.select(*kept, F.lit(1).alias("_kind"), F.col("created_at").alias("_moment"), "id",
                            encoded(csv_line(dialect), dialect).alias("value"))
        lines = join_per_tenant(lines, files, "tenant_key", "left", bound=counts).withColumn("_slice", F.pmod(
            F.xxhash64("id"), F.coalesce("_files", F.raise_error(F.lit("a tenant without a count")).cast("bigint"))))
        heads = rows.select(*kept).distinct().join(files, "tenant_key").select(
            *schemas.LAKE_PARTITIONS, F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_moment"),
            F.lit(None).cast("bigint").alias("id"), F.lit(header_line(dialect)).alias("value"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_files") - 1)).alias("_slice"))
        # A tenant has at most half as many slices as there are tasks (or one), so they come to different ones.
        task = F.pmod(F.pmod(F.xxhash64("tenant_key"), F.lit(tasks)) + F.col("_slice"), F.lit(tasks)).cast("int")
        (lines.select(*heads.columns).unionAll(heads).repartitionById(tasks, task)
         .sortWithinPartitions(*schemas.LAKE_PARTITIONS, "_kind", "_moment", "id").select(*schemas.LAKE_PARTITIONS, "value")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n")
         .partitionBy(*schemas.LAKE_PARTITIONS).text(folder))
        _name_files(rows, folder, dialect, counts, under)
    finally:
        counts.unpersist()


def _name_files(rows: DataFrame, folder: str, dialect: Dialect, counts: DataFrame, under: str) -> None:
    files = Files(rows.sparkSession)

    def rename(tenant: str) -> None:
        for path in files.matches(f"{folder}/tenant_key={tenant}/format={V.CSV}/dialect={csv_stem(dialect)}.*/{under}/*.txt"):
            files.move(path, f"{path.removesuffix('.txt')}.csv")

    tenants = counts.select(folder_value(F.col("tenant_key")).alias("name"))
    with ThreadPoolExecutor(MOVERS) as pool:
        for block in blocks(row.name for row in tenants.toLocalIterator()):
            list(pool.map(rename, block))
