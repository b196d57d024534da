"""Column helpers and stored intermediate tables shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from desklake.session import shared_dir

#: The six ASCII white-space characters, and runs of them.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of the frame is called so in any spelling."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII only take Spark's faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, separator: str = BLANK_RUN) -> Column:
    """The pieces between runs of separators; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def grams(hashes: Column, size: int) -> Column:
    """A hash for every ``size`` neighbouring elements of an array of hashes."""
    return F.when(F.size(hashes) >= size, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size),
        lambda i: F.xxhash64(*[hashes[i + j] for j in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def stored(frame: DataFrame, purpose: str, *partitions: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back; the folder goes when the driver ends."""
    spark = frame.sparkSession
    folder = shared_dir(spark, purpose)
    frame.write.partitionBy(*partitions).parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(frame.schema).parquet(folder)
