"""The file lake: where it lies and how its files are found and read."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.formats import date_pattern
from desklake.operators.settings import Dialect
from desklake.sources.files import Files
from desklake.sources.monthly import MonthlyTable
from desklake.sources.versions import VersionedTable

# Names of delimiters in folder names.
DELIMITER_WORDS = {",": "comma", ";": "semicolon", "|": "pipe", "\t": "tab"}

# The reader hands an unquoted empty field over as the null word and a quoted one as the empty word; two
# different words keep NULL and "" apart. With every field quoted the file itself cannot tell them apart,
# and both are read as NULL.
EMPTY_WORDS = {"minimal": {"nullValue": "\u0001", "emptyValue": ""}, "nonnumeric": {"nullValue": "\u0001", "emptyValue": ""},
               "all": {"nullValue": "", "emptyValue": ""}}


@dataclass
class Lake:
    """A root folder with files per tenant, control tables and the run log; account and container are what the log names."""

    spark: SparkSession
    root: str
    account: str | None = None
    container: str | None = None

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def signals(self) -> str:
        return f"{self.root}/signals"

    @cached_property
    def files(self) -> Files:
        return Files(self.spark)

    @cached_property
    def snapshot(self) -> MonthlyTable:
        return MonthlyTable(self.spark, f"{self.root}/snapshot", schemas.FLAT)

    @cached_property
    def marks(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/state/marks", schemas.WATERMARK)

    @cached_property
    def settings(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/state/settings", schemas.SETTINGS)


def register_tenants(lake: Lake, tenants: DataFrame) -> None:
    """Make the folders of tenants that take part in exports."""
    names = tenants.select(folder_value(F.col("tenant_id"))).distinct()
    for (name,) in names.toLocalIterator():
        lake.files.make_folder(f"{lake.data}/tenant_key={name}")


def folder_value(value: Column) -> Column:
    """A text as Spark spells it in a partition folder, for the characters tenant ids may hold."""
    escaped = value
    for character in "%\"#'*/:=?\\{[]^":
        escaped = F.replace(escaped, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return escaped


def lake_tenants(lake: Lake) -> DataFrame:
    """Tenants with a folder directly below the lake's data root, with or without files."""
    prefix = "tenant_key="
    names = [(unquote(name.removeprefix(prefix)),) for name in lake.files.folders(lake.data) if name.startswith(prefix)]
    return lake.spark.createDataFrame(names, "tenant_id string")


def dialect_folder(dialect: Dialect, date_format: Column) -> Column:
    """The name a dialect has in paths: the codec, or the CSV options with the tenant's date format last."""
    if dialect.file_format == V.PARQUET:
        return F.lit(dialect.codec)
    return F.concat(F.lit(f"{csv_stem(dialect)}."), date_format)


def run_folder(day: str, run: str) -> Column:
    """The folder, below the data root, that one run writes for a tenant and format; for rows with the dialect columns."""
    words = F.create_map(*[F.lit(text) for pair in DELIMITER_WORDS.items() for text in pair])
    csv = F.concat_ws(".", F.element_at(words, F.replace("delimiter", F.lit("\\t"), F.lit("\t"))), "encoding", "quoting", "date_format")
    dialect = F.when(F.col("format") == V.PARQUET, F.col("codec")).otherwise(csv)
    year, month, date = day.split("-")
    return F.concat(F.lit("tenant_key="), folder_value(F.col("tenant_id")), F.lit("/format="), "format", F.lit("/dialect="), folder_value(dialect),
                    F.lit(f"/year={year}/month={month}/day={date}/run={run}"))


def csv_stem(dialect: Dialect) -> str:
    """Delimiter, encoding and quoting words, the part of a CSV folder name that readers must share."""
    return ".".join([DELIMITER_WORDS[dialect.csv_options()["sep"]], dialect.encoding, dialect.quoting])


def csv_dialect(folder_name: str) -> Dialect:
    """The dialect that a CSV folder name stands for."""
    word, encoding, quoting = folder_name.split(".")[:3]
    delimiter = next(sign for sign, name in DELIMITER_WORDS.items() if name == word)
    return Dialect(V.CSV, delimiter=delimiter, encoding=encoding, quoting=quoting)


def scan_files(lake: Lake, day: str | None = None, folders: list[str] | None = None) -> DataFrame:
    """One row per data file as the file system lists them, of one day or of known folders; file contents are not read."""
    year, month, date = day.split("-") if day else ("*", "*", "*")
    pattern = f"{lake.data}/tenant_key=*/format=*/dialect=*/year={year}/month={month}/day={date}"
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
        *[T.StructField(name, T.StringType()) for name in schemas.LAKE_PARTITIONS]])
    if not folders and (folders is not None or not lake.files.matches(f"{pattern}/run=*")):
        found = lake.spark.createDataFrame([], schema)
    else:
        found = (lake.spark.read.format("binaryFile").schema(schema).option("basePath", lake.data)
                 .option("pathGlobFilter", "*.{parquet,csv}").load(folders or pattern))
    return found.select(
        "path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"),
        F.col("tenant_key").alias("tenant_id"), *schemas.LAKE_PARTITIONS,
        F.make_date(*[F.col(name).cast("int") for name in ("year", "month", "day")]).alias("file_day"))


def _folders(lake: Lake, file_format: str, dialect: str, tenant: str | None, day: str | None, run: str | None) -> list[str]:
    """The glob pattern of one format, narrowed as far as tenant, day and run allow, if it finds anything."""
    parts = [f"tenant_key={tenant or '*'}", f"format={file_format}", f"dialect={dialect}"]
    if day or run:
        parts += [f"{name}={value}" for name, value in zip(("year", "month", "day"), day.split("-") if day else "***")]
    if run:
        parts.append(f"run={run}")
    pattern = "/".join([lake.data, *parts])
    return [pattern] if lake.files.matches(pattern) else []


def lake_read(lake: Lake, file_format: str = V.PARQUET, tenant: str | None = None, day: str | None = None,
              run: str | None = None) -> DataFrame:
    """Rows of one format with their partition values, each file read in the dialect it was written in."""
    if file_format == V.PARQUET:
        found = _folders(lake, file_format, "*", tenant, day, run)
        if not found:
            return lake.spark.createDataFrame([], schemas.LAKE)
        return (lake.spark.read.schema(schemas.LAKE).option("basePath", lake.data)
                .option("pathGlobFilter", "*.parquet").parquet(*found))
    if file_format != V.CSV:
        raise ValueError(f"Format not supported: {file_format}")
    stems = {csv_stem_of(path) for path in
             lake.files.matches(f"{lake.data}/tenant_key={tenant or '*'}/format=csv/dialect=*")}
    parts = [_read_csv(lake, found, csv_dialect(stem)) for stem in sorted(stems)
             if (found := _folders(lake, file_format, f"{stem}.*", tenant, day, run))]
    return reduce(DataFrame.unionByName, parts) if parts else lake.spark.createDataFrame([], schemas.LAKE)


def csv_stem_of(path: str) -> str:
    """Delimiter, encoding and quoting words of a CSV path; closed lists, so few differ."""
    return ".".join(path.rsplit("dialect=", 1)[1].split(".")[:3])


def _read_csv(lake: Lake, folders: list[str], dialect: Dialect) -> DataFrame:
    """Texts are parsed by the declared schema; timestamps by the date format in the folder name."""
    moments = [f.name for f in schemas.FLAT.fields if isinstance(f.dataType, T.TimestampNTZType)]
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in moments else f.dataType)
                            for f in schemas.LAKE.fields])
    rows = (lake.spark.read.schema(as_text).options(**dialect.csv_options()).options(mode="FAILFAST", **EMPTY_WORDS[dialect.quoting])
            .option("multiLine", "true").option("basePath", lake.data).option("pathGlobFilter", "*.csv").csv(folders))
    pattern = date_pattern(F.split("dialect", r"\.", 4)[3])
    return rows.withColumns({name: F.to_timestamp_ntz(F.col(name), pattern) for name in moments})


def lake_combine(spark: SparkSession, folder: str, skip_corrupt: bool = False, limit_files: int | None = None) -> DataFrame:
    """All Parquet files below a folder as one table; no files give no rows of the declared schema.

    ``limit_files`` takes the first files by name.
    """
    options = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true", "ignoreCorruptFiles": str(skip_corrupt).lower()}
    if not Files(spark).exists(folder):
        return spark.createDataFrame([], schemas.FLAT)
    sources = [folder]
    if limit_files is not None:
        listed = spark.read.format("binaryFile").options(**options).load(folder).select("path")
        sources = [row.path for row in listed.orderBy("path").limit(limit_files).collect()]
        if not sources:
            return spark.createDataFrame([], schemas.FLAT)
    return spark.read.schema(schemas.FLAT).options(**options).parquet(*sources)


def external_table(lake: Lake, name: str, file_format: str = V.PARQUET) -> None:
    """A catalog table over the files of one format, usable from SQL; queries prune its partitions."""
    if file_format != V.PARQUET:
        raise ValueError(f"Format not supported: {file_format}")
    lake.spark.catalog.createTable(name, path=f"{lake.data}/tenant_key=*/format={file_format}", source="parquet",
                                   schema=schemas.LAKE, basePath=lake.data, pathGlobFilter="*.parquet")
