"""Per-tenant export settings as set-based operations: changes for any number of tenants in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake import schemas
from desklake import vocabulary as V
from desklake.functions.clock import Clock, clock
from desklake.functions.formats import formats_or_parquet, formats_text, has_format, only_parquet, valid_date_format

# Fixed value: the date format reported for tenants without one.
REPORTED_DATE_FORMAT = "YYYY-MM-DD HH24:MI:SS"

DEFAULTS = {
    "csv_delimiter": V.DEFAULT_DELIMITER, "csv_encoding": V.DEFAULT_ENCODING, "csv_quoting": V.DEFAULT_QUOTING,
    "csv_date_format": V.DEFAULT_DATE_FORMAT, "parquet_compression": V.DEFAULT_CODEC, "parquet_engine": "pyarrow",
}


def _tenant_names(tenants: DataFrame) -> DataFrame:
    return tenants.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"))


def _default_row(tenants: DataFrame, formats: Column, note: str, at: Clock, by: str) -> DataFrame:
    """Complete settings rows for new tenants."""
    columns = {"export_formats": formats, "active": F.lit(True), "notes": F.lit(note),
               "created_at": clock(at), "updated_at": clock(at), "created_by": F.lit(by), "updated_by": F.lit(by)}
    fixed = {name: F.lit(value) for name, value in DEFAULTS.items() if name not in tenants.columns}
    return schemas.evolve(tenants.withColumns({**fixed, **columns}), schemas.SETTINGS)


def settings_bootstrap(tenants: DataFrame, settings: DataFrame, at: Clock, by: str = "desklake",
                       note: str = "default settings") -> DataFrame:
    """All settings after giving parquet-only rows to tenants that have none."""
    new = _tenant_names(tenants).select("tenant_id").join(settings, "tenant_id", "left_anti")
    return (schemas.evolve(settings, schemas.SETTINGS)
            .unionByName(_default_row(new, only_parquet(), note, at, by)))


def settings_enable_csv(settings: DataFrame, changes: DataFrame, at: Clock, by: str = "desklake",
                        tenants: DataFrame | None = None) -> DataFrame:
    """All settings after switching CSV on for the tenants in ``changes``.

    ``changes`` has tenant_id and may have csv_delimiter and csv_encoding. Existing rows get csv once, become
    active and keep their other options; absent rows are inserted with parquet and csv. With ``tenants``
    given, changes for unknown tenants are left out. Of several changes for one tenant the greatest delimiter, then encoding, counts.
    """
    wanted = changes if tenants is None else changes.join(_tenant_names(tenants), "tenant_id", "left_semi")
    wanted = wanted.select(
        "tenant_id",
        *[(F.coalesce(F.col(name), F.lit(DEFAULTS[name])) if name in changes.columns else F.lit(DEFAULTS[name])).alias(name)
          for name in ("csv_delimiter", "csv_encoding")])
    wanted = wanted.groupBy("tenant_id").agg(F.max(F.struct("csv_delimiter", "csv_encoding")).alias("options")).select("tenant_id", "options.*")
    current = schemas.evolve(settings, schemas.SETTINGS)
    asked = wanted.select("tenant_id", F.col("csv_delimiter").alias("_delimiter"), F.col("csv_encoding").alias("_encoding"))
    touched = F.col("_delimiter").isNotNull()
    formats = F.col("export_formats")
    updated = current.join(asked, "tenant_id", "left").withColumns({
        "export_formats": F.when(touched & ~has_format(formats, V.CSV), F.array_append(formats, F.lit(V.CSV))).otherwise(formats),
        "csv_delimiter": F.coalesce("_delimiter", "csv_delimiter"),
        "csv_encoding": F.coalesce("_encoding", "csv_encoding"),
        "active": F.when(touched, True).otherwise(F.col("active")),
        "notes": _noted(touched, "CSV enabled at", at),
        "updated_at": F.when(touched, clock(at)).otherwise(F.col("updated_at")),
        "updated_by": F.when(touched, by).otherwise(F.col("updated_by")),
    }).drop("_delimiter", "_encoding")
    both = F.array(F.lit(V.PARQUET), F.lit(V.CSV))
    inserted = _default_row(wanted.join(settings, "tenant_id", "left_anti"), both, "CSV enabled", at, by)
    return updated.unionByName(inserted)


def settings_disable_csv(settings: DataFrame, changes: DataFrame, at: Clock, by: str = "desklake") -> DataFrame:
    """All settings after removing csv for the tenants in ``changes``; the list may become empty."""
    current = schemas.evolve(settings, schemas.SETTINGS)
    asked = changes.select("tenant_id", F.lit(True).alias("_asked")).distinct()
    touched = F.col("_asked").isNotNull()
    return current.join(asked, "tenant_id", "left").withColumns({
        "export_formats": F.when(touched, F.array_remove("export_formats", V.CSV)).otherwise(F.col("export_formats")),
        "notes": _noted(touched, "CSV disabled at", at),
        "updated_at": F.when(touched, clock(at)).otherwise(F.col("updated_at")),
        "updated_by": F.when(touched, by).otherwise(F.col("updated_by")),
    }).drop("_asked")


def _noted(touched: Column, what: str, at: Clock) -> Column:
    addition = F.concat(F.coalesce("notes", F.lit("")), F.lit(f" | {what} "), clock(at).cast("string"))
    return F.when(touched, addition).otherwise(F.col("notes"))


def change_outcomes(changes: DataFrame, known: DataFrame) -> DataFrame:
    """Per requested tenant whether its row exists in ``known`` (tenants for enabling, settings for disabling)."""
    have = known.select("tenant_id", F.lit(True).alias("_known"))
    return changes.select("tenant_id").join(have, "tenant_id", "left").select("tenant_id", F.col("_known").isNotNull().alias("done"))


def export_config(tenant_ids: DataFrame, settings: DataFrame) -> DataFrame:
    """Effective export options per requested tenant; inactive or unknown ones fall back to the defaults."""
    live = settings.where(F.col("active") == True)  # noqa: E712
    fallback = {"csv_delimiter": V.DEFAULT_DELIMITER, "csv_encoding": V.DEFAULT_ENCODING,
                "csv_date_format": REPORTED_DATE_FORMAT, "parquet_compression": V.DEFAULT_CODEC}
    return (tenant_ids.select("tenant_id").join(live, "tenant_id", "left")
            .select("tenant_id", F.coalesce("export_formats", only_parquet()).alias("export_formats"),
                    *[F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in fallback.items()],
                    F.coalesce("csv_quoting", F.lit(V.DEFAULT_QUOTING)).alias("csv_quoting")))


def csv_enabled_tenants(settings: DataFrame, tenants: DataFrame) -> DataFrame:
    live = schemas.evolve(settings, schemas.SETTINGS).where(F.col("active") & has_format(F.col("export_formats"), V.CSV))
    return (live.join(_tenant_names(tenants), "tenant_id")
            .select("tenant_id", "tenant_name", "export_formats", "csv_delimiter", "csv_encoding", "active",
                    "created_at", "updated_at").orderBy("tenant_name"))


def formats_summary(tenants: DataFrame, settings: DataFrame) -> DataFrame:
    """Tenants and formats per strategy. An empty list counts as multi and contributes a NULL format."""
    kept = (_tenant_names(tenants).join(settings, "tenant_id", "left").where(F.coalesce("active", F.lit(True))))
    formats = F.col("export_formats")
    strategy = F.when(formats.isNull(), "default").when(F.size(formats) == 1, "single").otherwise("multi")
    used = kept.select("tenant_id", strategy.alias("format_strategy"),
                       F.explode_outer(F.coalesce(formats, only_parquet())).alias("format"))
    found = F.sort_array(F.collect_set("format"))
    with_null = F.when(F.count_if(F.col("format").isNull()) > 0, F.array_prepend(found, F.lit(None).cast("string"))).otherwise(found)
    return (used.groupBy("format_strategy")
            .agg(F.count_distinct("tenant_id").alias("tenants_count"), with_null.alias("formats_used"))
            .orderBy("format_strategy"))


def settings_totals(settings: DataFrame) -> DataFrame:
    formats = F.col("export_formats")
    return settings.agg(F.count(F.lit(1)).alias("total_tenants_configured"),
                        F.count_if(has_format(formats, V.CSV)).alias("with_csv_enabled"),
                        F.count_if(has_format(formats, V.PARQUET)).alias("with_parquet_enabled"))


def tenant_formats(tenants: DataFrame, settings: DataFrame) -> DataFrame:
    """Every tenant with its settings row, or parquet where it has none."""
    complete = schemas.evolve(settings, schemas.SETTINGS)
    return (_tenant_names(tenants).join(complete, "tenant_id", "left")
            .withColumn("export_formats", F.coalesce("export_formats", only_parquet()))
            .orderBy("tenant_name"))


def tenant_detail(tenants: DataFrame, settings: DataFrame, tenant_id: str) -> DataFrame:
    one = tenants.where(F.col("id") == tenant_id)
    return tenant_formats(one, settings.where(F.col("tenant_id") == tenant_id))


def display_formats(frame: DataFrame, column: str = "export_formats") -> DataFrame:
    """The array column as sorted text."""
    return frame.withColumn(column, formats_text(F.col(column)))


def settings_violations(settings: DataFrame) -> DataFrame:
    """One row per settings row and broken rule."""
    allowed = F.array(*[F.lit(name) for name in V.ALLOWED_FORMATS])
    rules = {
        "export_formats": F.size(F.array_except("export_formats", allowed)) > 0,
        "csv_delimiter": ~F.col("csv_delimiter").isin(*V.ALLOWED_DELIMITERS),
        "csv_encoding": ~F.col("csv_encoding").isin(*V.ALLOWED_ENCODINGS),
        "parquet_compression": ~F.col("parquet_compression").isin(*V.ALLOWED_CODECS),
    }
    broken = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]), lambda rule: rule.isNotNull())
    return settings.select("tenant_id", F.explode(broken).alias("rule")).orderBy("tenant_id", "rule")


# --- writer options -----------------------------------------------------------------------------

# How stored words map to Spark writer options.
SPARK_ENCODINGS = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1"}
WRITABLE_QUOTING = ("minimal", "all", "nonnumeric")
SPARK_CODECS = {"snappy": "snappy", "gzip": "gzip", "lz4": "lz4_raw", "zstd": "zstd", "none": "uncompressed"}


@dataclass(frozen=True)
class Dialect:
    """Everything one writer job must have in common. The date format is a column, not part of it."""

    file_format: str
    delimiter: str = V.DEFAULT_DELIMITER
    encoding: str = V.DEFAULT_ENCODING
    quoting: str = V.DEFAULT_QUOTING
    codec: str = V.DEFAULT_CODEC

    def writer_options(self) -> dict[str, str]:
        """Spark options, or ValueError before any job starts when a word has no counterpart."""
        if self.file_format == V.PARQUET:
            if self.codec not in SPARK_CODECS:
                raise ValueError(f"Parquet codec not supported: {self.codec}")
            return {"compression": SPARK_CODECS[self.codec]}
        if self.file_format == V.CSV:
            return self.csv_options()
        raise ValueError(f"Format not supported: {self.file_format}")

    @property
    def as_lines(self) -> bool:
        """Whether rows must be formed as lines of text, as the CSV writer knows neither a byte-order mark nor quoting by type."""
        return self.file_format == V.CSV and (self.encoding == "utf-8-sig" or self.quoting == "nonnumeric")

    def csv_options(self) -> dict[str, str]:
        delimiter = "\t" if self.delimiter in ("\t", "\\t") else self.delimiter
        if delimiter not in V.ALLOWED_DELIMITERS:
            raise ValueError(f"CSV delimiter not supported: {self.delimiter!r}")
        if self.encoding not in SPARK_ENCODINGS:
            raise ValueError(f"CSV encoding not supported: {self.encoding}")
        if self.quoting not in WRITABLE_QUOTING:
            raise ValueError(f"CSV quoting not supported: {self.quoting}")
        return {"header": "true", "sep": delimiter, "encoding": SPARK_ENCODINGS[self.encoding],
                "quoteAll": str(self.quoting == "all").lower(), "escape": '"', "lineSep": "\n",
                # A NULL is an empty field and an empty text is "".
                "nullValue": "", "emptyValue": '""',
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def dialect_columns(config: DataFrame) -> DataFrame:
    """One row per tenant and effective format, with the columns of its :class:`Dialect`.

    Options that do not matter for a format are reset to the defaults, which keeps the distinct dialects
    few: formats, delimiters, encodings, quoting and codecs are all closed lists.
    """
    each = config.select("*", F.explode(F.array_distinct(formats_or_parquet(F.col("export_formats")))).alias("format"))
    csv_only = F.col("format") == V.CSV
    columns = {
        "delimiter": F.when(csv_only, F.col("csv_delimiter")).otherwise(V.DEFAULT_DELIMITER),
        "encoding": F.when(csv_only, F.col("csv_encoding")).otherwise(V.DEFAULT_ENCODING),
        "quoting": F.when(csv_only, F.col("csv_quoting")).otherwise(V.DEFAULT_QUOTING),
        "codec": F.when(F.col("format") == V.PARQUET, F.col("parquet_compression")).otherwise(V.DEFAULT_CODEC),
        "date_format": F.col("csv_date_format"),
    }
    return each.select("tenant_id", "format", *[column.alias(name) for name, column in columns.items()])



DIALECT_COLUMNS = ["format", "delimiter", "encoding", "quoting", "codec"]


def writable() -> Column:
    """Whether the dialect columns hold only words of the closed lists that can be written."""
    csv = ((F.col("format") == V.CSV) & F.col("delimiter").isin(*V.ALLOWED_DELIMITERS)
           & F.col("encoding").isin(*SPARK_ENCODINGS) & F.col("quoting").isin(*WRITABLE_QUOTING)
           & valid_date_format(F.col("date_format")))
    parquet = (F.col("format") == V.PARQUET) & F.col("codec").isin(*SPARK_CODECS)
    return F.coalesce(csv | parquet, F.lit(False))


def distinct_dialects(frame: DataFrame) -> list[Dialect]:
    """The writable dialects that occur; the closed lists allow some fifty."""
    rows = frame.where(writable()).select(*DIALECT_COLUMNS).distinct().collect()
    return [Dialect(*row) for row in sorted(rows)]


def is_dialect(dialect: Dialect) -> Column:
    return (writable() & (F.col("format") == dialect.file_format) & (F.col("delimiter") == dialect.delimiter)
            & (F.col("encoding") == dialect.encoding) & (F.col("quoting") == dialect.quoting)
            & (F.col("codec") == dialect.codec))
