"""The words, names and defaults that stored tables and log rows carry."""

# Ticket states and service-level states.
ACTIVE = "Active"
NO_SLA = "No SLA"
WITHIN_SLA = "Within SLA"
SLA_BREACHED = "SLA Breached"
SLA_AT_RISK = "SLA At Risk"
ON_TRACK = "On Track"
VIOLATIONS = (SLA_BREACHED, SLA_AT_RISK)

# Run-log words.
SUCCESS = "SUCCESS"
FAILED = "FAILED"
ERROR = "ERROR"
FULL = "FULL"
INCREMENTAL = "INCREMENTAL"
COMPACTION = "COMPACTION"
ALL_VIEWS = "ALL_VIEWS"
FLAT_VIEW = "bi_tickets_flat"
EXPORT_DESTINATION = "AZURE_DATALAKE"

# Export settings, allowed words and defaults.
PARQUET = "parquet"
CSV = "csv"
ALLOWED_FORMATS = ("parquet", "csv", "json")
ALLOWED_DELIMITERS = (",", ";", "|", "\t")
ALLOWED_ENCODINGS = ("utf-8", "utf-8-sig", "latin1", "iso-8859-1")
ALLOWED_CODECS = ("snappy", "gzip", "brotli", "lz4", "zstd", "none")
DEFAULT_DELIMITER = ","
DEFAULT_ENCODING = "utf-8"
DEFAULT_QUOTING = "minimal"
DEFAULT_CODEC = "snappy"
DEFAULT_DATE_FORMAT = "%Y-%m-%d %H:%M:%S"

# Look-back windows and ages.
FIRST_EXPORT_WINDOW = "30 minutes"
REPLAY_WINDOW = "7 days"
COOL_AFTER_DAYS = 30
ARCHIVE_AFTER_DAYS = 90
DELETE_AFTER_DAYS = 730
SUPERSEDED_AFTER_DAYS = 7
SUPERSEDED = "superseded"
LOG_RETENTION_DAYS = 30
