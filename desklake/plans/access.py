"""Reports and alert conditions over the storage access log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.functions.clock import Clock, ago
from desklake.functions.names import tenant_in_uri
from desklake.functions.numbers import six_places

# Read operations, the denial code and the alert factor.
READ_OPERATIONS = ("GetBlob", "ListBlobs")
DENIED = 403
VOLUME_FACTOR = 10

# Column name; columns themselves need a running session.
AT = "time_generated"


def _requests() -> Column:
    return F.count(F.lit(1))


def _hour() -> Column:
    return F.date_trunc("HOUR", AT).cast("timestamp_ntz").alias("hour")


def _reads(access: DataFrame) -> DataFrame:
    return access.where(F.col("operation_name").isin(*READ_OPERATIONS))


def access_per_hour(access: DataFrame) -> DataFrame:
    return (_reads(access).groupBy("caller_ip", _hour()).agg(_requests().alias("access_count"))
            .orderBy("hour", "caller_ip"))


def access_quality(access: DataFrame, as_of: Clock) -> DataFrame:
    """Volume, success rate and mean latency per hour, operation and caller over the last day."""
    recent = access.where(F.col(AT) >= ago(as_of, "24 hours"))
    return (recent.groupBy(_hour(), "operation_name", "caller_ip")
            .agg(_requests().alias("total_requests"),
                 six_places(F.count_if(F.col("status_code") < 400) * 100.0 / _requests()).alias("success_rate"),
                 six_places(F.avg("duration_ms")).alias("avg_latency"))
            .orderBy(F.desc("hour"), "operation_name", "caller_ip"))


def access_by_tenant(access: DataFrame, as_of: Clock) -> DataFrame:
    """Reads per caller, authentication, tenant folder and hour over the last week."""
    recent = _reads(access).where(F.col(AT) >= ago(as_of, "7 days"))
    return (recent.groupBy("caller_ip", "authentication_type", tenant_in_uri(F.col("uri")).alias("tenant_folder"), _hour())
            .agg(_requests().alias("access_count"), F.max(AT).alias("last_access"))
            .orderBy(F.desc("hour"), "caller_ip", "tenant_folder"))


def access_alerts(access: DataFrame, factor: float = VOLUME_FACTOR) -> DataFrame:
    """Caller-hours with a denied request, or with more than ``factor`` times the mean hourly volume."""
    hourly = access.groupBy("caller_ip", _hour()).agg(
        _requests().alias("requests"), F.count_if(F.col("status_code") == DENIED).alias("denied"))
    mean = hourly.select(F.avg("requests")).scalar()
    return (hourly.withColumns({"any_denied": F.col("denied") > 0,
                                "high_volume": F.col("requests") > F.lit(float(factor)) * mean})
            .where(F.col("any_denied") | F.col("high_volume"))
            .orderBy("hour", "caller_ip"))
