"""Tenants in bands by the age of their marks, so that one idle tenant does not lengthen the scan for all others."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.functions.clock import Clock, ago, clock

#: The younger edge of each band but the first, before now.
EDGES = ("1 day", "30 days", "365 days")
#: A band of at most this many tenants also names them to the scan, which skips row groups without them.
NAMED_TENANTS = 100


@dataclass(frozen=True)
class Band:
    """Tenants with marks of about one age: their marks, the oldest of them, and who they are if they are few."""

    limits: DataFrame
    oldest: datetime
    tenants: tuple[str, ...]

    def reach(self) -> Column:
        """Every row that may lie beyond a mark of the band; plain bounds that a scan can push down."""
        later = F.col("created_at") > clock(self.oldest)
        return later & F.col("tenant_id").isin(*self.tenants) if self.tenants else later


def bands(marks: DataFrame, as_of: Clock) -> list[Band]:
    """The bands that hold any mark, the youngest first. One small row a band reaches the driver, and the ids of bands of few tenants."""
    limits = marks.where(F.col("last_exported_created_at").isNotNull()).select("tenant_id", F.col("last_exported_created_at").alias("_mark"))
    number = reduce(lambda total, span: total + (F.col("_mark") < ago(as_of, span)).cast("int"), EDGES, F.lit(0))
    found = limits.groupBy(number.alias("band")).agg(F.min("_mark").alias("oldest"), F.count(F.lit(1)).alias("tenants")).orderBy("band").collect()
    out = []
    for row in found:
        own = limits.where(number == row["band"])
        named = len(found) > 1 and row["tenants"] <= NAMED_TENANTS
        ids = tuple(r[0] for r in own.select("tenant_id").distinct().collect()) if named else ()
        out.append(Band(own, row["oldest"], () if None in ids else ids))
    return out
