"""Alert conditions that need order: failure streaks and growth between days."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from desklake import vocabulary as V
from desklake.functions.numbers import six_places

STREAK_LENGTH = 3
GROWTH_LIMIT = 0.5
LANES = 1000

_PIECE = "job_id string, failed boolean, runs bigint, first_ts timestamp_ntz, last_ts timestamp_ntz"


def _pieces(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Fold one sorted partition into its stretches of equal job and outcome.

    Only the stretch still open is carried between batches. The first and the last stretch are marked, as
    only these can continue in a neighbouring partition; of the others, long enough failures go out.
    """
    carried, sequence = None, 0

    def closed(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
        nonlocal sequence
        rows = rows.assign(piece=range(sequence, sequence + len(rows)))
        sequence += len(rows)
        edge = (rows["piece"] == 0) | (last & (rows["piece"] == sequence - 1))
        return rows.assign(edge=edge)[edge | (rows["failed"] & (rows["runs"] >= length))]

    for batch in batches:
        if batch.empty:
            continue
        starts = (batch["job_id"] != batch["job_id"].shift()) | (batch["failed"] != batch["failed"].shift())
        rows = (batch.groupby(starts.cumsum().rename("stretch"))
                .agg(job_id=("job_id", "first"), failed=("failed", "first"), runs=("failed", "size"),
                     first_ts=("refresh_timestamp", "first"), last_ts=("refresh_timestamp", "last"))
                .reset_index(drop=True))
        if carried is not None:
            open_job, open_outcome = carried.loc[0, ["job_id", "failed"]]
            if (rows.loc[0, "job_id"], rows.loc[0, "failed"]) == (open_job, open_outcome):
                rows.loc[0, "runs"] += carried.loc[0, "runs"]
                rows.loc[0, "first_ts"] = carried.loc[0, "first_ts"]
            else:
                rows = pd.concat([carried, rows], ignore_index=True)
        carried = rows.tail(1).reset_index(drop=True)
        yield closed(rows.iloc[:-1], last=False)
    if carried is not None:
        yield closed(carried, last=True)


def failure_streaks(log: DataFrame, length: int = STREAK_LENGTH, partitions: int | None = None) -> DataFrame:
    """Runs of at least ``length`` consecutive failures per job.

    There are few jobs and one may hold most of the log, so a window per job would put it into one task.
    The log is range-partitioned by job and time instead and each partition folds to its stretches. Only
    the two outermost of each partition are stitched with their neighbours in one window lane per job;
    the others are complete and spread over many lanes.
    """
    order = ["job_id", "refresh_timestamp", "id"]
    outcomes = log.where(F.col("job_id").isNotNull()).select(
        *order, F.col("status").isin(V.FAILED, V.ERROR).alias("failed"))
    ranged = outcomes.repartitionByRange(partitions, *order) if partitions else outcomes.repartitionByRange(*order)
    pieces = (ranged.sortWithinPartitions(*order)
              .mapInPandas(lambda batches: _pieces(batches, length), f"{_PIECE}, piece bigint, edge boolean")
              .withColumn("part", F.spark_partition_id()))
    lanes = pieces.withColumn("lane", F.when(F.col("edge"), 0).otherwise(1 + F.pmod(F.xxhash64("part", "piece"), F.lit(LANES))))
    along = Window.partitionBy("job_id", "lane").orderBy("part", "piece")
    continues = F.col("edge") & (F.lag("failed").over(along) == F.col("failed")) & (F.lag("part").over(along) < F.col("part"))
    stretches = (lanes.withColumn("starts", F.when(continues, 0).otherwise(1))
                 .withColumn("stretch", F.sum("starts").over(along)))
    return (stretches.groupBy("job_id", "lane", "stretch", "failed")
            .agg(F.sum("runs").alias("failures"), F.min("first_ts").alias("first_failure"), F.max("last_ts").alias("last_failure"))
            .where(F.col("failed") & (F.col("failures") >= length))
            .select("job_id", "failures", "first_failure", "last_failure")
            .orderBy("job_id", "first_failure"))


def growth_alerts(inventory: DataFrame, limit: float = GROWTH_LIMIT) -> DataFrame:
    """Days on which the stored bytes written exceed those of the day before by more than ``limit``.

    The window runs over one row per day, so a single task is enough.
    """
    daily = inventory.groupBy("day").agg(F.sum("size_bytes").alias("total_bytes"))
    by_day = Window.partitionBy().orderBy("day")
    total = daily.select("day", F.sum("total_bytes").over(by_day).alias("stored_bytes"))
    before = F.lag("stored_bytes").over(by_day)
    consecutive = F.lag("day").over(by_day) == F.date_sub("day", 1)
    grown = total.select("day", "stored_bytes", F.when(consecutive, before).alias("previous_bytes"))
    growth = F.try_divide((F.col("stored_bytes") - F.col("previous_bytes")).cast("double"),
                          F.col("previous_bytes").cast("double"))
    return (grown.withColumn("growth", six_places(growth)).where(growth > limit).orderBy("day"))

