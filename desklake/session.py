"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # "month=01" must stay the text "01".
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Hot join keys and hot output partitions are split from runtime statistics.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording a Python stack trace per column expression takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "desklake", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the jobs expect; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder; a cluster without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="desklake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
