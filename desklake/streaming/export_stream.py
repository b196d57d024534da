"""Run an incremental export for every completed refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from desklake.operators.export import export_run
from desklake.sources.lake import Lake

SIGNAL = "run_id string, as_of timestamp_ntz, folder string"


def refresh_signals(lake: Lake) -> DataFrame:
    """Completed refreshes as a stream; each is one small file."""
    lake.files.make_folder(lake.signals)
    return lake.spark.readStream.schema(SIGNAL).parquet(lake.signals)


def stream_export(lake: Lake, checkpoint: str, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Export after refreshes. ``available_now`` drains what is there and stops.

    Several refreshes in one batch need only one export, from the newest. Its clock names the run: a
    batch that is repeated after a crash completes it, and a later refresh with the same clock adds a part to it.
    """
    def export_newest(signals: DataFrame, _batch: int) -> None:
        newest = signals.agg(F.max_by(F.struct("as_of", "folder"), F.struct("as_of", "folder")).alias("s")).select("s.*").first()
        if newest.folder is not None:
            flat = lake.snapshot.read(newest.folder)
            export_run(lake, flat, newest.as_of)

    writer = refresh_signals(lake).writeStream.foreachBatch(export_newest).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
