"""Arriving files as a stream: each new file is decided on and processed once.

The checkpoint remembers which files were handed over. A micro-batch that is repeated after
a failure writes a new snapshot, so its files are replaced and not doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from claimwell.plans.run import RunSettings, process_arrivals
from claimwell.sources.arrivals import stream_arrivals
from claimwell.sources.lake import Lake
from claimwell.sources.layout import checkpoint_path


def ingest(
    lake: Lake,
    folder: str,
    cpt: DataFrame,
    icd10: DataFrame,
    settings: RunSettings | None = None,
    max_files: int = 1000,
    checkpoint: str | None = None,
    continuous_every: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Start the stream. By default it takes what is there and stops; with an interval such
    as '30 seconds' it goes on. `max_files` bounds a micro-batch. Files that are done move to
    `archive`, if it is given, so that the inbound folder does not grow.

    A checkpoint of its own makes the stream look at every file again, which is how files
    left behind are recovered: those already CURATED are skipped unless `settings.force`.
    """
    def handle(arrivals: DataFrame, _batch: int) -> None:
        process_arrivals(lake, arrivals, cpt, icd10, settings)

    writer = (
        stream_arrivals(lake.spark, folder, max_files, archive)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or checkpoint_path(lake.root, "arrivals"))
    )
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()
