"""Incremental runs: new page files -> the same layers, one run per micro-batch.

Structured Streaming watches a folder of pages files; ``foreachBatch``
hands each micro-batch to ``run_medallion`` with a run id derived from the
batch id.  A micro-batch that is replayed after a failure gets the same
run id, and every layer write replaces that run's partition, so replays
do not duplicate rows (the run log, being an audit trail, records each
attempt).  The checkpoint location must be on shared storage.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..params import RunParams
from ..plans.medallion import run_medallion
from ..schemas import PAGES_SCHEMA
from ..sources.tables import TableStore


def batch_params(base: RunParams, batch_id: int) -> RunParams:
    """Ids and load stamp of a micro-batch: both follow from the batch id, so a replay repeats them and a later batch is a later load."""
    return base.with_(run_id=f"{base.run_id}-b{batch_id:06d}", batch_id=f"{base.batch_id}-b{batch_id:06d}",
                      run_ts=base.run_ts + timedelta(seconds=batch_id))


def process_batch(batch: DataFrame, batch_id: int, base: RunParams, store: TableStore) -> None:
    """One micro-batch = one run with a run id derived from the batch id;
    a replay of the same batch goes on where the failed try stopped."""
    run_medallion(batch.sparkSession, batch, batch_params(base, batch_id), store, resume=True)


def start_pages_stream(spark: SparkSession, source_dir: str, store: TableStore, checkpoint: str,
                       base: RunParams, available_now: bool = True,
                       processing_time: str | None = None,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what is there and
    stops; otherwise ``processing_time`` (e.g. ``'1 minute'``) polls."""
    if base.load_mode == "overwrite":
        raise ValueError("a stream appends: with load_mode='overwrite' each micro-batch would delete the ones before")
    reader = spark.readStream.schema(PAGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    pages = reader.parquet(source_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, base, store)

    w = pages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
