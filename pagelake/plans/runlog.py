"""Run log: one audit row per (run, layer) event, always appended.

Rows are buffered per run and appended in one small write: when the run
ends, or at once when a layer fails (the buffered successes first, then
the failure), so the log never misses an event that happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import RunParams
from ..schemas import LAYERS, RUN_LOG_SCHEMA
from ..sources.tables import TableStore

STATUSES = ("success", "failed")


def log_rows(spark: SparkSession, params: RunParams, events: list[tuple[str, str, int, str]]) -> DataFrame:
    """Log rows for ``(layer, status, row_count, message)`` events."""
    for layer, status, _, _ in events:
        if status not in STATUSES:
            raise ValueError(f"status must be one of {STATUSES}")
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}")
    return spark.createDataFrame(
        [(params.run_id, params.run_timestamp, params.source_label, layer, status, int(n), msg)
         for layer, status, n, msg in events],
        RUN_LOG_SCHEMA,
    )


def append_log(store: TableStore, params: RunParams, events: list[tuple[str, str, int, str]]) -> None:
    if not events:
        return
    rows = log_rows(store.spark, params, events)
    rows.coalesce(1).write.mode("append").format("parquet").save(store.path(params.tables.run_log))


def append_failed_pages(store: TableStore, params: RunParams, bad: DataFrame) -> None:
    """One ``failed`` scrape row per quarantined page, under the page's url; written where the pages are."""
    rows = bad.select("run_id", F.lit(params.run_timestamp).alias("run_timestamp"), "source_url", F.lit("scrape").alias("layer"),
                      F.lit("failed").alias("status"), F.lit(0).cast("long").alias("row_count"), F.concat_ws(": ", "page_key", "error").alias("message"))
    rows.write.mode("append").format("parquet").save(store.path(params.tables.run_log))


class RunLog:
    """Buffered audit rows of one run."""

    def __init__(self, store: TableStore, params: RunParams):
        self.store, self.params = store, params
        self.pending: list[tuple[str, str, int, str]] = []

    def success(self, layer: str, row_count: int, message: str = "") -> None:
        self.pending.append((layer, "success", int(row_count), message))

    def failed(self, layer: str, message: str) -> None:
        self.pending.append((layer, "failed", 0, message))
        self.flush()

    def flush(self) -> None:
        events, self.pending = self.pending, []
        append_log(self.store, self.params, events)


def log_run(store: TableStore, params: RunParams, layer: str, status: str,
            row_count: int, message: str = "") -> None:
    """Append one audit row now."""
    append_log(store, params, [(layer, status, row_count, message)])


def read_log(store: TableStore, params: RunParams) -> DataFrame:
    return store.spark.read.parquet(store.path(params.tables.run_log))
