"""Run parameters: one immutable object per run, passed explicitly.

Ids and times are inputs, not side effects, so a run can be replayed and
tests can compare exact values.  ``RunParams.new()`` makes fresh ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

ENVIRONMENTS = ("dev", "test", "prod")
LOAD_MODES = ("append", "overwrite")

# Tables whose rows always accumulate, whatever the load mode.
ALWAYS_APPEND = ("gold_summary", "run_log")


@dataclass(frozen=True)
class TableNames:
    bronze: str = "bronze_scraped_data"
    silver: str = "silver_cleaned_data"
    gold: str = "gold_curated_data"
    gold_summary: str = "gold_data_summary"
    run_log: str = "pipeline_run_log"
    extracts: str = "page_extracts"  # of a run that has not landed yet
    fields: str = "record_fields"  # of a run that has not reached gold yet
    quarantine: str = "page_quarantine"


@dataclass(frozen=True)
class RunParams:
    run_id: str
    batch_id: str
    run_ts: datetime
    environment: str = "dev"
    load_mode: str = "append"
    source_label: str = ""
    tables: TableNames = field(default_factory=TableNames)

    def __post_init__(self):
        if self.environment not in ENVIRONMENTS:
            raise ValueError(f"environment must be one of {ENVIRONMENTS}, got {self.environment!r}")
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load_mode must be one of {LOAD_MODES}, got {self.load_mode!r}")
        if not self.run_id or not self.batch_id:
            raise ValueError("run_id and batch_id must be non-empty")
        if self.run_ts.tzinfo is None:
            object.__setattr__(self, "run_ts", self.run_ts.replace(tzinfo=timezone.utc))

    @classmethod
    def new(cls, **kw) -> "RunParams":
        kw.setdefault("run_id", str(uuid.uuid4()))
        kw.setdefault("batch_id", str(uuid.uuid4()))
        kw.setdefault("run_ts", datetime.now(timezone.utc))
        return cls(**kw)

    @classmethod
    def fixed(cls, tag: str = "0001", **kw) -> "RunParams":
        """Reproducible parameters (tests, oracle checks, benchmarks)."""
        kw.setdefault("run_ts", datetime(2024, 1, 1, tzinfo=timezone.utc))
        return cls(run_id=f"run-{tag}", batch_id=f"batch-{tag}", **kw)

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)

    @property
    def scraped_at(self) -> str:
        """ISO-8601 text with UTC offset, as stamped on every record."""
        return self.run_ts.astimezone(timezone.utc).isoformat()

    @property
    def run_timestamp(self) -> str:
        """Naive UTC ISO-8601 text, as written to the run log."""
        return self.run_ts.astimezone(timezone.utc).replace(tzinfo=None).isoformat()

    @property
    def run_ts_naive_utc(self) -> datetime:
        return self.run_ts.astimezone(timezone.utc).replace(tzinfo=None)

    @property
    def run_ts_micros(self) -> int:
        """Microseconds since the epoch (an absolute instant)."""
        delta = self.run_ts.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds

    def run_ts_col(self):
        """The run time as a timestamp column, independent of any time zone."""
        from pyspark.sql import functions as F

        return F.timestamp_micros(F.lit(self.run_ts_micros))


def mode_for(table_key: str, load_mode: str) -> str:
    """Write mode for a layer table: data layers follow the load mode,
    the summary and the run log always append."""
    if load_mode not in LOAD_MODES:
        raise ValueError(f"load_mode must be one of {LOAD_MODES}, got {load_mode!r}")
    if table_key in ALWAYS_APPEND:
        return "append"
    return "overwrite" if load_mode == "overwrite" else "append"
