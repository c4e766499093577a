"""Micro-batch runs over a folder of page files."""

from pyspark.sql import functions as F

from pagelake.params import RunParams
from pagelake.streaming import batch_params, process_batch, start_pages_stream

from conftest import SF_SMALL


def test_stream_runs_each_batch_once(spark, store, tmp_path):
    src = tmp_path / "incoming"
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    pages.filter(F.col("page_id") % 2 == 0).coalesce(1).write.parquet(str(src / "part1"))
    pages.filter(F.col("page_id") % 2 == 1).coalesce(1).write.parquet(str(src / "part2"))
    base = RunParams.fixed()
    q = start_pages_stream(spark, str(src / "*"), store, str(tmp_path / "ckpt"), base, max_files_per_trigger=1)
    q.awaitTermination(300)
    runs = sorted(r.run_id for r in store.read(base.tables.gold_summary).select("run_id").distinct().collect())
    assert runs == [batch_params(base, 0).run_id, batch_params(base, 1).run_id]
    # every page went through exactly once
    assert store.read(base.tables.gold_summary).count() == pages.count()
    # restart with nothing new: no further runs
    q2 = start_pages_stream(spark, str(src / "*"), store, str(tmp_path / "ckpt"), base)
    q2.awaitTermination(300)
    assert store.read(base.tables.gold_summary).count() == pages.count()


def test_replayed_batch_is_idempotent(spark, store):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    base = RunParams.fixed()
    process_batch(pages, 7, base, store)
    counts = {n: store.read(n, merge_schema=True).count()
              for n in (base.tables.bronze, base.tables.silver, base.tables.gold, base.tables.gold_summary)}
    process_batch(pages, 7, base, store)  # the same batch again, as after a failure
    again = {n: store.read(n, merge_schema=True).count() for n in counts}
    assert again == counts
    # the audit log records both attempts
    assert store.spark.read.parquet(store.path(base.tables.run_log)).count() == 6
