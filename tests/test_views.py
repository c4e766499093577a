"""BI views (record-type chips, preview, stats, chart series, latest rows)."""

from datetime import datetime

from pyspark.sql import functions as F

from pagelake.operators import views as V
from pagelake.operators.bronze import to_bronze
from pagelake.params import RunParams
from pagelake.sources.extract import extract_records

P = RunParams.fixed()


def test_record_type_counts_sorted_without_nulls(spark, sample_pages):
    b = to_bronze(extract_records(sample_pages, P), P)
    b = b.unionByName(b.limit(1).withColumn("record_type", F.lit(None).cast("string")))
    rows = [tuple(r) for r in V.record_type_counts(b).collect()]
    assert rows == [("link", 3), ("metadata", 2), ("paragraph", 2), ("table_row", 4)]


def test_preview_is_top_n_by_key_without_stamp(spark):
    gold = spark.createDataFrame(
        [(f"r{i:02d}", "u", None if i % 2 else "v", datetime(2024, 1, 1)) for i in range(60)],
        "record_id string, source_url string, text string, gold_loaded_at timestamp")
    prev = V.display_rows(V.gold_preview(gold))
    rows = prev.collect()
    assert len(rows) == 50 and "gold_loaded_at" not in prev.columns
    assert rows[0].record_id == "r00" and rows[1].text == ""
    shown = V.display_rows(spark.createDataFrame([(None, None)], "a int, b string")).first()
    assert (shown.a, shown.b) == ("", "")
    assert "TakeOrderedAndProject" in V.gold_preview(gold)._jdf.queryExecution().executedPlan().toString()
    assert V.console_preview(gold).count() == 10


def test_chart_series_parse_float_prefix(spark):
    gold = spark.createDataFrame(
        [("a", "19.99 USD"), (None, "42"), ("c", "$5"), ("d", None), ("e", "1e3x")], "x string, y string")
    rows = [tuple(r) for r in V.chart_series(gold, "x", "y").collect()]
    assert rows == [("a", 19.99), ("", 42.0), ("e", 1000.0)]


def test_url_filter_and_ordering(spark):
    gold = spark.createDataFrame(
        [("r1", "u1", datetime(2024, 1, 1)), ("r2", "u1", datetime(2024, 1, 3)), ("r3", "u2", datetime(2024, 1, 2))],
        "record_id string, source_url string, gold_loaded_at timestamp")
    assert [r.record_id for r in V.gold_for_url(gold, "u1").collect()] == ["r2", "r1"]
    assert sorted(r.record_id for r in V.latest_gold_per_url(gold).collect()) == ["r2", "r3"]
    nulls = gold.unionByName(gold.where("record_id <> 'r3'").selectExpr("concat('n', record_id) AS record_id", "cast(null AS string) AS source_url", "gold_loaded_at"))
    assert sorted(r.record_id for r in V.latest_gold_per_url(nulls).collect()) == ["nr2", "r2", "r3"]
    summ = spark.createDataFrame([("a", "u", datetime(2024, 1, 1)), ("b", "u", datetime(2024, 1, 5))],
                                 "run_id string, source_url string, summary_generated_at timestamp")
    assert V.summary_latest_first(summ).first().run_id == "b"
    log = spark.createDataFrame([("a", "2024-01-01T00:00:00", "gold"), ("b", "2024-01-02T00:00:00", "bronze")],
                                "run_id string, run_timestamp string, layer string")
    assert V.run_log_latest_first(log).first().run_id == "b"
