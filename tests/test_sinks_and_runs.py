"""Sinks, write modes, schema drift, run log and the end-to-end run."""

import pytest
from pyspark.sql import functions as F

from pagelake.operators import views as V
from pagelake.params import RunParams, mode_for
from pagelake.plans.medallion import run_medallion
from pagelake.plans.runlog import read_log
from pagelake.sources.tables import (
    encode_complex, ensure_database, jdbc_options, read_table, register_tables)

P1 = RunParams.fixed("0001")
P2 = RunParams.fixed("0002").with_(run_ts=P1.run_ts.replace(day=2))


def test_mode_rules():
    assert mode_for("bronze", "append") == "append"
    assert mode_for("silver", "overwrite") == "overwrite"
    assert mode_for("gold_summary", "overwrite") == "append"
    assert mode_for("run_log", "overwrite") == "append"
    with pytest.raises(ValueError):
        mode_for("gold", "replace")
    with pytest.raises(ValueError):
        RunParams.fixed(environment="staging")


def test_params_text_forms():
    assert P1.scraped_at == "2024-01-01T00:00:00+00:00"
    assert P1.run_timestamp == "2024-01-01T00:00:00"


def test_encode_complex(spark):
    df = spark.createDataFrame([(1, {"a": "x"}, [1, 2]), (2, None, None)], "i int, m map<string,string>, a array<int>")
    rows = encode_complex(df).orderBy("i").collect()
    assert rows[0].m == '{"a":"x"}' and rows[0].a == "[1,2]"
    assert rows[1].m is None and rows[1].a is None


def test_append_is_idempotent_per_run_and_overwrite_replaces(spark, store):
    df = spark.range(5).select(F.col("id"), F.lit(P1.run_id).alias("run_id"))
    assert store.write(df, "t", "replace_run") == 5
    assert store.write(df, "t", "replace_run") == 5  # same run again: replaced, not doubled
    df2 = spark.range(3).select(F.col("id"), F.lit(P2.run_id).alias("run_id"))
    store.write(df2, "t", "replace_run")
    assert store.read("t").count() == 8
    assert store.read("t", run_id=P2.run_id).count() == 3
    assert store.read("t", where="id >= 3").count() == 2  # ids 3 and 4 of the first run
    store.write(df2, "t", "overwrite")
    assert store.read("t").count() == 3
    with pytest.raises(Exception):
        store.write(df2, "t", "errorifexists")
    assert read_table(spark, store.path("t"), "id = 1").count() == 1


def test_schema_drift_append_null_fills(spark, store):
    a = spark.createDataFrame([("r1", "x", P1.run_id)], "record_id string, name string, run_id string")
    b = spark.createDataFrame([("r2", "7", P2.run_id)], "record_id string, price string, run_id string")
    store.write(a, "g", "append")
    store.write(b, "g", "append")
    rows = {r.record_id: r for r in store.read("g", merge_schema=True).collect()}
    assert rows["r1"].price is None and rows["r1"].name == "x"
    assert rows["r2"].name is None and rows["r2"].price == "7"


def test_end_to_end_and_run_log(spark, store, sample_pages):
    res = run_medallion(spark, sample_pages, P1, store)
    assert res.counts == {"bronze": 11, "silver": 24, "gold": 11}
    assert res.gold.count() == 11 and res.summary.count() == 1
    assert res.summary.first().validity_rate_pct == 91.67
    log = {(r.layer, r.status): r.row_count for r in read_log(store, P1).collect()}
    assert log == {("bronze", "success"): 11, ("silver", "success"): 24, ("gold", "success"): 11}
    stats = V.layer_stats(res.bronze, res.silver, res.gold, res.summary).first()
    assert (stats.bronze_count, stats.silver_count, stats.silver_validity_pct, stats.gold_count,
            stats.gold_rows) == (11, 24, 91.67, 11, 11)
    # a second run appends; the summary and the log keep both
    run_medallion(spark, sample_pages, P2, store)
    assert store.read(P1.tables.gold, merge_schema=True).count() == 22
    assert store.read(P1.tables.gold_summary).count() == 2
    assert read_log(store, P1).count() == 6
    latest = V.latest_gold_per_url(store.read(P1.tables.gold, merge_schema=True))
    assert {r.run_id for r in latest.collect()} == {P2.run_id}
    # overwrite replaces the data layers but still appends the summary
    run_medallion(spark, sample_pages, P1.with_(load_mode="overwrite"), store)
    assert store.read(P1.tables.gold, merge_schema=True).count() == 11
    assert store.read(P1.tables.gold_summary).count() == 2


def test_failing_layer_is_logged(spark, store, sample_pages, monkeypatch):
    import pagelake.plans.medallion as M

    def boom(*a, **k):
        raise RuntimeError("silver exploded")

    monkeypatch.setattr(M, "silver_of_fields", boom)
    with pytest.raises(RuntimeError):
        run_medallion(spark, sample_pages, P1, store)
    rows = {(r.layer, r.status): r.message for r in read_log(store, P1).collect()}
    assert rows[("silver", "failed")].startswith("RuntimeError: silver exploded")
    assert ("bronze", "success") in rows


def test_failing_extraction_is_logged(spark, store):
    bad = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string") \
        .select("page_id", "url", F.expr("raise_error('bad page')").cast("string").alias("html"))
    with pytest.raises(Exception):
        run_medallion(spark, bad, P1, store)
    rows = [(r.layer, r.status) for r in read_log(store, P1).collect()]
    assert rows == [("scrape", "failed")]


def test_catalog_registration(spark, store, sample_pages):
    run_medallion(spark, sample_pages, P1, store)
    ensure_database(spark, "pagelake_test")
    ensure_database(spark, "pagelake_test")  # idempotent
    register_tables(spark, store, "pagelake_test", {"s": P1.tables.gold_summary})
    n = spark.sql(f"SELECT count(*) FROM pagelake_test.{P1.tables.gold_summary}").first()[0]
    assert n == 1


def test_jdbc_options():
    o = jdbc_options("jdbc:mysql://h:3306/db", "t", user="u", password="p")
    assert o == {"url": "jdbc:mysql://h:3306/db", "dbtable": "t", "batchsize": "1000", "user": "u", "password": "p"}


def test_html_folder_source(spark, tmp_path):
    from conftest import SAMPLE_HTML
    from pagelake.sources.extract import extract_records, read_pages

    d = tmp_path / "site"
    d.mkdir()
    (d / "a.html").write_text(SAMPLE_HTML)
    (d / "b.html").write_text("<p>x</p>")
    pages = read_pages(spark, str(d), fmt="html")
    assert pages.count() == 2
    assert extract_records(pages, P1).count() == 12


def test_run_partition_write_and_string_run_ids(spark, store):
    df = spark.range(4).select(F.col("id"), F.lit("20240101").alias("run_id"))
    assert store.write(df, "p", "replace_run", run_id="20240101") == 4
    assert store.write(df, "p", "replace_run", run_id="20240101") == 4  # replaced, not doubled
    df2 = spark.range(2).select(F.col("id"), F.lit("0002").alias("run_id"))
    store.write(df2, "p", "replace_run", run_id="0002")
    got = store.read("p")
    assert dict(got.dtypes)["run_id"] == "string"
    assert sorted(r.run_id for r in got.select("run_id").distinct().collect()) == ["0002", "20240101"]
    assert store.read("p", run_id="0002").count() == 2
    store.write(df2, "p", "overwrite", run_id="0002")
    assert store.read("p").count() == 2
    with pytest.raises(FileExistsError):
        store.write(df2, "p", "errorifexists", run_id="0002")


def test_failed_overwrite_keeps_existing_runs(spark, store):
    ok = spark.range(3).select(F.col("id"), F.lit("a").alias("run_id"))
    store.write(ok, "k", "append", run_id="a")
    bad = spark.range(3).select(F.expr("raise_error('boom')").cast("long").alias("id"), F.lit("b").alias("run_id"))
    with pytest.raises(Exception):
        store.write(bad, "k", "overwrite", run_id="b")
    assert sorted(r.run_id for r in store.read("k").select("run_id").distinct().collect()) == ["a"]
    store.write(ok.withColumn("run_id", F.lit("b")), "k", "overwrite", run_id="b")
    assert sorted(r.run_id for r in store.read("k").select("run_id").distinct().collect()) == ["b"]


def test_package_zip_for_executors():
    import io
    import zipfile

    from pagelake.session import _package_zip

    name, data = _package_zip()
    assert name.startswith("pagelake-") and name.endswith(".zip")
    names = zipfile.ZipFile(io.BytesIO(data)).namelist()
    assert "pagelake/__init__.py" in names and "pagelake/sources/html_records.py" in names
    assert not any("__pycache__" in n for n in names)
    assert _package_zip()[0] == name  # content-addressed: stable name


def test_command_line(spark, tmp_path, capsys):
    from pagelake.__main__ import main

    assert main(["--pages", "/root/testdata/sf0.001/pages.parquet", "--lake", str(tmp_path / "lake"),
                 "--environment", "test", "--run-id", "cli-run"]) == 0
    out = capsys.readouterr().out
    assert "run cli-run" in out
    store_root = tmp_path / "lake" / "gold_curated_data" / "run_id=cli-run"
    assert store_root.exists()


def test_empty_input_runs_through(spark, store):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    res = run_medallion(spark, empty, P1, store)
    assert res.counts == {"bronze": 0, "silver": 0, "gold": 0}
    assert res.gold.count() == 0 and res.summary.count() == 0
    assert sorted(r.layer for r in read_log(store, P1).collect()) == ["bronze", "gold", "silver"]


def test_read_with_schema_keeps_string_run_ids(spark, store):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    df = spark.range(2).select(F.col("id"), F.lit("20240101").alias("run_id"))
    store.write(df, "q", "append", run_id="20240101")
    sch = StructType([StructField("id", LongType()), StructField("run_id", StringType())])
    got = store.read("q", schema=sch)
    assert dict(got.dtypes)["run_id"] == "string"
    assert {r.run_id for r in got.collect()} == {"20240101"}
    assert store.read("q", run_id="20240101", schema=sch).count() == 2


def test_log_rows_are_validated(spark):
    from pagelake.plans.runlog import log_rows

    rows = log_rows(spark, P1, [("silver", "success", 3, "")]).collect()
    assert [(r.layer, r.status, r.row_count, r.run_timestamp) for r in rows] == [
        ("silver", "success", 3, "2024-01-01T00:00:00")]
    with pytest.raises(ValueError):
        log_rows(spark, P1, [("platinum", "success", 1, "")])
    with pytest.raises(ValueError):
        log_rows(spark, P1, [("gold", "maybe", 1, "")])


def test_append_adds_and_replace_run_replaces(spark, store):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "run_id string, v int")
    for run_id in (None, "a"):
        name = f"adds_{run_id}"
        store.write(df, name, "append", run_id=run_id)
        store.write(df, name, "append", run_id=run_id)
        assert store.read(name).count() == 4
        store.write(df, name, "replace_run", run_id=run_id)
        assert store.read(name).count() == 2
