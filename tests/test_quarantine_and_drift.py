"""Pages that can't be parsed, pages that occur twice, catalog tables that follow their files, stamps of streamed batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagelake.operators import gold as G
from pagelake.operators import views as V
from pagelake.operators.bronze import to_bronze
from pagelake.operators.silver import to_silver
from pagelake.params import RunParams
from pagelake.plans.medallion import run_medallion
from pagelake.plans.runlog import read_log
from pagelake.sources.extract import distinct_pages, extract_records, extract_tagged
from pagelake.sources.tables import register_tables
from pagelake.streaming.pages_stream import batch_params, process_batch, start_pages_stream

P = RunParams.fixed()
PAGE = "page_id long, url string, html string"
GOOD = [(k, f"http://x/{k}", f"<title>t{k}</title><p>text {k}</p>") for k in range(20)]


def ids(df):
    return Counter((r.source_url, r.record_type, r.row_index) for r in df.collect())


@pytest.mark.parametrize("bad", ["<p>a</p><![bad[ <p>x", "<![ x", "<![x]"])
def test_a_malformed_page_does_not_end_the_run(spark, store, bad):
    res = run_medallion(spark, spark.createDataFrame([*GOOD, (99, "http://x/bad", bad)], PAGE), P, store)
    assert res.quarantined == 0
    assert ids(res.bronze.where("source_url <> 'http://x/bad'")) == ids(to_bronze(extract_records(spark.createDataFrame(GOOD, PAGE), P), P))
    assert [r.status for r in read_log(store, P).collect()] == ["success"] * 3


def test_pages_beyond_the_parser_are_quarantined(spark, store, monkeypatch):
    import pagelake.sources.html_records as H

    plain = H.extract

    def extract(html, kinds):
        if "boom" in html:
            raise ValueError("beyond this parser")
        return plain(html, kinds)

    # in this process: the batch function itself
    monkeypatch.setattr(H, "extract", extract)
    import pyarrow as pa

    from pagelake.sources.extract import _extract_batches

    batch = pa.RecordBatch.from_pydict({"page_key": ["1", "2", "3", "4"], "source_url": ["a", "b", None, "d"], "html": ["<p>x", "boom", None, "y" * 50]})
    rows = [r for b in _extract_batches([batch], max_chars=40) for r in b.to_pylist()]
    assert [(r["page_key"], r["record_type"], r["error"]) for r in rows] == [
        ("1", "paragraph", None), ("2", None, "ValueError: beyond this parser"), ("3", None, "no html"), ("4", None, "longer than 40 characters")]


def test_quarantine_table_and_log(spark, store):
    pages = spark.createDataFrame([*GOOD, (50, "http://x/none", None), (51, None, "z" * 500)], PAGE)
    for _ in range(2):  # a retried run replaces its quarantine
        res = run_medallion(spark, pages, P, store, max_page_chars=200)
    assert res.quarantined == 2 and res.counts["bronze"] == 40
    bad = store.read(P.tables.quarantine, run_id=P.run_id).collect()
    assert {(r.page_key, r.source_url, r.error) for r in bad} == {("50", "http://x/none", "no html"), ("51", None, "longer than 200 characters")}
    assert len(bad) == 2
    failed = [r for r in read_log(store, P).collect() if r.status == "failed"]
    assert {(r.source_url, r.layer, r.message) for r in failed} == {("http://x/none", "scrape", "50: no html"), (None, "scrape", "51: longer than 200 characters")}
    # the scrape table of the run is gone, the summary has the page without records
    assert store.read(P.tables.extracts).count() == 0 if store.exists(P.tables.extracts + "/run_id=" + P.run_id) else True
    assert res.summary.where("source_url = 'http://x/none'").first().total_records == 0


def test_every_page_is_parsed_once_and_scraped_rows_are_split(spark):
    tagged = extract_tagged(spark.createDataFrame([*GOOD, (50, "n", None)], PAGE))
    assert tagged.where("error is null").count() == 40 and tagged.where("error is not null").count() == 1


@pytest.mark.parametrize("copies", [1, 4, 256])
def test_repeated_pages_get_ids_of_their_own(spark, copies):
    rows = [*GOOD, *GOOD[:5], *[(7, "http://x/7", "<p>other</p>")] * 3, *[(None, None, "<p>n</p>")] * 2, (None, None, None), (None, None, None), *[(3, "http://x/3", GOOD[3][2])] * 40]
    pages = spark.createDataFrame(rows, PAGE)
    got = distinct_pages(pages, copies)
    assert Counter((r.url, r.html) for r in got.collect()) == Counter((u, h) for _, u, h in rows)
    keys = Counter((r.page_id, r.url) for r in got.collect())
    assert max(keys.values()) == 1 and {r.page_id for r in got.collect()} >= {str(k) for k in (8, 9, 19)}
    recs = extract_records(got, P).cache()
    assert recs.count() == recs.select("record_id").distinct().count()
    b = to_bronze(recs, P)
    s = to_silver(b, P)
    names = G.field_names(s)
    per = [Counter(r.source_url for r in g.collect()) for g in (G.curated_wide_in_row(b, P, names), G.curated_wide(s, P, names), G.curated_map(s, P))]
    assert per[0] == per[1] == per[2]
    plain = {k: {r.source_url: r.total_records for r in x.collect()} for k, x in (("in_row", G.run_summary_in_row(b, P)), ("relational", G.run_summary(s, P)))}
    assert plain["in_row"] == plain["relational"]


def test_unique_pages_keep_their_ids(spark):
    pages = spark.createDataFrame(GOOD, PAGE)
    assert ids(extract_records(distinct_pages(pages), P)) == ids(extract_records(pages, P))
    assert {r.record_id for r in extract_records(distinct_pages(pages), P).collect()} == {r.record_id for r in extract_records(pages, P).collect()}


def test_catalog_tables_get_later_columns(spark, store):
    wide = lambda run, **cols: spark.range(3).select(F.lit(run).alias("run_id"), "id", *[F.lit(v).alias(k) for k, v in cols.items()])
    try:
        store.write(wide("r1", price="1"), "gold", "append", run_id="r1")
        register_tables(spark, store, "pagelake_drift", {"g": "gold"})
        store.write(wide("r2", colour="red", größe="x"), "gold", "append", run_id="r2")
        register_tables(spark, store, "pagelake_drift", {"g": "gold"})
        register_tables(spark, store, "pagelake_drift", {"g": "gold"})  # idempotent
        rows = spark.sql("SELECT run_id, price, colour, `größe` FROM pagelake_drift.gold").collect()
        assert Counter(map(tuple, rows)) == Counter([("r1", "1", None, None)] * 3 + [("r2", None, "red", "x")] * 3)
        store.write(wide("r3", price=1.5), "other", "append", run_id="r3")
        register_tables(spark, store, "pagelake_drift", {"o": "other"})
        store.write(wide("r4", price="x"), "other", "overwrite", run_id="r4")
        with pytest.raises(ValueError, match="changed their type"):
            register_tables(spark, store, "pagelake_drift", {"o": "other"})
    finally:
        spark.sql("DROP DATABASE IF EXISTS pagelake_drift CASCADE")


def test_wide_and_map_gold_share_a_table(spark, store):
    """A field named like the map form's column gets a prefix."""
    html = "<table><tr><th>fields</th></tr><tr><td>v</td></tr></table>"
    pages = spark.createDataFrame([(1, "u", html)], PAGE)
    run_medallion(spark, pages, P, store)
    run_medallion(spark, pages, RunParams.fixed("0002"), store, gold_form="map")
    got = {r.run_id: r for r in store.read(P.tables.gold, merge_schema=True).collect()}
    assert got[P.run_id].field_fields == "v" and got["run-0002"].fields == {"fields": "v"}


def test_a_later_batch_is_a_later_load(spark, store):
    for k in range(2):
        process_batch(spark.createDataFrame([(1, "http://x/1", f"<p>version {k}</p>"), (2 + k, f"http://x/{2 + k}", "<p>y</p>")], PAGE), k, P, store)
    gold = store.read(P.tables.gold, merge_schema=True)
    latest = {(r.source_url, r.text) for r in V.latest_gold_per_url(gold).collect()}
    assert latest == {("http://x/1", "version 1"), ("http://x/2", "y"), ("http://x/3", "y")}
    assert batch_params(P, 3).run_ts > batch_params(P, 2).run_ts and batch_params(P, 3) == batch_params(P, 3)
    with pytest.raises(ValueError, match="overwrite"):
        start_pages_stream(spark, "in", store, "checkpoint", P.with_(load_mode="overwrite"))


def test_output_batches_are_bounded_by_characters():
    import pyarrow as pa

    from pagelake.sources import extract as X

    text = "x" * 300_000
    pages = pa.RecordBatch.from_pydict({"page_key": [str(k) for k in range(40)], "source_url": ["u"] * 40, "html": [f"<p>{text}</p>"] * 40})
    out = list(X._extract_batches([pages]))
    assert sum(b.num_rows for b in out) == 40 and {r for b in out for r in b.column("content_values").to_pylist()[0]} == {text}
    assert max(sum(len(v) for c in b.column("content_values").to_pylist() for v in c) for b in out) < X._OUT_CHARS + len(text)


def test_pages_over_the_limit_are_not_sent_to_python(spark):
    rows = [(1, "<p>" + "\U0001F600" * 17), (2, "<p>" + "\U0001F600" * 18), (3, None), (4, "<p>a")]  # 20 characters are the limit
    pages = spark.createDataFrame([(k, f"u{k}", h) for k, h in rows], "page_id long, url string, html string")
    tagged = extract_tagged(pages, max_chars=20)
    got = {r.page_key: r.error for r in tagged.collect()}
    assert got == {"1": None, "2": "longer than 20 characters", "3": "no html", "4": None}
    as_bytes = extract_tagged(pages.withColumn("html", F.encode("html", "UTF-8")), max_chars=20)
    assert {r.page_key: r.error for r in as_bytes.collect()} == got
    assert "left_out" in tagged._jdf.queryExecution().optimizedPlan().toString()
