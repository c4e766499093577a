"""Long-tail gold, the lookup layout of written files, and runs that go on where they stopped."""

import pytest
from pyspark.sql import functions as F

import pagelake.plans.medallion as M
from pagelake.operators import gold as G
from pagelake.operators import silver as S
from pagelake.operators import views as V
from pagelake.operators.bronze import to_bronze
from pagelake.params import RunParams
from pagelake.plans.medallion import run_medallion
from pagelake.plans.runlog import read_log
from pagelake.sources.extract import payload_records

P = RunParams.fixed()
ROWS = [(1, '{"a": "1", "b": "x", "run_id": "r"}'), (2, '{"a": "2", "c": "y"}'), (3, '{"b": "N/A", "fields": "f"}'),
        (4, '{"a": "-"}'), (5, "{}"), (6, None), (7, '{"b": "z", "B": "w"}')]


def _records(spark):
    return payload_records(spark.createDataFrame(ROWS, "id long, props string"), P, "id", "props", "src", "row")


@pytest.fixture()
def fields(spark, tmp_path):
    S.record_fields(to_bronze(_records(spark), P)).write.parquet(str(tmp_path / "fields"))
    return spark.read.parquet(str(tmp_path / "fields"))


def test_head_names_are_the_commonest_by_records(fields):
    # a is valid in two records, b in two (its two spellings in one record count once), the others in one
    assert G.head_names(fields, 3) == ["a", "b", "c"]
    assert G.head_names(fields, 0) == [] and len(G.head_names(fields, 99)) == 5
    with pytest.raises(ValueError):
        G.head_names(fields, -1)


@pytest.mark.parametrize("columns", [0, 1, 2, 4, 5])
def test_no_name_is_lost_at_any_limit(fields, columns):
    heads = G.head_names(fields, columns)
    plan = G.column_plan(heads)
    got = {}
    for r in G.curated_long_tail(fields, P, heads).collect():
        here = {n: r[c] for n, c in plan if r[c] is not None}
        assert not set(here) & set(r["fields"])
        got[r.record_id] = {**here, **r["fields"]}
    assert got == {r.record_id: r.fields for r in G.curated_map_of_fields(fields, P).select("record_id", "fields").collect()}
    assert len(got) == 4


def test_long_tail_run_has_no_limit_of_names(spark, store):
    limit = "spark.sql.pivotMaxValues"
    spark.conf.set(limit, "3")
    try:
        with pytest.raises(ValueError):
            run_medallion(spark, None, P, store, records=_records(spark))
        res = run_medallion(spark, None, P, store, records=_records(spark), gold_form="long_tail", head_columns=2)
        with pytest.raises(ValueError):
            run_medallion(spark, None, P, store, records=_records(spark), gold_form="long_tail", head_columns=4)
    finally:
        spark.conf.unset(limit)
    assert res.field_names == ["a", "b"] and res.gold.columns[7:] == ["a", "b", "fields", "gold_loaded_at"]
    assert res.gold.count() == 4
    with pytest.raises(ValueError):
        run_medallion(spark, None, P, store, records=_records(spark), gold_form="long_tail", in_row_gold=False)


def _rows_scanned(df) -> int:
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    raise AssertionError("no scan")


def test_a_lookup_reads_few_of_the_rows(spark, store):
    """Eight files whose ranges of urls overlap: the Bloom filters leave one file, the order within it a few pages."""
    n, url = 160_000, F.concat(F.lit("https://host.example/some/rather/long/path/"), F.sha2(F.col("id").cast("string"), 256))
    gold = spark.range(n).select(F.lit("r").alias("run_id"), url.alias("source_url"), "id").repartition(8, "id")
    for name, lookup in (("plain", None), ("sorted", "source_url")):
        store.write(gold, name, "replace_run", run_id="r", lookup=lookup)
    store.write(gold, "by_run", "replace_run", lookup="source_url")
    one = gold.where("id = 77").first().source_url

    def scanned(name):
        df = store.read(name).where(F.col("source_url") == one)
        assert [r.id for r in df.collect()] == [77]
        return _rows_scanned(df)

    assert scanned("plain") > n // 2
    assert 0 < scanned("sorted") <= n // 8 and 0 < scanned("by_run") <= n // 8
    # a url that no file has
    assert _rows_scanned(store.read("sorted").where(F.col("source_url") == one + "x")) <= n // 8
    assert [r.id for r in V.gold_for_url(store.read("sorted").withColumn("gold_loaded_at", F.current_timestamp()), one).collect()] == [77]


def _counted(monkeypatch, names):
    calls = []
    for name in names:
        monkeypatch.setattr(M, name, lambda *a, _f=getattr(M, name), _n=name, **k: calls.append(_n) or _f(*a, **k))
    return calls


STEPS = ("extract_tagged", "to_bronze", "record_fields", "silver_of_fields", "curated_wide_of_fields")


@pytest.mark.parametrize("failing", STEPS)
def test_a_retry_begins_at_the_first_unfinished_layer(spark, store, sample_pages, monkeypatch, failing):
    with monkeypatch.context() as m:
        m.setattr(M, failing, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_medallion(spark, sample_pages, P, store)
    calls = _counted(monkeypatch, STEPS)
    res = run_medallion(spark, sample_pages, P, store, resume=True)
    assert calls == list(STEPS[STEPS.index(failing):])
    monkeypatch.undo()
    again = run_medallion(spark, sample_pages, P, M.TableStore(spark, store.root + "-2"))
    for table in ("bronze", "silver", "gold", "summary"):
        assert sorted(map(repr, getattr(res, table).collect())) == sorted(map(repr, getattr(again, table).collect()))
    assert res.counts == again.counts and store.committed_layers(P.run_id) == {}
    log = [(r.layer, r.status) for r in read_log(store, P).collect()]
    assert sum(s == "failed" for _, s in log) == 1 and ("gold", "success") in log


def test_markers_of_other_parameters_and_finished_runs_are_not_used(spark, store, sample_pages, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(M, "silver_of_fields", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_medallion(spark, sample_pages, P, store)
    assert set(store.committed_layers(P.run_id)) == {"scrape", "bronze", "fields"}
    calls = _counted(monkeypatch, STEPS)
    run_medallion(spark, sample_pages, P.with_(batch_id="other"), store, resume=True)
    run_medallion(spark, sample_pages, P, store, resume=True)
    assert calls == list(STEPS) * 2
