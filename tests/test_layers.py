"""Bronze / silver / gold on the golden fixture and on edge payloads."""

import pytest
from pyspark.sql import functions as F

from pagelake.operators import gold as G
from pagelake.operators.bronze import BRONZE_COLUMNS, to_bronze
from pagelake.operators.silver import SILVER_COLUMNS, quality_counts, to_silver, to_silver_relational
from pagelake.params import RunParams
from pagelake.sources.extract import extract_records, payload_records

P = RunParams.fixed()


@pytest.fixture()
def sample(spark, sample_pages):
    bronze = to_bronze(extract_records(sample_pages, P), P)
    silver = to_silver(bronze, P)
    return bronze, silver


def test_golden_fixture(sample):
    bronze, silver = sample
    assert bronze.columns == BRONZE_COLUMNS
    assert silver.columns == SILVER_COLUMNS
    assert bronze.count() == 11
    assert sorted(r[0] for r in bronze.groupBy("record_type").count().collect()) == [
        "link", "metadata", "paragraph", "table_row"]
    q = quality_counts(silver).first()
    assert (q.total_fields, q.valid_fields, q.invalid_fields) == (24, 22, 2)
    assert silver.filter(F.col("field_value_numeric").isNotNull()).count() == 5
    names = G.field_names(silver)
    assert names == ["cup", "drink", "href", "key", "pot", "text", "value"]
    gold = G.curated_wide(silver, P, names)
    assert gold.count() == 11 and len(gold.columns) == 15
    grey = gold.filter((F.col("record_type") == "table_row") & (F.col("row_index") == 2)).first()
    assert (grey.drink, grey.cup, grey.pot) == ("Earl Grey", "2.90", None)
    for s in (G.run_summary(silver, P).first(), G.run_summary_in_row(bronze, P).first()):
        assert (s.total_records, s.total_fields, s.valid_fields, s.distinct_field_names) == (11, 24, 22, 7)
        assert s.validity_rate_pct == 91.67
        assert s.records_by_type == "link=3, metadata=2, paragraph=2, table_row=4"


def test_record_ids_are_deterministic_and_unique(spark, sample_pages):
    a = extract_records(sample_pages, P).select("record_id").collect()
    b = extract_records(sample_pages, P).select("record_id").collect()
    assert sorted(a) == sorted(b)
    assert len(set(a)) == len(a) == 11
    other = extract_records(sample_pages, RunParams.fixed("0002")).select("record_id").collect()
    assert not set(a) & set(other)


def _payload_silver(spark, payloads, relational=False):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "k long, p string")
    b = to_bronze(payload_records(df, P, "k", "p", "t"), P)
    return (to_silver_relational if relational else to_silver)(b, P)


EDGE = ['null', '', '{}', '[1]', '"s"', '{broken', '{"a": {"b": 1}}', '{"a": 1, "a": 2}',
        '{"x": 1e3}', '{"Price": "1", "price ": " 1 ", "PRICE": "2"}', None]


@pytest.mark.parametrize("relational", [False, True])
def test_payload_edge_cases(spark, relational):
    s = _payload_silver(spark, EDGE, relational)
    rows = {}
    for r in s.select(F.col("record_id"), "field_name", "field_value_raw", "field_value_clean", "is_valid").collect():
        rows.setdefault(r[0], []).append(tuple(r[1:]))
    ids = [r[0] for r in payload_records(
        spark.createDataFrame([(i, p) for i, p in enumerate(EDGE)], "k long, p string"), P, "k", "p", "t")
        .orderBy("k").select("record_id").collect()]
    by = [sorted(rows[i], key=str) for i in ids]
    null_row = [("unknown_field", None, "", False)]
    for i in (0, 1, 2, 3, 4, 5, 10):
        assert by[i] == null_row, (EDGE[i], by[i])
    assert by[6] == [("a", '{"b":1}', '{"b":1}', True)]
    assert by[7] == [("a", "1", "1", True), ("a", "2", "2", True)]
    assert by[8] == [("x", "1000.0", "1000.0", True)]
    # "Price"/"price " clean to the same value: the earlier position wins
    assert by[9] == [("price", "1", "1", True), ("price", "2", "2", True)]


def test_in_row_equals_relational_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    b = to_bronze(extract_records(pages, P), P)
    a, r = to_silver(b, P), to_silver_relational(b, P)
    assert a.exceptAll(r).count() == 0 and r.exceptAll(a).count() == 0


def test_gold_forms_agree_and_take_smallest_value(spark):
    s = _payload_silver(spark, ['{"Price": "9", "price ": "10", "name": "x"}', '{"n/a": "N/A"}'])
    names = G.field_names(s)
    assert names == ["name", "price"]
    pivot = G.curated_wide(s, P, names).drop("gold_loaded_at")
    keys = G.curated_wide_keys_join(s, P, names).drop("gold_loaded_at").select(*pivot.columns)
    df = spark.createDataFrame([(0, '{"Price": "9", "price ": "10", "name": "x"}'), (1, '{"n/a": "N/A"}')],
                               "k long, p string")
    b = to_bronze(payload_records(df, P, "k", "p", "t"), P)
    inrow = G.curated_wide_in_row(b, P, names).drop("gold_loaded_at").select(*pivot.columns)
    for x, y in ((pivot, keys), (pivot, inrow)):
        assert sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
    rows = pivot.collect()
    assert len(rows) == 1 and rows[0].price == "10" and rows[0].name == "x"  # "10" < "9" as text


def test_collision_renaming():
    plan = G.column_plan(["field_run_id", "gold_loaded_at", "record_id", "run_id", "x"])
    assert plan == [("field_run_id", "field_run_id"), ("gold_loaded_at", "field_gold_loaded_at"),
                    ("record_id", "field_record_id"), ("run_id", "field_field_run_id"), ("x", "x")]


def test_collision_in_gold(spark):
    s = _payload_silver(spark, ['{"run_id": "a", "Record ID": "b", "gold_loaded_at": "c"}'])
    g = G.curated_wide(s, P)
    assert sorted(c for c in g.columns if c.startswith("field_")) == [
        "field_gold_loaded_at", "field_record_id", "field_run_id"]
    r = g.first()
    assert (r.field_run_id, r.field_record_id, r.field_gold_loaded_at, r.run_id) == ("a", "b", "c", P.run_id)


def test_too_many_names_raise_in_every_wide_form(spark):
    s = _payload_silver(spark, ['{"a": "1", "b": "2", "c": "3"}', '{"a": "4"}'])
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        names = G.field_names(s)
        assert len(names) == 3  # limit + 1: the caller can see it is exceeded
        for wide in (G.curated_wide, G.curated_wide_keys_join, G.curated_wide_in_row):
            with pytest.raises(ValueError, match="pivotMaxValues"):
                wide(s, P, names)
        g = G.curated_map(s, P)
        assert dict(g.dtypes)[G.MAP_COLUMN] == "map<string,string>"
        maps = sorted([sorted(r[G.MAP_COLUMN].items()) for r in g.collect()])
        assert maps == [[("a", "1"), ("b", "2"), ("c", "3")], [("a", "4")]]
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_gold_drops_records_without_valid_fields_summary_counts_them(spark):
    s = _payload_silver(spark, ['{"a": "N/A"}', '{"a": "1"}', '{}'])
    assert G.curated_wide(s, P).count() == 1
    summ = G.run_summary(s, P).first()
    assert (summ.total_records, summ.total_fields, summ.valid_fields) == (3, 3, 1)
    assert summ.validity_rate_pct == 33.33


def test_summary_includes_sources_without_records(spark, sample_pages):
    empty = spark.createDataFrame([(2, "https://empty.example/", "<html></html>")], "page_id long, url string, html string")
    pages = sample_pages.unionByName(empty)
    s = to_silver(to_bronze(extract_records(pages, P), P), P)
    rows = {r.source_url: r for r in G.run_summary(s, P, sources=pages.select(F.col("url").alias("source_url"))).collect()}
    e = rows["https://empty.example/"]
    assert (e.total_records, e.total_fields, e.validity_rate_pct, e.records_by_type) == (0, 0, 0.0, "")
    assert rows["https://tearoom.example/menu"].total_records == 11


def test_silver_plan_has_no_exchange(spark, sample):
    bronze, _ = sample
    plan = to_silver(bronze, P)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    inrow = G.curated_wide_in_row(bronze, P, ["href"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in inrow


def test_bronze_missing_payload_is_json_null(spark):
    df = spark.createDataFrame([("id1", None)], "record_id string, content map<string,string>")
    df = df.select("record_id", F.lit("x").alias("record_type"), F.lit(None).cast("int").alias("table_index"),
                   F.lit(None).cast("int").alias("row_index"), "content", F.lit("u").alias("source_url"),
                   F.lit("t").alias("scraped_at"), F.lit("b").alias("batch_id"))
    assert to_bronze(df, P).first().content == "null"


def test_parse_tasks_are_an_explicit_choice(spark, sample_pages):
    from pagelake.sources.extract import extract_raw

    few = sample_pages.coalesce(1)
    assert "Exchange" not in extract_raw(few)._jdf.queryExecution().executedPlan().toString()
    assert extract_raw(few, tasks=3).rdd.getNumPartitions() == 3


def test_in_row_summary_equals_the_relational_one(spark):
    s = [(1, '{"a": "N/A"}'), (2, '{"a": "1", "A ": "1", "b": "x"}'), (3, "{}"), (4, "null"), (5, None)]
    df = spark.createDataFrame(s, "k long, p string")
    b = to_bronze(payload_records(df, P, "k", "p", "t"), P)
    b = b.withColumn("source_url", F.when(F.col("content").contains("N/A"), F.lit(None)).otherwise(F.col("source_url")))
    sources = spark.createDataFrame([("t",), ("none",), (None,)], "source_url string")
    one = sorted(G.run_summary(to_silver(b, P), P, sources=sources).collect(), key=str)
    assert one == sorted(G.run_summary_in_row(b, P, sources=sources).collect(), key=str) and len(one) == 3


def test_bronze_rejects_null_record_id(spark):
    df = spark.createDataFrame([(None, "{}")], "record_id string, content string")
    df = df.select("record_id", F.lit("x").alias("record_type"), F.lit(None).cast("int").alias("table_index"),
                   F.lit(None).cast("int").alias("row_index"), "content", F.lit("u").alias("source_url"),
                   F.lit("t").alias("scraped_at"), F.lit("b").alias("batch_id"))
    with pytest.raises(Exception, match="record_id is null"):
        to_bronze(df, P).collect()


def test_payload_key_must_not_be_null(spark):
    df = spark.createDataFrame([(None, "{}")], "k long, p string")
    with pytest.raises(Exception, match="null key"):
        payload_records(df, P, "k", "p", "t").collect()


def test_records_from_dicts_to_bronze(spark):
    from pagelake.sources.extract import records_from_dicts

    recs = [
        {"record_id": "r1", "record_type": "table_row", "table_index": 0, "row_index": 1,
         "content": {"Product": "Widget A", "Price": 19.99}, "source_url": "u"},
        {"record_id": "r2", "record_type": "paragraph", "row_index": 0, "content": None, "source_url": "u"},
    ]
    b = {r.record_id: r for r in to_bronze(records_from_dicts(spark, recs, P), P).collect()}
    assert b["r1"].table_index == 0 and b["r1"].batch_id == P.batch_id and b["r1"].scraped_at == P.scraped_at
    assert b["r2"].table_index is None and b["r2"].content == "null"
    s = {(r.record_id, r.field_name): r.field_value_clean for r in to_silver(to_bronze(
        records_from_dicts(spark, recs, P), P), P).collect()}
    assert s == {("r1", "product"): "Widget A", ("r1", "price"): "19.99", ("r2", "unknown_field"): ""}
    with pytest.raises(Exception, match="record_id is null"):
        to_bronze(records_from_dicts(spark, [{"record_type": "x"}], P), P).collect()


def test_summary_keeps_null_sources(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, "<p>b</p><p>c</p>")], "page_id long, url string, html string")
    s = to_silver(to_bronze(extract_records(pages, P), P), P)
    got = {r.source_url: (r.total_records, r.distinct_field_names) for r in G.run_summary(s, P, sources=pages.selectExpr("url AS source_url")).collect()}
    assert set(got) == {"u", None} and got[None][0] == got["u"][0] + 1 and got[None][1] == got["u"][1]
