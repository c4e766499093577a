"""Plan properties the design relies on (checked on the executed plans)."""

from pyspark.sql import functions as F

from pagelake.operators import gold as G
from pagelake.operators import views as V
from pagelake.operators.bronze import to_bronze
from pagelake.operators.silver import to_silver, to_silver_relational
from pagelake.params import RunParams
from pagelake.sources.extract import extract_records

from conftest import SF_SMALL

P = RunParams.fixed()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _layers(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    bronze = to_bronze(extract_records(pages, P), P)
    return pages, bronze, to_silver(bronze, P)


def test_no_unbounded_broadcasts(spark):
    pages, bronze, silver = _layers(spark)
    summary = G.run_summary(silver, P, sources=pages.select(F.col("url").alias("source_url")))
    assert "BroadcastExchange" not in _plan(summary)
    assert "Join" not in _plan(summary)
    keys = G.curated_wide_keys_join(silver, P, ["href", "key", "text", "value"])
    assert "BroadcastExchange" not in _plan(keys)


def test_latest_per_source_is_one_join_without_a_hint(spark):
    _, bronze, _ = _layers(spark)
    gold = G.curated_wide_in_row(bronze, P, ["href", "key", "text", "value"])
    latest = V.latest_gold_per_url(gold)
    assert _plan(latest).count("Join") >= 1 and "hint" not in latest._jdf.queryExecution().logical().toString().lower()


def test_scans_are_pruned_and_filters_pushed(spark, tmp_path):
    _, bronze, silver = _layers(spark)
    path = str(tmp_path / "silver")
    silver.write.parquet(path)
    s = spark.read.parquet(path)
    plan = _plan(G.curated_wide(s, P, ["href", "text"]))
    assert "PushedFilters: [IsNotNull(is_valid), EqualTo(is_valid,true)]" in plan
    names_plan = _plan(s.filter(F.col("is_valid")).select("field_name").distinct())
    assert "ReadSchema: struct<field_name:string,is_valid:boolean>" in names_plan


def test_no_python_in_the_layers_except_the_parse(spark, tmp_path):
    pages, bronze, _ = _layers(spark)
    assert _plan(bronze).count("MapInArrow") == 1  # the page parse
    # as in the pipeline, the layers start from the written bronze table
    bronze.write.parquet(str(tmp_path / "bronze"))
    b = spark.read.parquet(str(tmp_path / "bronze"))
    silver = to_silver(b, P)
    names = ["href", "key", "text", "value"]
    frames = [
        silver,
        G.curated_wide_in_row(b, P, names),
        G.curated_wide(silver, P, names),
        G.run_summary(silver, P, sources=pages.select(F.col("url").alias("source_url"))),
        V.chart_series(G.curated_wide(silver, P, names), "text", "value"),
    ]
    for df in frames:
        plan = _plan(df)
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"):
            assert node not in plan, node


def test_entry_parses_every_page_once(spark):
    import __spark_entry__ as E

    # the parse ran when bronze was written; names and rows read the written table
    assert "MapInArrow" not in _plan(E.entry(spark))


def test_in_row_summary_has_three_exchanges_and_one_scan(spark, tmp_path):
    pages, bronze, _ = _layers(spark)
    bronze.write.parquet(str(tmp_path / "bronze"))
    b = spark.read.parquet(str(tmp_path / "bronze"))
    plan = _plan(G.run_summary_in_row(b, P))
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("FileScan") == 1 and "Join" not in plan


def _written_silver(spark, tmp_path):
    bronze = _layers(spark)[1]
    bronze.write.parquet(str(tmp_path / "bronze"))
    return to_silver(spark.read.parquet(str(tmp_path / "bronze")), P)


def _spread_first(df, exchanges: int) -> None:
    """So many exchanges, into the session's number of tasks, and below them nothing that sorts or folds a scan split."""
    plan = _plan(df)
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == exchanges, plan
    assert plan.count(f", {n}), REPARTITION_BY_NUM") == exchanges, plan
    below = plan.rsplit("Exchange", 1)[1]
    assert "Aggregate" not in below and "Sort" not in below, plan


def test_grouped_gold_sorts_no_scan_split(spark, tmp_path):
    _spread_first(G.curated_wide(_written_silver(spark, tmp_path), P, ["href", "key", "text", "value"]), 1)


def test_map_gold_sorts_no_scan_split(spark, tmp_path):
    _spread_first(G.curated_map(_written_silver(spark, tmp_path), P), 1)


def test_keys_join_sorts_no_scan_split(spark, tmp_path):
    _spread_first(G.curated_wide_keys_join(_written_silver(spark, tmp_path), P, ["href", "key", "text", "value"]), 2)


def test_relational_silver_sorts_no_scan_split(spark):
    # most record keys are literals here; the grouping must not exchange its rows again
    _spread_first(to_silver_relational(to_bronze(spark.range(10).selectExpr(
        "string(id) as record_id", "'row' as record_type", "int(null) as table_index", "int(null) as row_index",
        """'{"a": "1", "A": "1"}' as content""", "'u' as source_url", "'t' as scraped_at", "'b' as batch_id"), P), P), 1)
