"""The run's fields layer: one parse, and silver, gold and summary equal to the forms that parse bronze rows."""

import pytest

from pagelake.operators import gold as G
from pagelake.operators import silver as S
from pagelake.operators.bronze import to_bronze
from pagelake.params import RunParams
from pagelake.plans.medallion import run_medallion
from pagelake.schemas import FIELDS_SCHEMA, column_names
from pagelake.sources.extract import payload_records

P = RunParams.fixed()
PAYLOADS = [(1, '{"Name": " A  b ", "name": "a", "x": "N/A"}'), (2, "{}"), (3, "[1]"), (4, None), (5, "not json"),
            (6, '{"k": null, "K": "", "k ": "v"}'), (7, '{"a": "1", "A": "1", "a ": "1 "}'), (8, '{"only": "-"}'),
            (9, '{"e": "", "s": "  ", "n": null, "v": "same", "w": " other "}')]


@pytest.fixture()
def layers(spark, tmp_path):
    df = spark.createDataFrame(PAYLOADS, "id long, props string")
    to_bronze(payload_records(df, P, "id", "props", "src", "row"), P).write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    S.record_fields(bronze).write.parquet(str(tmp_path / "fields"))
    return bronze, spark.read.parquet(str(tmp_path / "fields"))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_fields_table_follows_its_schema(layers):
    _, fields = layers
    assert [(f.name, f.dataType) for f in fields.schema.fields] == [(f.name, f.dataType) for f in FIELDS_SCHEMA.fields]


def test_layers_equal_those_parsed_from_bronze(layers):
    bronze, fields = layers
    assert _rows(S.silver_of_fields(fields, P)) == _rows(S.to_silver(bronze, P))
    nine = {r.field_name: r.field_value_raw for r in S.silver_of_fields(fields, P).where("field_name in ('e', 's', 'n', 'v', 'w')").collect()}
    assert nine == {"e": "", "s": "  ", "n": None, "v": "same", "w": " other "}
    names = G.field_names(S.to_silver(bronze, P))
    assert names == ["a", "k", "name", "v", "w"]
    assert _rows(G.curated_wide_of_fields(fields, P, names)) == _rows(G.curated_wide_in_row(bronze, P, names))
    assert _rows(G.curated_map_of_fields(fields, P)) == _rows(G.curated_map_in_row(bronze, P))
    extra = bronze.sparkSession.createDataFrame([("none",), (None,)], "source_url string")
    assert _rows(G.run_summary_of_fields(fields, P, extra)) == _rows(G.run_summary_in_row(bronze, P, extra)) == _rows(G.run_summary(S.to_silver(bronze, P), P, extra))


def test_readers_of_the_fields_layer_do_not_parse_and_skip_raw_values(layers):
    _, fields = layers

    def plan(df):
        return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    for df in (G.curated_wide_of_fields(fields, P, ["a"]), G.curated_map_of_fields(fields, P), G.run_summary_of_fields(fields, P)):
        assert "from_json" not in plan(df) and "field_value_clean:array<string>" in plan(df) and "field_value_raw" not in plan(df)
    assert "from_json" not in plan(S.silver_of_fields(fields, P)) and "Exchange" not in plan(S.silver_of_fields(fields, P))


@pytest.mark.parametrize("gold_form", ["wide", "map"])
def test_a_run_parses_payloads_once(spark, store, sample_pages, monkeypatch, gold_form):
    calls = []
    parse = S.parsed_fields
    for module in (S, G):
        monkeypatch.setattr(module, "parsed_fields", lambda c: calls.append(1) or parse(c))
    res = run_medallion(spark, sample_pages, P, store, gold_form=gold_form)
    assert len(calls) == 1 and res.gold.count() > 0
    assert not store.exists(f"{P.tables.fields}/run_id={P.run_id}")
    assert res.silver.columns == S.SILVER_COLUMNS and column_names(FIELDS_SCHEMA)[:7] == list(S.RECORD_KEYS)
