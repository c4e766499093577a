"""Property tests: the extractor on random markup, and the equivalence of
the in-row and relational silver / gold forms on random payloads."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pagelake.operators import gold as G
from pagelake.operators.bronze import to_bronze
from pagelake.operators.silver import to_silver, to_silver_relational
from pagelake.params import RunParams
from pagelake.schemas import RECORD_TYPES
from pagelake.sources.extract import payload_records
from pagelake.sources.html_records import extract

P = RunParams.fixed()

_TAGS = ["p", "a", "b", "table", "tr", "td", "th", "div", "title", "meta", "script", "li", "ul", "br"]
_piece = st.one_of(
    st.sampled_from([f"<{t}>" for t in _TAGS] + [f"</{t}>" for t in _TAGS]),
    st.sampled_from(['<a href="/x">', '<a href="">', '<meta name="n" content="c">', "<!-- c -->",
                     "&amp;", "&amp", "&nbsp;", "<", ">", " ", "\n", "\xa0"]),
    st.text(alphabet="abcXYZ 12é", min_size=1, max_size=6),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(_piece, max_size=60).map("".join))
def test_extractor_total_and_invariants(html):
    recs = extract(html)
    kinds = [r[0] for r in recs]
    order = list(RECORD_TYPES)
    assert kinds == sorted(kinds, key=order.index)  # fixed kind order
    for kind in ("paragraph", "link"):
        idx = [r[2] for r in recs if r[0] == kind]
        assert idx == sorted(set(idx))  # ordinals increase, no repeats
    for rtype, t_idx, r_idx, keys, values in recs:
        assert len(keys) == len(values) == len(set(keys))
        if rtype == "paragraph":
            assert values[0] and values[0] == values[0].strip()
        if rtype == "link":
            assert values[1] != ""
        if rtype == "table_row":
            assert t_idx is not None and r_idx >= 0


_key = st.text(alphabet="aAbB _-#é1", max_size=5)
_val = st.one_of(st.none(), st.sampled_from(["N/A", "-", "", "  ", "None", "NULL"]),
                 st.text(alphabet="ab 1.-\t\n", max_size=6))
_payload = st.one_of(
    st.dictionaries(_key, _val, max_size=6).map(json.dumps),
    st.sampled_from(["null", "{}", "[1]", "x", '{"a": {"b": 1}}']),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_payload, min_size=1, max_size=25))
def test_in_row_and_relational_forms_agree(spark, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "k long, p string")
    b = to_bronze(payload_records(df, P, "k", "p", "t"), P)
    a = sorted(map(tuple, to_silver(b, P).collect()), key=repr)
    r = sorted(map(tuple, to_silver_relational(b, P).collect()), key=repr)
    assert a == r
    s = to_silver(b, P)
    names = G.field_names(s)
    pivot = G.curated_wide(s, P, names).drop("gold_loaded_at")
    cols = pivot.columns
    inrow = G.curated_wide_in_row(b, P, names).drop("gold_loaded_at").select(*cols)
    keys = G.curated_wide_keys_join(s, P, names).drop("gold_loaded_at").select(*cols)
    pv = sorted(map(tuple, pivot.collect()), key=repr)
    assert pv == sorted(map(tuple, inrow.collect()), key=repr)
    assert pv == sorted(map(tuple, keys.collect()), key=repr)
