"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) in
full; the matching DuckDB statement lives in ``oracle_queries``.  Run
parameters are fixed so ids are reproducible and comparable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import gold as G
from ..operators import views as V
from ..operators.bronze import BRONZE_COLUMNS, to_bronze
from ..operators.silver import quality_counts, to_silver, to_silver_relational
from ..params import RunParams
from ..schemas import BRONZE_SCHEMA
from ..session import scratch_dir
from ..sources.extract import distinct_pages, extract_raw, extract_records, payload_records
from ..sources.tables import TableStore, encode_complex, register_tables
from .medallion import EARLIER, run_medallion
from .runlog import read_log

P = RunParams.fixed()
P2 = RunParams.fixed("0002").with_(run_ts=P.run_ts.replace(day=2))


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _silver_of(records: DataFrame, params: RunParams = P) -> DataFrame:
    return to_silver(to_bronze(records, params), params)


def _landed(spark: SparkSession, name: str, records: DataFrame, params: RunParams = P) -> DataFrame:
    """Bronze of ``records``, written and read back: what follows may scan it twice, the records are built once."""
    store, table = _store(spark, name), params.tables.bronze
    store.write(to_bronze(records, params), table, "replace_run", run_id=params.run_id)
    return store.read(table, run_id=params.run_id, columns=BRONZE_COLUMNS, schema=BRONZE_SCHEMA)


def _micros(stamp: str) -> F.Column:
    """A load stamp as microseconds since the epoch, which no time zone changes."""
    return F.unix_micros(stamp).alias(stamp)


# ---------------------------------------------------------------- payloads
def customer_payload(spark, sf_dir, params: RunParams = P) -> DataFrame:
    """Customer rows as a string map payload (numbers as fixed-scale text)."""
    c = _t(spark, sf_dir, "customer")
    payload = F.create_map(
        F.lit("name"), F.col("c_name"),
        F.lit("nationkey"), F.col("c_nationkey").cast("string"),
        F.lit("acctbal"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit("segment"), F.col("c_mktsegment"),
    )
    return payload_records(c, params, "c_custkey", payload, "customer", "row")


# Placeholder-token mix used by the validity check (invalid and near misses).
TOKENS = ("N/A", "n/a", "-", "null", "None", "NULL", "NA", "nan", "", "   ", "none", "ok")


def _token_col() -> F.Column:
    arr = F.array(*[F.lit(t) for t in TOKENS])
    return F.element_at(arr, (F.col("c_custkey") % len(TOKENS) + 1).cast("int"))


# ---------------------------------------------------------------- extraction
def q_extract_paragraphs(spark, sf_dir):
    raw = extract_raw(_t(spark, sf_dir, "pages"), kinds=("paragraph",))
    return raw.select(
        F.col("page_key").cast("long").alias("page_id"), "source_url", "row_index",
        F.col("content_values")[0].alias("text"))


def byte_pages(spark, sf_dir) -> DataFrame:
    """``pages`` as bytes, dealt over four ways that a server may send them: UTF-8 as declared, UTF-16 with a byte order mark,
    Latin-1 as declared, Latin-1 without a declaration. Pages with other signs than Latin-1's stay UTF-8."""
    p = _t(spark, sf_dir, "pages")
    way = F.when(F.col("html").rlike(r"[^\x00-\x7F\x{A0}-\x{FF}]"), 0).otherwise(F.col("page_id") % 4)
    declared = r'(?i)<meta charset="?utf-8"?>'

    def latin(meta):
        return F.encode(F.regexp_replace("html", declared, meta), "ISO-8859-1")

    html = (F.when(way == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode("html", "UTF-16LE"))).when(way == 2, latin('<meta charset="iso-8859-1">'))
            .when(way == 3, latin("")).otherwise(F.encode("html", "UTF-8")))
    return p.select("page_id", "url", html.alias("html"))


def q_extract_byte_pages(spark, sf_dir):
    """Paragraphs of the pages as bytes in several character sets: those of the pages as text."""
    return extract_raw(byte_pages(spark, sf_dir), kinds=("paragraph",)).select(
        F.col("page_key").cast("long").alias("page_id"), "source_url", "row_index", F.col("content_values")[0].alias("text"))


def q_extract_links(spark, sf_dir):
    raw = extract_raw(_t(spark, sf_dir, "pages"), kinds=("link",))
    return raw.select(
        F.col("page_key").cast("long").alias("page_id"), "source_url", "row_index",
        F.element_at(F.map_from_arrays("content_keys", "content_values"), "text").alias("text"),
        F.element_at(F.map_from_arrays("content_keys", "content_values"), "href").alias("href"))


def q_extract_metadata(spark, sf_dir):
    raw = extract_raw(_t(spark, sf_dir, "pages"), kinds=("metadata",))
    m = F.map_from_arrays("content_keys", "content_values")
    return raw.select(
        F.col("page_key").cast("long").alias("page_id"), "source_url", "row_index",
        F.element_at(m, "key").alias("meta_key"), F.element_at(m, "value").alias("meta_value"))


PART_PAGE_ROWS = 1000  # parts per generated page (bounds each page's size)


def _escape_html(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def part_pages(spark, sf_dir) -> DataFrame:
    """One HTML page per (brand, block of part keys): a header row and one
    row per part.  Every tenth part omits its closing cell and row tags,
    which the parser must repair."""
    p = _t(spark, sf_dir, "part")
    cells = [F.col("p_partkey").cast("string"), _escape_html(F.col("p_name")), _escape_html(F.col("p_type")),
             F.col("p_size").cast("string"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")]
    closed = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    open_ = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c) for c in cells])
    row_html = F.when(F.col("p_partkey") % 10 == 0, open_).otherwise(closed)
    block = F.floor(F.col("p_partkey") / PART_PAGE_ROWS)
    rows = p.select("p_brand", block.alias("blk"), F.struct("p_partkey", row_html.alias("h")).alias("r"))
    pages = rows.groupBy("p_brand", "blk").agg(F.min("r.p_partkey").alias("page_id"),
                                                F.array_sort(F.collect_list("r")).alias("rs"))
    header = "<tr><th>Key</th><th>Name</th><th>Type</th><th>Size</th><th>Price</th></tr>"
    html = F.concat(
        F.lit("<html><head><title>"), _escape_html(F.col("p_brand")), F.lit("</title></head><body><table>"),
        F.lit(header), F.array_join(F.transform("rs", lambda x: x["h"]), ""), F.lit("</table></body></html>"))
    url = F.concat(F.lit("https://parts.example/"), F.col("p_brand"), F.lit("/"), F.col("blk").cast("string"))
    return pages.select("page_id", url.alias("url"), html.alias("html"))


def q_extract_table_rows(spark, sf_dir):
    raw = extract_raw(part_pages(spark, sf_dir), kinds=("table_row",))
    m = F.map_from_arrays("content_keys", "content_values")
    return raw.select(
        "source_url", "table_index", "row_index",
        *[F.element_at(m, k).alias(f"part_{k.lower()}") for k in ("Key", "Name", "Type", "Size", "Price")])


CUSTOMER_PAGE_ROWS = 1000  # customers per generated page


def customer_pages(spark, sf_dir) -> DataFrame:
    """One page per (nation, block of customer keys) exercising the
    extraction rules: title and named metas (one without content), an
    empty paragraph, a link with an empty href, and a table whose header
    count (every th, a totals row included) differs from the row width,
    ending in a ragged row."""
    c = _t(spark, sf_dir, "customer")
    block = F.floor(F.col("c_custkey") / CUSTOMER_PAGE_ROWS)
    name = _escape_html(F.col("c_name"))
    item = F.struct(
        "c_custkey",
        F.concat(F.lit("<p>"), name, F.lit("</p>")).alias("p"),
        F.concat(F.lit('<a href="/c/'), F.col("c_custkey").cast("string"), F.lit('">'), name, F.lit("</a>")).alias("a"),
        F.concat(F.lit("<tr><td>"), name, F.lit("</td><td>"), _escape_html(F.col("c_mktsegment")),
                 F.lit("</td></tr>")).alias("tr"),
    )
    g = c.groupBy("c_nationkey", block.alias("blk")).agg(
        F.min("c_custkey").alias("page_id"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(item)).alias("items"))
    nk, n = F.col("c_nationkey").cast("string"), F.col("n").cast("string")

    def join(field):
        return F.array_join(F.transform("items", lambda x: x[field]), "")

    html = F.concat(
        F.lit("<html><head><title>Nation "), nk, F.lit('</title><meta name="nation" content="'), nk,
        F.lit('"><meta property="og:customers" content="'), n, F.lit('"><meta name="empty"></head><body><p></p>'),
        join("p"), F.lit('<a href="">skip</a>'), join("a"),
        F.lit("<table><tr><th>Name</th><th>Segment</th></tr>"), join("tr"),
        F.lit("<tr><th>Total</th><th>"), n, F.lit("</th></tr><tr><td>end</td></tr></table></body></html>"))
    url = F.concat(F.lit("https://customers.example/"), nk, F.lit("/"), F.col("blk").cast("string"))
    return g.select("page_id", url.alias("url"), html.alias("html"))


def q_extract_rules(spark, sf_dir):
    raw = extract_raw(customer_pages(spark, sf_dir))
    kv = F.posexplode(F.arrays_zip("content_keys", "content_values"))
    return raw.select("source_url", "record_type", "table_index", "row_index", kv).select(
        "source_url", "record_type", "table_index", "row_index",
        F.col("pos").alias("field_pos"), F.col("col.content_keys").alias("field_key"),
        F.col("col.content_values").alias("field_value"))


BROKEN = "<![bad[ <p>x"  # a marked section that HTML doesn't know
LONG_PAGE = 150_000


def broken_pages(spark, sf_dir) -> DataFrame:
    """The pages with every 7th without HTML, every 11th beyond the length limit, and every 5th of the others ending in broken markup."""
    p, k = _t(spark, sf_dir, "pages"), F.col("page_id")
    html = (F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.concat("html", F.repeat(F.lit(" "), LONG_PAGE)))
            .when(k % 5 == 0, F.concat("html", F.lit(BROKEN))).otherwise(F.col("html")))
    return p.withColumn("html", html)


def q_extract_quarantine(spark, sf_dir):
    """A run over pages of which some can't be parsed: the quarantine, the run log's rows of it, and the others' records, unchanged."""
    store = _store(spark, "quarantine")
    res = run_medallion(spark, broken_pages(spark, sf_dir), P, store, max_page_chars=LONG_PAGE)
    bad = store.read(P.tables.quarantine).select(F.lit("quarantine").alias("part"), "run_id", "source_url", F.col("page_key").alias("item"), F.col("error").alias("detail"), F.lit(1).cast("long").alias("n"))
    log = read_log(store, P).where("status = 'failed'").select(F.lit("log").alias("part"), "run_id", "source_url", F.col("layer").alias("item"), F.col("message").alias("detail"), F.lit(1).cast("long").alias("n"))
    kept = res.bronze.groupBy("run_id", "source_url", F.col("record_type").alias("item")).agg(F.count_distinct("record_id").alias("n"))
    return bad.unionByName(log).unionByName(kept.select(F.lit("records").alias("part"), "run_id", "source_url", "item", F.lit("").alias("detail"), "n"))


def q_repeated_pages_forms(spark, sf_dir):
    """Every page given twice: records and gold rows of each url, by every form of gold and both summaries."""
    pages = _t(spark, sf_dir, "pages")
    b = _landed(spark, "repeated_pages", extract_records(distinct_pages(pages.unionByName(pages)), P))
    s = to_silver(b, P)
    names = G.field_names(s)
    forms = [("in_row", G.curated_wide_in_row(b, P, names)), ("pivot", G.curated_wide(s, P, names)), ("keys_join", G.curated_wide_keys_join(s, P, names)),
             ("map", G.curated_map(s, P)), ("relational_silver", to_silver_relational(b, P).where("is_valid"))]
    parts = [g.groupBy("source_url").agg(F.count_distinct("record_id").alias("n")).select(F.lit(form).alias("form"), "source_url", "n") for form, g in forms]
    parts += [x.select(F.lit(form).alias("form"), "source_url", F.col("total_records").alias("n")) for form, x in (("summary_in_row", G.run_summary_in_row(b, P)), ("summary_relational", G.run_summary(s, P)))]
    parts += [b.groupBy("source_url").agg(F.count(F.lit(1)).alias("n")).select(F.lit("bronze_rows").alias("form"), "source_url", "n")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_records_union(spark, sf_dir):
    recs = extract_records(_t(spark, sf_dir, "pages"), P)
    return V.record_type_counts(to_bronze(recs, P))


def q_bronze_land(spark, sf_dir):
    b = to_bronze(customer_payload(spark, sf_dir), P)
    m = F.from_json("content", "map<string,string>")
    return b.select("record_id", "record_type", "source_url", "batch_id", "run_id", "environment",
                    "pipeline_layer", F.element_at(m, "name").alias("name"),
                    F.element_at(m, "acctbal").alias("acctbal"), F.element_at(m, "segment").alias("segment"))


def q_bronze_pages(spark, sf_dir):
    b = to_bronze(extract_records(_t(spark, sf_dir, "pages"), P), P)
    return b.select("record_id", "record_type", "row_index", "source_url", "scraped_at", "batch_id", "run_id",
                    F.from_json("content", "map<string,string>")["text"].alias("text"))


# ---------------------------------------------------------------- silver
SILVER_OUT = ["record_id", "field_name", "field_value_raw", "field_value_clean",
              "field_value_numeric", "is_valid"]


def q_silver_long(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    recs = payload_records(e, P, "event_id", "props", "events", "event")
    return _silver_of(recs).select("run_id", "silver_batch_id", "record_type", *SILVER_OUT)


# Payload forms for the edge-case check: the event's own object, then
# forms that parse to no map (or an empty one), then a nested object.
EDGE_FORMS = 8


def q_silver_payload_edges(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    forms = F.array(F.col("props"), F.lit("null"), F.lit(""), F.lit("{}"), F.lit("[1]"), F.lit('"s"'),
                    F.concat(F.lit("{broken"), F.col("props")),
                    F.concat(F.lit('{"a": '), F.col("props"), F.lit("}")))
    payload = F.element_at(forms, (F.col("event_id") % EDGE_FORMS + 1).cast("int"))
    recs = payload_records(e.select("event_id", payload.alias("p")), P, "event_id", "p", "events", "event")
    return _silver_of(recs).select(*SILVER_OUT)


def name_payload(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    payload = F.create_map(
        F.col("p_brand"), F.col("p_name"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit("-Size (cm) ")), F.col("p_size").cast("string"),
        F.concat(F.lit("__"), F.initcap("p_name"), F.lit("!!")), F.col("p_type"),
    )
    return payload_records(p, P, "p_partkey", payload, "part", "row")


def q_silver_name_normalise(spark, sf_dir):
    return _silver_of(name_payload(spark, sf_dir)).select("record_id", "field_name", "field_value_clean")


def q_silver_whitespace(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    recs = payload_records(d, P, "doc_id", F.create_map(F.lit("text"), F.col("text")), "documents", "document")
    return _silver_of(recs).select("record_id", "field_value_clean", "field_value_numeric", "is_valid")


def numeric_payload(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    nk = F.col("c_nationkey").cast("string")
    payload = F.create_map(
        F.lit("acctbal"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit("nationkey"), nk,
        F.lit("plus"), F.concat(F.lit("+"), nk),
        F.lit("trailing_dot"), F.concat(nk, F.lit(".")),
        F.lit("leading_dot"), F.concat(F.lit("."), nk),
        F.lit("zero_padded"), F.concat(F.lit("00"), nk),
        F.lit("exponent"), F.concat(nk, F.lit("e3")),
        F.lit("thousands"), F.concat(nk, F.lit(",299")),
        F.lit("currency"), F.concat(F.lit("$"), nk),
        F.lit("padded"), F.concat(F.lit("  "), nk, F.lit("\t")),
    )
    return payload_records(c, P, "c_custkey", payload, "customer", "row")


def q_silver_numeric(spark, sf_dir):
    return _silver_of(numeric_payload(spark, sf_dir)).select(
        "record_id", "field_name", "field_value_clean", "field_value_numeric")


def validity_payload(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    payload = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("token"), _token_col(),
                           F.lit("missing"), F.lit(None).cast("string"))
    return payload_records(c, P, "c_custkey", payload, "customer", "row")


def q_silver_validity(spark, sf_dir):
    return _silver_of(validity_payload(spark, sf_dir)).select(
        "record_id", "field_name", "field_value_raw", "field_value_clean", "is_valid")


def q_silver_quality_counts(spark, sf_dir):
    return quality_counts(_silver_of(validity_payload(spark, sf_dir)))


def dedup_payload(spark, sf_dir):
    """JSON text with keys that normalise alike, equal and unequal values."""
    p = _t(spark, sf_dir, "part")
    js = F.concat(
        F.lit('{"Name": "'), F.col("p_name"),
        F.lit('", "name ": "  '), F.col("p_name"),
        F.lit('  ", "NAME": "'), F.upper("p_name"),
        F.lit('", "Size": "'), F.col("p_size").cast("string"),
        F.lit('", "size": "'), F.col("p_size").cast("string"), F.lit('"}'))
    return payload_records(p, P, "p_partkey", js, "part", "row")


def q_silver_dedup(spark, sf_dir):
    return _silver_of(dedup_payload(spark, sf_dir)).select(
        "record_id", "field_name", "field_value_raw", "field_value_clean")


def q_silver_relational(spark, sf_dir):
    b = to_bronze(dedup_payload(spark, sf_dir), P)
    return to_silver_relational(b, P).select("record_id", "field_name", "field_value_raw", "field_value_clean")


def q_silver_pages(spark, sf_dir):
    s = _silver_of(extract_records(_t(spark, sf_dir, "pages"), P))
    return s.select("record_id", "record_type", "row_index", "source_url", "field_name",
                    "field_value_clean", "field_value_numeric", "is_valid")


# ---------------------------------------------------------------- gold
def gold_payload(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    payload = F.create_map(
        F.lit("Name"), F.col("c_name"),
        F.lit("nationkey"), F.col("c_nationkey").cast("string"),
        F.lit("acct bal"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit("segment"), F.col("c_mktsegment"),
        F.lit("note"), _token_col(),
        F.lit("balance"), F.concat(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit(" USD")),
    )
    return payload_records(c, P, "c_custkey", payload, "customer", "row")


def _gold_select(g: DataFrame) -> DataFrame:
    return g.drop("gold_loaded_at")


def q_gold_curated(spark, sf_dir):
    s = to_silver(_landed(spark, "gold_curated", gold_payload(spark, sf_dir)), P)
    g = G.curated_wide(s, P)
    return g.withColumn("gold_loaded_at", _micros("gold_loaded_at"))


def q_gold_keys_join(spark, sf_dir):
    s = to_silver(_landed(spark, "gold_keys_join", gold_payload(spark, sf_dir)), P)
    return _gold_select(G.curated_wide_keys_join(s, P))


def q_gold_in_row(spark, sf_dir):
    b = _landed(spark, "gold_in_row", gold_payload(spark, sf_dir))
    names = G.field_names(to_silver(b, P))
    return _gold_select(G.curated_wide_in_row(b, P, names))


def q_gold_curated_pages(spark, sf_dir):
    """Bronze is written once and read for the names and for the rows: every page is parsed once."""
    b = _landed(spark, "gold_pages", extract_records(_t(spark, sf_dir, "pages"), P))
    names = G.field_names(to_silver(b, P))
    return _gold_select(G.curated_wide_in_row(b, P, names))


def q_gold_collision(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    payload = F.create_map(
        F.lit("run_id"), F.col("c_name"),
        F.lit("Record ID"), F.col("c_mktsegment"),
        F.lit("gold_loaded_at"), F.col("c_nationkey").cast("string"),
        F.lit("field_run_id"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
    )
    s = to_silver(_landed(spark, "gold_collision", payload_records(c, P, "c_custkey", payload, "customer", "row")), P)
    return G.curated_wide(s, P).drop("gold_loaded_at")


def q_gold_duplicate_names(spark, sf_dir):
    """Names that normalise alike: the smallest cleaned value, in both wide forms and the map form."""
    b = _landed(spark, "gold_dup", dedup_payload(spark, sf_dir))
    s = to_silver(b, P)
    names = G.field_names(s)
    wide = [(form, g.select("record_id", "name", "size")) for form, g in (
        ("in_row", G.curated_wide_in_row(b, P, names)), ("pivot", G.curated_wide(s, P, names)))]
    wide.append(("map", G.curated_map_in_row(b, P).select("record_id", F.col(G.MAP_COLUMN)["name"].alias("name"), F.col(G.MAP_COLUMN)["size"].alias("size"))))
    parts = [g.select(F.lit(form).alias("form"), "*") for form, g in wide]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_gold_map_form(spark, sf_dir):
    """The map form of gold, one row per record and field; it needs no names, so the pages are parsed once."""
    bronze = to_bronze(extract_records(_t(spark, sf_dir, "pages"), P), P)
    return G.curated_map_in_row(bronze, P).select("record_id", F.explode(G.MAP_COLUMN).alias("field_name", "field_value"))


HEADS = 5  # columns of the long-tail query: two names that all customers have, three of the nations' names


def q_gold_long_tail(spark, sf_dir):
    """A run whose gold has columns for the commonest names and a map for the others: every customer has a name and a segment,
    a name of its nation and one of its own, so the names grow with the table. One row per record and field, with its place."""
    c = _t(spark, sf_dir, "customer")
    payload = F.create_map(
        F.lit("Name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"), F.lit("note"), _token_col(),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.concat(F.lit("key "), F.col("c_custkey").cast("string")), F.col("c_custkey").cast("string"))
    records = payload_records(c, P, "c_custkey", payload, "customer", "row")
    res = run_medallion(spark, None, P, _store(spark, "long_tail"), records=records, gold_form="long_tail", head_columns=HEADS)
    columns = F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in res.field_names]), F.array(*[F.col(f"`{n}`") for n in res.field_names])))
    heads = res.gold.select("record_id", F.lit("column").alias("place"), columns.alias("field_name", "field_value")).where("field_value is not null")
    return heads.unionByName(res.gold.select("record_id", F.lit("map").alias("place"), F.explode(G.MAP_COLUMN).alias("field_name", "field_value")))


def q_run_resumed(spark, sf_dir):
    """A run over ``pages`` that fails in gold (more names than columns allowed) and goes on from there when it is tried again: the log of both."""
    store, pages, limit = _store(spark, "resumed"), _t(spark, sf_dir, "pages"), "spark.sql.pivotMaxValues"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "1")
    try:
        run_medallion(spark, pages, P, store)
    except ValueError:  # logged as the failed layer, which the result shows
        pass
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    run_medallion(spark, pages, P, store, resume=True)
    return read_log(store, P).select("run_id", "layer", "status", "row_count", (F.col("message") == EARLIER).alias("kept"))


def _summary(spark, pages: DataFrame, relational: bool = False) -> DataFrame:
    sources = pages.select(F.col("url").alias("source_url"))
    b = to_bronze(extract_records(pages, P), P)
    s = G.run_summary(to_silver(b, P), P, sources) if relational else G.run_summary_in_row(b, P, sources)
    return s.withColumn("summary_generated_at", _micros("summary_generated_at"))


def q_run_summary(spark, sf_dir):
    return _summary(spark, _t(spark, sf_dir, "pages"))


def q_run_summary_relational(spark, sf_dir):
    """The form for record ids that may repeat."""
    return _summary(spark, _t(spark, sf_dir, "pages"), relational=True)


def q_run_summary_null_source(spark, sf_dir):
    """Every fifth page has no url: a null source is a source."""
    pages = _t(spark, sf_dir, "pages").withColumn("url", F.when(F.col("page_id") % 5 != 0, F.col("url")))
    return _summary(spark, pages)


def q_silver_full_contract(spark, sf_dir):
    """All 14 columns in their order, the stamp as microseconds."""
    s = _silver_of(gold_payload(spark, sf_dir))
    return s.select(*[_micros(c) if c == "cleaned_at" else c for c in s.columns])


def q_encode_complex(spark, sf_dir):
    """Struct, array and map columns as JSON text, as for a sink without nested types."""
    p = _t(spark, sf_dir, "part")
    return encode_complex(p.select(
        "p_partkey", "p_brand", F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).alias("as_struct"),
        F.array("p_brand", "p_type").alias("as_array"),
        F.when(F.col("p_partkey") % 3 != 0, F.create_map(F.lit("type"), F.col("p_type"))).alias("as_map")))


def q_records_by_type(spark, sf_dir):
    return G.records_by_type(_silver_of(extract_records(_t(spark, sf_dir, "pages"), P)))


def q_table_rows_gold(spark, sf_dir):
    b = _landed(spark, "gold_table_rows", extract_records(part_pages(spark, sf_dir), P))
    s = to_silver(b, P)
    return _gold_select(G.curated_wide(s, P))


# ---------------------------------------------------------------- sinks and runs
def _store(spark, name):
    return TableStore(spark, scratch_dir(spark, name))


def q_sink_roundtrip(spark, sf_dir):
    """Silver of events written twice (overwrite, then append of a second
    run), read back with a predicate."""
    e = _t(spark, sf_dir, "events")
    store = _store(spark, "sink_roundtrip")
    for prm, mode in ((P, "overwrite"), (P2, "append")):
        recs = payload_records(e, prm, "event_id", "props", "events", "event")
        store.write(_silver_of(recs, prm), "silver", mode, run_id=prm.run_id)
    return store.read("silver", where="field_value_numeric >= 50").select(
        "run_id", "record_id", "field_name", "field_value_clean", "field_value_numeric")


def _drifting(spark, sf_dir, store: TableStore, after=lambda: None) -> None:
    """Two runs whose gold tables have different columns, appended to one table."""
    c = _t(spark, sf_dir, "customer")
    p1 = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    p2 = F.create_map(F.lit("name"), F.col("c_name"),
                      F.lit("acctbal"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    for prm, pay in ((P, p1), (P2, p2)):
        s = to_silver(_landed(spark, "sink_drift_bronze", payload_records(c, prm, "c_custkey", pay, "customer", "row"), prm), prm)
        store.write(G.curated_wide(s, prm), "gold", "append", run_id=prm.run_id)
        after()


def q_sink_schema_drift(spark, sf_dir):
    """Two runs of different columns, read back with schema merging."""
    store = _store(spark, "sink_drift")
    _drifting(spark, sf_dir, store)
    return store.read("gold", merge_schema=True).select("run_id", "record_id", "name", "segment", "acctbal")


def _from_catalog(spark, name: str, database: str, statement: str) -> DataFrame:
    """What a statement over a database's tables gives, written and read back; the database (not its files) goes."""
    path = scratch_dir(spark, name)
    spark.sql(statement).write.parquet(path)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return spark.read.parquet(path)


def q_catalog_drift(spark, sf_dir):
    """The same two runs through the catalog, registered after each: the table has the columns of both."""
    store, database = _store(spark, "catalog_drift"), f"pagelake_{uuid.uuid4().hex[:12]}"
    _drifting(spark, sf_dir, store, lambda: register_tables(spark, store, database, {"gold": "gold"}))
    return _from_catalog(spark, "catalog_drift_rows", database, f"SELECT run_id, record_id, name, segment, acctbal FROM `{database}`.gold")


def _medallion(spark, sf_dir, name="medallion", params=P):
    store = _store(spark, name)
    return run_medallion(spark, _t(spark, sf_dir, "pages"), params, store)


def q_run_log(spark, sf_dir):
    res = _medallion(spark, sf_dir, "runlog", P.with_(source_label="pages"))
    return read_log(res.store, P).select("run_id", "run_timestamp", "source_url", "layer", "status", "row_count", "message")


def q_run_log_failed(spark, sf_dir):
    """A run whose records carry one null key: bronze fails, the log says so, nothing follows."""
    store = _store(spark, "runlog_failed")
    c = _t(spark, sf_dir, "customer").withColumn("c_custkey", F.when(F.col("c_custkey") != 1, F.col("c_custkey")))
    records = payload_records(c, P, "c_custkey", F.create_map(F.lit("name"), F.col("c_name")), "customer")
    try:
        run_medallion(spark, None, P.with_(source_label="customer"), store, records=records)
    except Exception as exc:  # the failure is this query's subject
        if "null key" not in str(exc):
            raise
    return read_log(store, P).select("run_id", "run_timestamp", "source_url", "layer", "status", "row_count",
                                     F.contains("message", F.lit("null key in c_custkey")).alias("names_the_key"))


def q_sink_append_twice(spark, sf_dir):
    """Two appends under one run id add up; replace_run leaves one copy."""
    e = _t(spark, sf_dir, "events")
    store = _store(spark, "append_twice")
    silver = _silver_of(payload_records(e, P, "event_id", "props", "events", "event"))
    for name, mode in (("added", "append"), ("replaced", "replace_run")):
        store.write(silver, name, mode, run_id=P.run_id)
        store.write(silver, name, mode, run_id=P.run_id)
    parts = [store.read(n).groupBy("run_id", "record_id").agg(F.count(F.lit(1)).alias("copies")).select(F.lit(n).alias("table_name"), "*")
             for n in ("added", "replaced")]
    return parts[0].unionByName(parts[1])


def q_catalog_tables(spark, sf_dir):
    """The layer tables of a run, registered in the catalog and counted by SQL."""
    res = _medallion(spark, sf_dir, "catalog")
    names = [P.tables.bronze, P.tables.silver, P.tables.gold, P.tables.gold_summary, P.tables.run_log]
    database = f"pagelake_{uuid.uuid4().hex[:12]}"
    register_tables(spark, res.store, database, dict(zip(names, names)))
    return _from_catalog(spark, "catalog_rows", database, " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {len(spark.table(f'{database}.{n}').columns)} AS n_columns, count(*) AS row_count FROM `{database}`.`{n}`"
        for n in names))


def q_sink_mode_rules(spark, sf_dir):
    """Run 1 appends, run 2 overwrites: the data layers keep only run 2,
    the summary and the run log keep both runs.  Rows per (table, run)."""
    store = _store(spark, "modes")
    pages = _t(spark, sf_dir, "pages")
    run_medallion(spark, pages, P, store)
    run_medallion(spark, pages, P2.with_(load_mode="overwrite"), store)
    t = P.tables
    parts = []
    for name in (t.bronze, t.silver, t.gold, t.gold_summary):
        df = store.read(name, merge_schema=(name == t.gold))
        parts.append(df.groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "run_id", "row_count"))
    log = read_log(store, P).groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))
    parts.append(log.select(F.lit(t.run_log).alias("table_name"), "run_id", "row_count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_end_to_end_gold(spark, sf_dir):
    return _medallion(spark, sf_dir, "e2e").gold.drop("gold_loaded_at")


def q_view_layer_stats(spark, sf_dir):
    r = _medallion(spark, sf_dir, "stats")
    return V.layer_stats(r.bronze, r.silver, r.gold, r.summary)


def q_view_gold_preview(spark, sf_dir):
    r = _medallion(spark, sf_dir, "preview")
    return V.display_rows(V.gold_preview(r.gold))


def q_view_chart_series(spark, sf_dir):
    s = to_silver(_landed(spark, "chart", gold_payload(spark, sf_dir)), P)
    return V.chart_series(G.curated_wide(s, P), "name", "balance")


def _two_runs(spark, sf_dir, name: str) -> TableStore:
    store = _store(spark, name)
    pages = _t(spark, sf_dir, "pages")
    run_medallion(spark, pages, P, store)
    run_medallion(spark, pages, P2, store)
    return store


def q_view_url_latest(spark, sf_dir):
    """Two runs into one gold table; per source the rows of its latest load."""
    gold = _two_runs(spark, sf_dir, "latest").read(P.tables.gold, merge_schema=True)
    return V.latest_gold_per_url(gold).select("run_id", "record_id", "source_url", "text", "href", "value")


def _load_rank(df: DataFrame, stamp: str) -> DataFrame:
    """``load_rank``: 1 for the newest stamp. The window runs over the distinct stamps, one row per run."""
    ranks = df.select(F.col(stamp).alias("_at")).distinct().withColumn("load_rank", F.row_number().over(Window.orderBy(F.desc("_at"))))
    return df.join(ranks, F.col(stamp) == F.col("_at")).drop("_at")


def q_view_gold_for_url(spark, sf_dir):
    """The curated rows of the first page's url over two loads, newest first."""
    gold = _two_runs(spark, sf_dir, "for_url").read(P.tables.gold, merge_schema=True)
    url = _t(spark, sf_dir, "pages").agg(F.min_by("url", "page_id")).first()[0]
    return _load_rank(V.gold_for_url(gold, url), "gold_loaded_at").select(
        "load_rank", "run_id", "record_id", "source_url", "text", "href", "value", _micros("gold_loaded_at"))


def q_view_summary_latest(spark, sf_dir):
    s = V.summary_latest_first(_two_runs(spark, sf_dir, "summary_latest").read(P.tables.gold_summary))
    return _load_rank(s, "summary_generated_at").select("load_rank", "run_id", "source_url", "total_records", "records_by_type", _micros("summary_generated_at"))


def q_view_run_log_latest(spark, sf_dir):
    log = V.run_log_latest_first(read_log(_two_runs(spark, sf_dir, "log_latest"), P))
    return _load_rank(log, "run_timestamp").select("load_rank", "run_id", "run_timestamp", "layer", "status", "row_count")


QUERIES = {
    "extract_paragraphs": q_extract_paragraphs,
    "extract_byte_pages": q_extract_byte_pages,
    "extract_links": q_extract_links,
    "extract_metadata": q_extract_metadata,
    "extract_table_rows": q_extract_table_rows,
    "extract_rules": q_extract_rules,
    "extract_quarantine": q_extract_quarantine,
    "repeated_pages_forms": q_repeated_pages_forms,
    "records_union": q_records_union,
    "bronze_land": q_bronze_land,
    "bronze_pages": q_bronze_pages,
    "silver_long": q_silver_long,
    "silver_payload_edges": q_silver_payload_edges,
    "silver_name_normalise": q_silver_name_normalise,
    "silver_whitespace": q_silver_whitespace,
    "silver_numeric": q_silver_numeric,
    "silver_validity": q_silver_validity,
    "silver_quality_counts": q_silver_quality_counts,
    "silver_dedup": q_silver_dedup,
    "silver_relational": q_silver_relational,
    "silver_pages": q_silver_pages,
    "gold_curated": q_gold_curated,
    "gold_keys_join": q_gold_keys_join,
    "gold_map_form": q_gold_map_form,
    "gold_long_tail": q_gold_long_tail,
    "gold_in_row": q_gold_in_row,
    "gold_curated_pages": q_gold_curated_pages,
    "gold_collision": q_gold_collision,
    "gold_table_rows": q_table_rows_gold,
    "gold_duplicate_names": q_gold_duplicate_names,
    "run_summary": q_run_summary,
    "run_summary_relational": q_run_summary_relational,
    "run_summary_null_source": q_run_summary_null_source,
    "silver_full_contract": q_silver_full_contract,
    "encode_complex": q_encode_complex,
    "records_by_type": q_records_by_type,
    "sink_roundtrip": q_sink_roundtrip,
    "sink_schema_drift": q_sink_schema_drift,
    "run_log": q_run_log,
    "run_log_failed": q_run_log_failed,
    "run_resumed": q_run_resumed,
    "sink_append_twice": q_sink_append_twice,
    "catalog_tables": q_catalog_tables,
    "catalog_drift": q_catalog_drift,
    "sink_mode_rules": q_sink_mode_rules,
    "end_to_end_gold": q_end_to_end_gold,
    "view_layer_stats": q_view_layer_stats,
    "view_gold_preview": q_view_gold_preview,
    "view_chart_series": q_view_chart_series,
    "view_url_latest": q_view_url_latest,
    "view_gold_for_url": q_view_gold_for_url,
    "view_summary_latest": q_view_summary_latest,
    "view_run_log_latest": q_view_run_log_latest,
}
