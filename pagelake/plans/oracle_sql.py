"""DuckDB SQL that states each registered query independently of Spark.

The page oracles re-derive extraction with regular expressions over the
raw HTML (script/style bodies and comments removed, paragraphs split at
``<p>`` and cut at the first closing tag, text nodes unescaped, stripped
and joined); the payload oracles read the base tables directly.  Pieces
are composed with small Python helpers so each query's SQL stays legible.
"""

from __future__ import annotations

from ..params import RunParams

P = RunParams.fixed()
RUN, BATCH, SCRAPED = P.run_id, P.batch_id, P.scraped_at
MICROS = P.run_ts_micros
MICROS2 = P.with_(run_ts=P.run_ts.replace(day=2)).run_ts_micros

# Characters Python's str.strip() removes (RE2 class).
_WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\p{Z}]"


def unescape(x: str) -> str:
    """The entities present in the page corpus, ``&amp;`` last.  Legacy
    names (quot lt gt copy nbsp amp) decode without the semicolon too, as
    HTML5 parsing does."""
    for ent, ch in (("&quot;?", '"'), ("&#39;", "'"), ("&lt;?", "<"), ("&gt;?", ">"),
                    ("&copy;?", "\u00a9"), ("&middot;", "\u00b7"), ("&nbsp;?", "\u00a0")):
        x = f"regexp_replace({x}, '{ent}', '{ch.replace("'", "''")}', 'g')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def node_text(x: str) -> str:
    """Text of an HTML fragment: split at tags, unescape, strip, drop
    empties, join with nothing."""
    return (
        "array_to_string(list_filter(list_transform("
        f"string_split_regex({x}, '<[^>]*>'), "
        f"lambda t: regexp_replace({unescape('t')}, '^{_WS}+|{_WS}+$', '', 'g')), lambda t: t <> ''), '')"
    )


def rid(batch: str, key: str, url: str, rtype: str, tidx: str, ridx: str) -> str:
    """The record id: SHA-256 over '|'-joined lineage text."""
    parts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in (batch, key, url, rtype, tidx, ridx))
    return f"sha256(concat_ws('|', {parts}))"


CLEAN_HTML = (
    "regexp_replace(regexp_replace(regexp_replace(html, "
    "'(?s)<script[^>]*>.*?</script>', '', 'g'), "
    "'(?s)<style[^>]*>.*?</style>', '', 'g'), "
    "'(?s)<!--.*?-->', '<!>', 'g')"
)

PARAGRAPHS = f"""
WITH src AS (SELECT page_id, url, {CLEAN_HTML} AS h FROM pages),
parts AS (
  SELECT page_id, url, string_split_regex(h, '<p(\\s[^>]*)?>') AS l FROM src
),
ps AS (
  SELECT page_id, url, unnest(l[2:]) AS part, unnest(range(0, len(l) - 1)) AS idx FROM parts
),
cut AS (
  SELECT page_id, url, idx,
         regexp_replace(part, '(?s)(</p>|</article>|</div>|</body>|</html>).*$', '') AS body
  FROM ps
)
SELECT page_id, url AS source_url, CAST(idx AS INTEGER) AS row_index, {node_text('body')} AS text
FROM cut WHERE {node_text('body')} <> ''
"""

LINKS = f"""
WITH src AS (SELECT page_id, url, {CLEAN_HTML} AS h FROM pages),
parts AS (
  SELECT page_id, url, regexp_extract_all(h, '(?s)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS l FROM src
),
anchors AS (
  SELECT page_id, url, unnest(l) AS a, unnest(range(0, len(l))) AS idx FROM parts
)
SELECT page_id, url AS source_url, CAST(idx AS INTEGER) AS row_index,
       {node_text("regexp_extract(a, '(?s)^<a[^>]*>(.*)</a>$', 1)")} AS text,
       {unescape("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")} AS href
FROM anchors WHERE regexp_extract(a, 'href="([^"]*)"', 1) <> ''
"""

TITLES = f"""
SELECT page_id, url AS source_url, CAST(0 AS INTEGER) AS row_index, 'title' AS meta_key,
       {node_text("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} AS meta_value
FROM pages WHERE {node_text("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} <> ''
"""

# All page records as (page_id, source_url, record_type, row_index, field, value)
PAGE_FIELDS = f"""
SELECT page_id, source_url, 'paragraph' AS record_type, row_index, 'text' AS field, text AS value
FROM ({PARAGRAPHS})
UNION ALL SELECT page_id, source_url, 'link', row_index, 'text', text FROM ({LINKS})
UNION ALL SELECT page_id, source_url, 'link', row_index, 'href', href FROM ({LINKS})
UNION ALL SELECT page_id, source_url, 'metadata', row_index, 'key', meta_key FROM ({TITLES})
UNION ALL SELECT page_id, source_url, 'metadata', row_index, 'value', meta_value FROM ({TITLES})
"""


def page_rid(tidx: str = "NULL") -> str:
    return rid(f"'{BATCH}'", "page_id", "source_url", "record_type", tidx, "row_index")


# ---------------------------------------------------------------- cleaning rules in SQL
def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '[ \\t\\n\\x{{0B}}\\f\\r]+', ' ', 'g'), ' ')"


def valid(x: str) -> str:
    return f"(length({x}) > 0 AND {x} NOT IN ('N/A', 'n/a', '-', 'null', 'None'))"


def numeric(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({x} AS DOUBLE) END"


def norm(x: str) -> str:
    n = f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '_')"
    return f"CASE WHEN {x} IS NULL OR {n} = '' THEN 'unknown_field' ELSE {n} END"


def gold_value(x: str) -> str:
    """A payload value as gold shows it: cleaned if valid, else null."""
    return f"CASE WHEN {valid(clean(x))} THEN {clean(x)} END"


def cust_rid(batch: str = BATCH) -> str:
    return rid(f"'{batch}'", "c_custkey", "'customer'", "'row'", "NULL", "NULL")


def dec2(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR)"


TOKENS_SQL = "['N/A', 'n/a', '-', 'null', 'None', 'NULL', 'NA', 'nan', '', '   ', 'none', 'ok']"
TOKEN = f"({TOKENS_SQL})[c_custkey % 12 + 1]"
NULL_INT = "CAST(NULL AS INTEGER)"

# Silver rows of the page corpus (fields already extracted, one row each).
PAGE_SILVER = f"""
SELECT {page_rid()} AS record_id, record_type, row_index, source_url, field AS field_name,
       value AS field_value_raw, {clean('value')} AS field_value_clean
FROM ({PAGE_FIELDS})
"""


def _long_payload(table: str, key: str, source: str, rtype: str, pairs: list[tuple[str, str]],
                  batch: str = BATCH) -> str:
    """Rows (record_id, raw key, raw value, position) for a map payload
    built from ``pairs`` of SQL expressions."""
    rid_sql = rid(f"'{batch}'", key, f"'{source}'", f"'{rtype}'", "NULL", "NULL")
    sel = " UNION ALL ".join(
        f"SELECT {rid_sql} AS record_id, {k} AS k, {v} AS v, {i} AS pos FROM {table}"
        for i, (k, v) in enumerate(pairs))
    return sel


def _silver_from_long(long_sql: str) -> str:
    """Normalise, clean, de-duplicate (earliest position wins)."""
    return f"""
    SELECT record_id, field_name, field_value_raw, field_value_clean,
           {numeric('field_value_clean')} AS field_value_numeric,
           {valid('field_value_clean')} AS is_valid
    FROM (
      SELECT record_id, {norm('k')} AS field_name, v AS field_value_raw, {clean('v')} AS field_value_clean,
             row_number() OVER (PARTITION BY record_id, {norm('k')}, {clean('v')} ORDER BY pos) AS rn
      FROM ({long_sql})
    ) WHERE rn = 1
    """


CUSTOMER_GOLD = f"""
SELECT {cust_rid()} AS record_id, 'row' AS record_type, {NULL_INT} AS table_index, {NULL_INT} AS row_index,
       'customer' AS source_url, '{SCRAPED}' AS scraped_at, '{RUN}' AS run_id,
       {gold_value(dec2('c_acctbal'))} AS acct_bal,
       {gold_value(dec2('c_acctbal') + " || ' USD'")} AS balance,
       {gold_value('c_name')} AS name,
       {gold_value('CAST(c_nationkey AS VARCHAR)')} AS nationkey,
       {gold_value(TOKEN)} AS note,
       {gold_value('c_mktsegment')} AS segment
FROM customer
"""


def _page_gold(batch_run: tuple[str, str] = (BATCH, RUN)) -> str:
    batch, run = batch_run
    rid_sql = rid(f"'{batch}'", "page_id", "source_url", "record_type", "NULL", "row_index")
    return f"""
    SELECT {rid_sql} AS record_id, record_type, {NULL_INT} AS table_index, row_index, source_url,
           '{SCRAPED}' AS scraped_at, '{run}' AS run_id,
           max(CASE WHEN field = 'href' AND {valid(clean('value'))} THEN {clean('value')} END) AS href,
           max(CASE WHEN field = 'key' AND {valid(clean('value'))} THEN {clean('value')} END) AS "key",
           max(CASE WHEN field = 'text' AND {valid(clean('value'))} THEN {clean('value')} END) AS text,
           max(CASE WHEN field = 'value' AND {valid(clean('value'))} THEN {clean('value')} END) AS "value"
    FROM ({PAGE_FIELDS})
    GROUP BY ALL
    HAVING count(CASE WHEN {valid(clean('value'))} THEN 1 END) > 0
    """


PAGE_GOLD = _page_gold()

PART_ROWS = """
SELECT 'https://parts.example/' || p_brand || '/' || CAST(CAST(floor(p_partkey / 1000) AS BIGINT) AS VARCHAR) AS source_url,
       CAST(0 AS INTEGER) AS table_index,
       CAST(row_number() OVER (PARTITION BY p_brand, floor(p_partkey / 1000) ORDER BY p_partkey) AS INTEGER) AS row_index,
       CAST(p_partkey AS VARCHAR) AS part_key, p_name AS part_name, p_type AS part_type,
       CAST(p_size AS VARCHAR) AS part_size, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS part_price,
       min(p_partkey) OVER (PARTITION BY p_brand, floor(p_partkey / 1000)) AS page_id
FROM part
"""

PAGE_SUMMARY = f"""
WITH s AS ({PAGE_SILVER}),
s2 AS (SELECT *, {valid('field_value_clean')} AS is_valid FROM s),
per_type AS (
  SELECT source_url, record_type, count(DISTINCT record_id) AS n FROM s2 GROUP BY ALL
)
SELECT '{RUN}' AS run_id, source_url,
       CAST(count(DISTINCT record_id) AS BIGINT) AS total_records,
       CAST(count(*) AS BIGINT) AS total_fields,
       CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid_fields,
       CAST(count(DISTINCT field_name) AS BIGINT) AS distinct_field_names,
       round_even(CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) * 100.0, 2) AS validity_rate_pct,
       (SELECT string_agg(record_type || '=' || CAST(n AS VARCHAR), ', ' ORDER BY record_type)
          FROM per_type p WHERE p.source_url IS NOT DISTINCT FROM s2.source_url) AS records_by_type,
       CAST({MICROS} AS BIGINT) AS summary_generated_at
FROM s2 GROUP BY source_url
"""


CUSTOMER_PAGES = """
SELECT c_custkey, c_name, c_mktsegment,
       'https://customers.example/' || CAST(c_nationkey AS VARCHAR) || '/'
         || CAST(CAST(floor(c_custkey / 1000) AS BIGINT) AS VARCHAR) AS source_url,
       CAST(c_nationkey AS VARCHAR) AS nk,
       CAST(row_number() OVER (PARTITION BY c_nationkey, floor(c_custkey / 1000) ORDER BY c_custkey) AS INTEGER) AS i,
       CAST(count(*) OVER (PARTITION BY c_nationkey, floor(c_custkey / 1000)) AS INTEGER) AS n
FROM customer
"""

EXTRACT_RULES = f"""
WITH c AS ({CUSTOMER_PAGES}),
pg AS (SELECT DISTINCT source_url, nk, n FROM c)
SELECT source_url, 'table_row' AS record_type, 0 AS table_index, i AS row_index, 0 AS field_pos,
       'col_0' AS field_key, c_name AS field_value FROM c
UNION ALL SELECT source_url, 'table_row', 0, i, 1, 'col_1', c_mktsegment FROM c
UNION ALL SELECT source_url, 'table_row', 0, n + 2, 0, 'col_0', 'end' FROM pg
UNION ALL SELECT source_url, 'paragraph', NULL, i, 0, 'text', c_name FROM c
UNION ALL SELECT source_url, 'link', NULL, i, 0, 'text', c_name FROM c
UNION ALL SELECT source_url, 'link', NULL, i, 1, 'href', '/c/' || CAST(c_custkey AS VARCHAR) FROM c
UNION ALL SELECT source_url, 'metadata', NULL, 0, 0, 'key', 'title' FROM pg
UNION ALL SELECT source_url, 'metadata', NULL, 0, 1, 'value', 'Nation ' || nk FROM pg
UNION ALL SELECT source_url, 'metadata', NULL, 1, 0, 'key', 'nation' FROM pg
UNION ALL SELECT source_url, 'metadata', NULL, 1, 1, 'value', nk FROM pg
UNION ALL SELECT source_url, 'metadata', NULL, 2, 0, 'key', 'og:customers' FROM pg
UNION ALL SELECT source_url, 'metadata', NULL, 2, 1, 'value', CAST(n AS VARCHAR) FROM pg
"""


def oracle_queries() -> dict[str, str]:
    page_silver_full = f"""
      SELECT record_id, record_type, row_index, source_url, field_name, field_value_clean,
             {numeric('field_value_clean')} AS field_value_numeric, {valid('field_value_clean')} AS is_valid
      FROM ({PAGE_SILVER})"""
    events_long = _long_payload("events", "event_id", "events", "event",
                                [("'k'", "json_extract_string(props, '$.k')")])
    name_long = _long_payload("part", "p_partkey", "part", "row", [
        ("p_brand", "p_name"),
        ("' ' || p_type || '-Size (cm) '", "CAST(p_size AS VARCHAR)"),
        ("'__' || p_name || '!!'", "p_type")])
    numeric_long = _long_payload("customer", "c_custkey", "customer", "row", [
        ("'acctbal'", dec2("c_acctbal")),
        ("'nationkey'", "CAST(c_nationkey AS VARCHAR)"),
        ("'plus'", "'+' || CAST(c_nationkey AS VARCHAR)"),
        ("'trailing_dot'", "CAST(c_nationkey AS VARCHAR) || '.'"),
        ("'leading_dot'", "'.' || CAST(c_nationkey AS VARCHAR)"),
        ("'zero_padded'", "'00' || CAST(c_nationkey AS VARCHAR)"),
        ("'exponent'", "CAST(c_nationkey AS VARCHAR) || 'e3'"),
        ("'thousands'", "CAST(c_nationkey AS VARCHAR) || ',299'"),
        ("'currency'", "'$' || CAST(c_nationkey AS VARCHAR)"),
        ("'padded'", "'  ' || CAST(c_nationkey AS VARCHAR) || chr(9)")])
    validity_long = _long_payload("customer", "c_custkey", "customer", "row", [
        ("'segment'", "c_mktsegment"), ("'token'", TOKEN), ("'missing'", "CAST(NULL AS VARCHAR)")])
    dedup_long = _long_payload("part", "p_partkey", "part", "row", [
        ("'Name'", "p_name"), ("'name '", "'  ' || p_name || '  '"), ("'NAME'", "upper(p_name)"),
        ("'Size'", "CAST(p_size AS VARCHAR)"), ("'size'", "CAST(p_size AS VARCHAR)")])
    docs_long = _long_payload("documents", "doc_id", "documents", "document", [("'text'", "text")])

    q: dict[str, str] = {}
    q["extract_paragraphs"] = f"SELECT page_id, source_url, row_index, text FROM ({PARAGRAPHS})"
    q["extract_byte_pages"] = q["extract_paragraphs"]
    q["extract_links"] = f"SELECT page_id, source_url, row_index, text, href FROM ({LINKS})"
    q["extract_metadata"] = f"SELECT page_id, source_url, row_index, meta_key, meta_value FROM ({TITLES})"
    q["extract_table_rows"] = f"SELECT * EXCLUDE (page_id) FROM ({PART_ROWS})"
    q["extract_rules"] = f"""
      SELECT source_url, record_type, CAST(table_index AS INTEGER) AS table_index,
             CAST(row_index AS INTEGER) AS row_index, CAST(field_pos AS INTEGER) AS field_pos,
             field_key, field_value
      FROM ({EXTRACT_RULES})"""
    long_page = "(page_id % 11 = 0 OR length(html) + CASE WHEN page_id % 5 = 0 THEN 13 ELSE 0 END > 150000)"
    reason = f"CASE WHEN page_id % 7 = 0 OR html IS NULL THEN 'no html' WHEN {long_page} THEN 'longer than 150000 characters' END"
    q["extract_quarantine"] = f"""
      WITH told AS (SELECT page_id, url, html, {reason} AS error FROM pages),
      pages AS (SELECT page_id, url, CASE WHEN error IS NULL THEN html END AS html FROM told)
      SELECT 'quarantine' AS part, '{RUN}' AS run_id, url AS source_url, CAST(page_id AS VARCHAR) AS item, error AS detail, CAST(1 AS BIGINT) AS n FROM told WHERE error IS NOT NULL
      UNION ALL SELECT 'log', '{RUN}', url, 'scrape', CAST(page_id AS VARCHAR) || ': ' || error, 1 FROM told WHERE error IS NOT NULL
      UNION ALL SELECT 'records', '{RUN}', source_url, record_type, '', CAST(count(*) AS BIGINT)
        FROM (SELECT DISTINCT page_id, source_url, record_type, row_index FROM ({PAGE_FIELDS})) GROUP BY source_url, record_type"""
    every = f"SELECT source_url, CAST(2 * count(*) AS BIGINT) AS n FROM (SELECT DISTINCT page_id, source_url, record_type, row_index FROM ({PAGE_FIELDS})) GROUP BY source_url"
    with_valid = f"SELECT source_url, CAST(2 * count(*) AS BIGINT) AS n FROM (SELECT DISTINCT record_id, source_url FROM ({page_silver_full}) WHERE is_valid) GROUP BY source_url"
    q["repeated_pages_forms"] = " UNION ALL ".join(
        f"SELECT '{form}' AS form, source_url, n FROM ({rows})" for form, rows in (
            *((f, with_valid) for f in ("in_row", "pivot", "keys_join", "map", "relational_silver")), *((f, every) for f in ("summary_in_row", "summary_relational", "bronze_rows"))))
    q["records_union"] = f"""
      SELECT record_type, CAST(count(*) AS BIGINT) AS record_count
      FROM (SELECT DISTINCT page_id, record_type, row_index FROM ({PAGE_FIELDS})) GROUP BY record_type"""
    q["bronze_land"] = f"""
      SELECT {cust_rid()} AS record_id, 'row' AS record_type, 'customer' AS source_url, '{BATCH}' AS batch_id,
             '{RUN}' AS run_id, 'dev' AS environment, 'bronze' AS pipeline_layer, c_name AS name,
             {dec2('c_acctbal')} AS acctbal, c_mktsegment AS segment FROM customer"""
    q["bronze_pages"] = f"""
      SELECT {page_rid()} AS record_id, record_type, row_index, source_url, '{SCRAPED}' AS scraped_at,
             '{BATCH}' AS batch_id, '{RUN}' AS run_id, max(CASE WHEN field = 'text' THEN value END) AS text
      FROM ({PAGE_FIELDS}) GROUP BY ALL"""
    q["silver_long"] = f"""
      SELECT '{RUN}' AS run_id, '{RUN}' AS silver_batch_id, 'event' AS record_type, *
      FROM ({_silver_from_long(events_long)})"""
    ev_rid = rid(f"'{BATCH}'", "event_id", "'events'", "'event'", "NULL", "NULL")
    k_val = "json_extract_string(props, '$.k')"
    q["silver_payload_edges"] = f"""
      SELECT {ev_rid} AS record_id,
             CASE event_id % 8 WHEN 0 THEN 'k' WHEN 7 THEN 'a' ELSE 'unknown_field' END AS field_name,
             CASE event_id % 8 WHEN 0 THEN {k_val} WHEN 7 THEN '{{"k":' || {k_val} || '}}' END AS field_value_raw,
             CASE event_id % 8 WHEN 0 THEN {k_val} WHEN 7 THEN '{{"k":' || {k_val} || '}}' ELSE '' END
               AS field_value_clean,
             CASE WHEN event_id % 8 = 0 THEN TRY_CAST({k_val} AS DOUBLE) END AS field_value_numeric,
             event_id % 8 IN (0, 7) AS is_valid
      FROM events"""
    q["silver_name_normalise"] = f"""
      SELECT record_id, field_name, field_value_clean FROM ({_silver_from_long(name_long)})"""
    q["silver_whitespace"] = f"""
      SELECT record_id, field_value_clean, field_value_numeric, is_valid FROM ({_silver_from_long(docs_long)})"""
    q["silver_numeric"] = f"""
      SELECT record_id, field_name, field_value_clean, field_value_numeric FROM ({_silver_from_long(numeric_long)})"""
    q["silver_validity"] = f"""
      SELECT record_id, field_name, field_value_raw, field_value_clean, is_valid FROM ({_silver_from_long(validity_long)})"""
    q["silver_quality_counts"] = f"""
      SELECT CAST(count(*) AS BIGINT) AS total_fields, CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid_fields,
             CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS invalid_fields
      FROM ({_silver_from_long(validity_long)})"""
    q["silver_dedup"] = f"""
      SELECT record_id, field_name, field_value_raw, field_value_clean FROM ({_silver_from_long(dedup_long)})"""
    q["silver_relational"] = q["silver_dedup"]
    q["silver_pages"] = page_silver_full
    q["gold_curated"] = f"SELECT *, CAST({MICROS} AS BIGINT) AS gold_loaded_at FROM ({CUSTOMER_GOLD})"
    q["gold_keys_join"] = CUSTOMER_GOLD
    q["gold_in_row"] = CUSTOMER_GOLD
    q["gold_curated_pages"] = PAGE_GOLD
    q["gold_map_form"] = " UNION ALL ".join(
        f"SELECT record_id, '{n}' AS field_name, \"{n}\" AS field_value FROM ({PAGE_GOLD}) WHERE \"{n}\" IS NOT NULL"
        for n in ("href", "key", "text", "value"))
    note = "list_value('N/A', 'n/a', '-', 'null', 'None', 'NULL', 'NA', 'nan', '', '   ', 'none', 'ok')[c_custkey % 12 + 1]"
    tail_fields = " UNION ALL ".join(
        f"SELECT {cust_rid()} AS record_id, {name} AS field_name, {gold_value(value)} AS field_value FROM customer"
        for name, value in (("'name'", "c_name"), ("'segment'", "c_mktsegment"), ("'note'", note),
                            ("'nation_' || c_nationkey", dec2("c_acctbal")), ("'key_' || c_custkey", "CAST(c_custkey AS VARCHAR)")))
    q["gold_long_tail"] = f"""
      WITH f AS (SELECT * FROM ({tail_fields}) WHERE field_value IS NOT NULL),
      heads AS (SELECT field_name FROM f GROUP BY field_name ORDER BY count(*) DESC, field_name LIMIT 5)
      SELECT record_id, CASE WHEN field_name IN (SELECT field_name FROM heads) THEN 'column' ELSE 'map' END AS place,
             field_name, field_value FROM f"""
    q["gold_collision"] = f"""
      SELECT {cust_rid()} AS record_id, 'row' AS record_type, {NULL_INT} AS table_index, {NULL_INT} AS row_index,
             'customer' AS source_url, '{SCRAPED}' AS scraped_at, '{RUN}' AS run_id,
             {gold_value('c_name')} AS field_field_run_id,
             {gold_value('c_mktsegment')} AS field_record_id,
             {gold_value('CAST(c_nationkey AS VARCHAR)')} AS field_gold_loaded_at,
             {gold_value(dec2('c_acctbal'))} AS field_run_id
      FROM customer"""
    q["gold_table_rows"] = f"""
      SELECT {rid(f"'{BATCH}'", "page_id", "source_url", "'table_row'", "table_index", "row_index")} AS record_id,
             'table_row' AS record_type, table_index, row_index, source_url, '{SCRAPED}' AS scraped_at,
             '{RUN}' AS run_id, part_key AS "key", part_name AS name, part_price AS price, part_size AS size,
             part_type AS type, CAST(NULL AS VARCHAR) AS "value"
      FROM ({PART_ROWS})
      UNION ALL
      SELECT DISTINCT {rid(f"'{BATCH}'", "page_id", "source_url", "'metadata'", "NULL", "0")}, 'metadata', {NULL_INT},
             0, source_url, '{SCRAPED}', '{RUN}', 'title', NULL, NULL, NULL, NULL, p_brand
      FROM (SELECT p_brand, page_id, source_url FROM ({PART_ROWS.replace("p_name AS part_name", "p_name AS part_name, p_brand")}))"""
    q["gold_duplicate_names"] = " UNION ALL ".join(
        f"""SELECT '{form}' AS form, record_id, min(CASE WHEN field_name = 'name' AND is_valid THEN field_value_clean END) AS name,
                   min(CASE WHEN field_name = 'size' AND is_valid THEN field_value_clean END) AS size
            FROM ({_silver_from_long(dedup_long)}) GROUP BY record_id""" for form in ("in_row", "pivot", "map"))
    q["run_summary"] = PAGE_SUMMARY
    q["run_summary_relational"] = PAGE_SUMMARY
    q["run_summary_null_source"] = PAGE_SUMMARY.replace(
        "FROM pages", "FROM (SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN url END AS url, html FROM pages)")
    gold_long = _long_payload("customer", "c_custkey", "customer", "row", [
        ("'Name'", "c_name"), ("'nationkey'", "CAST(c_nationkey AS VARCHAR)"), ("'acct bal'", dec2("c_acctbal")),
        ("'segment'", "c_mktsegment"), ("'note'", TOKEN), ("'balance'", dec2("c_acctbal") + " || ' USD'")])
    q["silver_full_contract"] = f"""
      SELECT '{RUN}' AS run_id, '{RUN}' AS silver_batch_id, record_id, 'row' AS record_type, {NULL_INT} AS table_index,
             {NULL_INT} AS row_index, field_name, field_value_raw, field_value_clean, field_value_numeric, is_valid,
             'customer' AS source_url, '{SCRAPED}' AS scraped_at, CAST({MICROS} AS BIGINT) AS cleaned_at
      FROM ({_silver_from_long(gold_long)})"""
    q["encode_complex"] = """
      SELECT p_partkey, p_brand, '{"size":' || p_size || ',"brand":"' || p_brand || '"}' AS as_struct,
             '["' || p_brand || '","' || p_type || '"]' AS as_array,
             CASE WHEN p_partkey % 3 <> 0 THEN '{"type":"' || p_type || '"}' END AS as_map
      FROM part"""
    q["records_by_type"] = f"""
      SELECT '{RUN}' AS run_id, source_url, record_type, CAST(count(DISTINCT record_id) AS BIGINT) AS record_count
      FROM ({PAGE_SILVER}) GROUP BY ALL"""
    q["sink_roundtrip"] = " UNION ALL ".join(
        f"""SELECT '{run}' AS run_id, record_id, field_name, field_value_clean, field_value_numeric
            FROM ({_silver_from_long(_long_payload('events', 'event_id', 'events', 'event',
                                                   [("'k'", "json_extract_string(props, '$.k')")], batch))})
            WHERE field_value_numeric >= 50"""
        for run, batch in ((RUN, BATCH), ("run-0002", "batch-0002")))
    q["sink_schema_drift"] = f"""
      SELECT '{RUN}' AS run_id, {cust_rid()} AS record_id, {gold_value('c_name')} AS name,
             {gold_value('c_mktsegment')} AS segment, CAST(NULL AS VARCHAR) AS acctbal FROM customer
      UNION ALL
      SELECT 'run-0002', {cust_rid('batch-0002')}, {gold_value('c_name')}, CAST(NULL AS VARCHAR),
             {gold_value(dec2('c_acctbal'))} FROM customer"""
    q["catalog_drift"] = q["sink_schema_drift"]
    n_rec = f"(SELECT count(*) FROM (SELECT DISTINCT page_id, record_type, row_index FROM ({PAGE_FIELDS})))"
    n_sil = f"(SELECT count(*) FROM ({PAGE_SILVER}))"
    n_gold = f"(SELECT count(*) FROM ({PAGE_GOLD}))"
    q["run_log"] = " UNION ALL ".join(
        f"SELECT '{RUN}' AS run_id, '{P.run_timestamp}' AS run_timestamp, 'pages' AS source_url, '{layer}' AS layer, "
        f"'success' AS status, CAST({n} AS BIGINT) AS row_count, '' AS message"
        for layer, n in (("bronze", n_rec), ("silver", n_sil), ("gold", n_gold)))
    q["run_resumed"] = " UNION ALL ".join(
        f"SELECT '{RUN}' AS run_id, '{layer}' AS layer, '{status}' AS status, CAST({n} AS BIGINT) AS row_count, {kept} AS kept"
        for layer, status, n, kept in (("bronze", "success", n_rec, "false"), ("silver", "success", n_sil, "false"), ("gold", "failed", 0, "false"),
                                       ("bronze", "success", n_rec, "true"), ("silver", "success", n_sil, "true"), ("gold", "success", n_gold, "false")))
    # some customer has the key 1, so the run must fail
    q["run_log_failed"] = f"""
      SELECT '{RUN}' AS run_id, '{P.run_timestamp}' AS run_timestamp, 'customer' AS source_url, 'bronze' AS layer,
             'failed' AS status, CAST(0 AS BIGINT) AS row_count, true AS names_the_key
      FROM customer WHERE c_custkey = 1"""
    q["sink_append_twice"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{RUN}' AS run_id, record_id, CAST({n} * count(*) AS BIGINT) AS copies FROM ({_silver_from_long(events_long)}) GROUP BY record_id"
        for name, n in (("added", 2), ("replaced", 1)))
    n_pages = "(SELECT count(*) FROM pages)"
    q["catalog_tables"] = " UNION ALL ".join(
        f"SELECT '{tbl}' AS table_name, {cols} AS n_columns, CAST({n} AS BIGINT) AS row_count"
        for tbl, cols, n in (("bronze_scraped_data", 12, n_rec), ("silver_cleaned_data", 14, n_sil), ("gold_curated_data", 12, n_gold),
                             ("gold_data_summary", 9, n_pages), ("pipeline_run_log", 7, 3)))
    q["sink_mode_rules"] = " UNION ALL ".join(
        f"SELECT '{tbl}' AS table_name, '{run}' AS run_id, CAST({n} AS BIGINT) AS row_count"
        for tbl, run, n in (
            ("bronze_scraped_data", "run-0002", n_rec), ("silver_cleaned_data", "run-0002", n_sil),
            ("gold_curated_data", "run-0002", n_gold),
            ("gold_data_summary", RUN, n_pages), ("gold_data_summary", "run-0002", n_pages),
            ("pipeline_run_log", RUN, 3), ("pipeline_run_log", "run-0002", 3)))
    q["end_to_end_gold"] = PAGE_GOLD
    q["view_layer_stats"] = f"""
      SELECT CAST({n_rec} AS BIGINT) AS bronze_count, CAST({n_sil} AS BIGINT) AS silver_count,
             round_even(CAST((SELECT count(*) FROM ({PAGE_SILVER}) WHERE {valid('field_value_clean')}) AS DOUBLE)
                        / {n_sil} * 100.0, 2) AS silver_validity_pct,
             CAST({n_rec} AS BIGINT) AS gold_count, CAST({n_gold} AS BIGINT) AS gold_rows"""
    q["view_gold_preview"] = f"""
      SELECT record_id, record_type, coalesce(CAST(table_index AS VARCHAR), '') AS table_index,
             coalesce(CAST(row_index AS VARCHAR), '') AS row_index, source_url, scraped_at, run_id,
             coalesce(href, '') AS href, coalesce("key", '') AS "key", coalesce(text, '') AS text,
             coalesce("value", '') AS "value"
      FROM ({PAGE_GOLD}) ORDER BY source_url, record_id LIMIT 50"""
    q["view_chart_series"] = f"""
      SELECT coalesce(name, '') AS label,
             TRY_CAST(regexp_extract(balance, '^[\\t\\n\\x{{0B}}\\f\\r \\x{{A0}}\\x{{FEFF}}\\p{{Zs}}\\x{{2028}}\\x{{2029}}]*([+-]?(?:Infinity|(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?))', 1) AS DOUBLE) AS value
      FROM ({CUSTOMER_GOLD}) WHERE value IS NOT NULL"""
    latest = _page_gold(("batch-0002", "run-0002"))
    q["view_url_latest"] = f"SELECT run_id, record_id, source_url, text, href, \"value\" FROM ({latest})"
    q["view_gold_for_url"] = " UNION ALL ".join(
        f"""SELECT {rank} AS load_rank, run_id, record_id, source_url, text, href, "value", CAST({at} AS BIGINT) AS gold_loaded_at
            FROM ({_page_gold((batch, run))}) WHERE source_url = (SELECT arg_min(url, page_id) FROM pages)"""
        for rank, batch, run, at in ((1, "batch-0002", "run-0002", MICROS2), (2, BATCH, RUN, MICROS)))
    q["view_summary_latest"] = " UNION ALL ".join(
        f"""SELECT {rank} AS load_rank, '{run}' AS run_id, source_url, total_records, records_by_type, CAST({at} AS BIGINT) AS summary_generated_at
            FROM ({PAGE_SUMMARY})""" for rank, run, at in ((1, "run-0002", MICROS2), (2, RUN, MICROS)))
    q["view_run_log_latest"] = " UNION ALL ".join(
        f"SELECT {rank} AS load_rank, '{run}' AS run_id, '{at}' AS run_timestamp, '{layer}' AS layer, 'success' AS status, CAST({n} AS BIGINT) AS row_count"
        for rank, run, at in ((1, "run-0002", P.with_(run_ts=P.run_ts.replace(day=2)).run_timestamp), (2, RUN, P.run_timestamp))
        for layer, n in (("bronze", n_rec), ("silver", n_sil), ("gold", n_gold)))
    return q
