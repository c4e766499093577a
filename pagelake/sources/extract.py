"""Sources: pages -> typed records, and payload tables -> typed records.

``extract_records`` parses each page in a ``mapInArrow`` task (Arrow
batches in and out, no pandas, no shuffle); everything after the parse is
native.  A page that can't be parsed becomes a row with its error, beside the records of the others.
``payload_records`` turns any table with a JSON (or map/struct) payload
into the same record shape, so every later layer works on both.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import record_id
from ..params import RunParams
from ..schemas import EXTRACT_SCHEMA, PAGES_SCHEMA, PAYLOAD_MAP, RECORD_TYPES, TAGGED_SCHEMA, column_names
from ..session import ship_package

log = logging.getLogger("pagelake.extract")

_EXTRACT_COLS = column_names(EXTRACT_SCHEMA)
# records, and characters of their contents, per Arrow batch handed back to Spark
_OUT_BATCH, _OUT_CHARS = 20_000, 4_000_000


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages table ``(page_id, url, html)``.

    ``fmt='parquet'`` reads a pages table, whose ``html`` is text or bytes; ``fmt='html'`` reads a folder of
    HTML files as bytes, one page per file, the file path being the URL and a hash
    of it the page id.  Bytes become text where the page is parsed (``charset``).
    """
    if fmt == "parquet":
        return spark.read.parquet(path).select(*column_names(PAGES_SCHEMA))
    if fmt == "html":
        df = spark.read.format("binaryFile").load(path)
        url = F.col("_metadata.file_path")
        return df.select(
            F.xxhash64(url).alias("page_id"), url.alias("url"), F.col("content").alias("html"))
    raise ValueError(f"unknown pages format {fmt!r}")


def _extract_batches(batches, kinds=RECORD_TYPES, max_chars=None):
    """Arrow batches of pages in, Arrow batches of tagged records out (at most
    ``_OUT_BATCH`` records and, but for the last of them, ``_OUT_CHARS`` characters each, so output batches stay bounded however many
    records the pages hold).  A batch's pages become text one by one: beside the batch itself a task holds one page, its
    records and one output batch.  A page without HTML, longer than ``max_chars`` or beyond
    the parser gives one row with the error instead of records."""
    import pyarrow as pa

    from .charset import page_text
    from .html_records import extract

    schema = _arrow_schema()
    cols: list[list] = [[] for _ in schema.names]
    chars = 0

    def flush():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)
        for c in cols:
            c.clear()
        return batch

    too_long = f"longer than {max_chars} characters"

    def rows_of(html):
        if html is None:
            return [], "no html"
        if isinstance(html, bytes):
            html = page_text(html)
        if max_chars is not None and len(html) > max_chars:
            return [], too_long
        try:
            return extract(html, kinds), None
        except Exception as exc:  # noqa: BLE001 - one page must not end the others' run
            return [], f"{type(exc).__name__}: {exc}"

    for rb in batches:
        html_col = rb.column("html")
        left_out = rb.column("left_out").to_pylist() if "left_out" in rb.schema.names else [False] * rb.num_rows
        for row, (key, url) in enumerate(zip(rb.column("page_key").to_pylist(), rb.column("source_url").to_pylist())):
            records, error = ([], too_long) if left_out[row] else rows_of(html_col[row].as_py())
            if error is not None:
                records = [(None, None, None, None, None)]
            for seq, record in enumerate(records):
                rtype, t_idx, r_idx, keys, values = record
                for c, v in zip(cols, (key, url, rtype, t_idx, r_idx, seq if error is None else None, keys, values, error)):
                    c.append(v)
                chars += sum(map(len, keys or ())) + sum(map(len, values or ()))
                if len(cols[0]) >= _OUT_BATCH or chars >= _OUT_CHARS:
                    yield flush()
                    chars = 0
        rb = html_col = None  # not beside the next one
    if cols[0]:
        yield flush()


def _arrow_schema():
    import pyarrow as pa

    return pa.schema([
        ("page_key", pa.string()), ("source_url", pa.string()), ("record_type", pa.string()),
        ("table_index", pa.int32()), ("row_index", pa.int32()), ("extract_seq", pa.int32()),
        ("content_keys", pa.list_(pa.string())), ("content_values", pa.list_(pa.string())), ("error", pa.string()),
    ])


def extract_tagged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   kinds=RECORD_TYPES, tasks: int | None = None, max_chars: int | None = None) -> DataFrame:
    """One row per extracted element and one per page that gave none because of an error: ``TAGGED_SCHEMA``.
    The page is text, or bytes in any character set.

    Write it before splitting it (``run_medallion`` does), so that every page is parsed once.

    ``kinds``: the record types to build; the others are neither built nor sent back.
    ``tasks``: parse in that many tasks after a round-robin shuffle of the pages, for a few small files that
    arrive in fewer splits than there are cores. By default every scan split is one parse task and nothing is
    shuffled; on a large table a lower ``spark.sql.files.maxPartitionBytes`` gives more tasks.
    ``max_chars``: longer pages are errors. Where the page is text, its length is known before the parse: a longer one
    isn't sent to Python (``left_out``).
    """
    html, long = F.col(html_col), F.lit(False)
    if max_chars is not None and pages.select(html).schema[0].dataType == StringType():
        long = F.coalesce(F.length(html) > max_chars, F.lit(False))
    src = pages.select(
        F.col(id_col).cast("string").alias("page_key"),
        F.col(url_col).alias("source_url"),
        F.when(~long, html).alias("html"),
        long.alias("left_out"),
    )
    ship_package(pages.sparkSession)
    src = src.repartition(tasks) if tasks else src
    kinds = tuple(kinds)
    return src.mapInArrow(lambda batches: _extract_batches(batches, kinds, max_chars), TAGGED_SCHEMA)


def extract_raw(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", kinds=RECORD_TYPES, tasks: int | None = None) -> DataFrame:
    """One row per extracted element, schema ``EXTRACT_SCHEMA``; pages with an error give none (see ``extract_tagged``)."""
    return records_only(extract_tagged(pages, id_col, url_col, html_col, kinds, tasks))


def records_only(tagged: DataFrame) -> DataFrame:
    return tagged.where("error is null").select(*_EXTRACT_COLS)


def quarantined(tagged: DataFrame, params: RunParams) -> DataFrame:
    """The pages that gave no records, with their errors (``QUARANTINE_SCHEMA``)."""
    return tagged.where("error is not null").select(
        F.lit(params.run_id).alias("run_id"), "page_key", "source_url", "error", params.run_ts_col().alias("quarantined_at"))


def extract_records(pages: DataFrame, params: RunParams, id_col: str = "page_id",
                    url_col: str = "url", html_col: str = "html", tasks: int | None = None) -> DataFrame:
    """Pages -> records ``(record_id, record_type, table_index, row_index,
    content map, source_url, scraped_at, batch_id)``.

    Record ids hash the page id, the url and the place in the page: ids are unique if those pairs are
    (``distinct_pages`` makes them so).
    """
    raw = extract_raw(pages, id_col, url_col, html_col, tasks=tasks)
    return stamp_records(raw, params)


def repeated_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The (page id, url) pairs that occur more than once, with their counts."""
    return pages.groupBy(id_col, url_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


COPIES = 256  # copies of a page that one row stands for at most


def distinct_pages(pages: DataFrame, copies: int = COPIES) -> DataFrame:
    """``pages`` (page_id, url, html) with ids that tell repeated pages apart, so that record ids are unique.

    A page whose (page_id, url) occurs once keeps its id, as text.  Any other gets a content-addressed one:
    ``<page_id>#<start of the SHA-256 of its html>#<occurrence>``.  Occurrences are numbered in two steps without a
    window: equal pages fold on the map side into one row with their number; the row is split into runs of at most ``copies``, which are
    dealt out evenly, and each run lists its occurrences.  So a page that makes up a third of the table is one
    key of a partial count, and its copies are spread over all tasks.

    One scan of the two key columns finds the repeated pairs; without any, the pages go on unchanged.
    """
    pages = pages.select("page_id", "url", "html")
    again = repeated_pages(pages).drop("n")
    single = pages.withColumn("page_id", F.col("page_id").cast("string"))
    if again.isEmpty():
        return single
    same = F.expr("p.page_id <=> a.page_id and p.url <=> a.url")
    met = pages.alias("p").join(again.alias("a"), same, "left_semi")
    folded = met.groupBy("page_id", "url", F.sha2(F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")), 256).alias("sha"), F.isnull("html").alias("bare")).agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("n"))
    runs = folded.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(copies).cast("long"))))
    spread = runs.repartition(met.sparkSession.sparkContext.defaultParallelism, "sha", "lo")
    each = spread.withColumn("k", F.explode(F.sequence("lo", F.least(F.col("lo") + copies, F.col("n")) - 1)))
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("#"), F.when(F.col("bare"), "none").otherwise(F.substring("sha", 1, 16)), F.lit("#"), F.col("k").cast("string"))
    rest = pages.alias("p").join(again.alias("a"), same, "left_anti").withColumn("page_id", F.col("page_id").cast("string"))
    return rest.unionByName(each.select(key.alias("page_id"), "url", "html"))


def stamp_records(raw: DataFrame, params: RunParams) -> DataFrame:
    batch = F.lit(params.batch_id)
    return raw.select(
        record_id(batch, "page_key", "source_url", "record_type", "table_index", "row_index")
        .alias("record_id"),
        "record_type",
        "table_index",
        "row_index",
        F.map_from_arrays("content_keys", "content_values").alias("content"),
        "source_url",
        F.lit(params.scraped_at).alias("scraped_at"),
        batch.alias("batch_id"),
    )


def payload_records(df: DataFrame, params: RunParams, key_col: str, payload,
                    source: str, record_type: str = "row") -> DataFrame:
    """Records from any table with a payload column.

    ``payload`` is a column (or column name) holding JSON text, a map or a
    struct; maps and structs are JSON-encoded (``to_json`` of a struct
    leaves out null fields; a map keeps them as JSON nulls).  Each input
    row becomes one record whose id hashes (batch, key, source, type), so
    ``key_col`` must be unique and non-null (a null key fails the job).
    The payload stays text until silver parses it, like page content.
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    dtype = df.select(p).schema.fields[0].dataType.typeName()
    content = p if dtype == "string" else F.to_json(p)
    batch = F.lit(params.batch_id)
    src = F.lit(source)
    rtype = F.lit(record_type)
    null_int = F.lit(None).cast("int")
    key = F.col(key_col)
    key = F.when(key.isNull(), F.raise_error(F.lit(f"payload_records: null key in {key_col}"))).otherwise(key)
    return df.select(
        record_id(batch, key, src, rtype, null_int, null_int).alias("record_id"),
        rtype.alias("record_type"),
        null_int.alias("table_index"),
        null_int.alias("row_index"),
        content.alias("content"),
        src.alias("source_url"),
        F.lit(params.scraped_at).alias("scraped_at"),
        batch.alias("batch_id"),
    )


def records_from_dicts(spark: SparkSession, records: list[dict], params: RunParams) -> DataFrame:
    """Records held in driver memory (e.g. produced by other tooling) as a
    typed DataFrame: missing keys become null, ``content`` is a string map,
    batch and scrape stamps default to the run's.  Meant for small inputs;
    large inputs come from ``extract_records`` or ``payload_records``."""
    from ..schemas import RECORD_SCHEMA

    names = [f.name for f in RECORD_SCHEMA.fields]
    defaults = {"scraped_at": params.scraped_at, "batch_id": params.batch_id}
    rows = []
    for rec in records:
        row = {n: rec.get(n, defaults.get(n)) for n in names}
        if row["content"] is not None:
            row["content"] = {str(k): None if v is None else str(v) for k, v in row["content"].items()}
        rows.append(tuple(row[n] for n in names))
    nullable = RECORD_SCHEMA.__class__([f.__class__(f.name, f.dataType, True) for f in RECORD_SCHEMA.fields])
    return spark.createDataFrame(rows, nullable)


def content_json(content: Column) -> Column:
    """Map payload -> JSON text; a missing payload is the JSON ``null``."""
    return F.coalesce(F.to_json(content), F.lit("null"))


__all__ = [
    "PAYLOAD_MAP",
    "content_json",
    "distinct_pages",
    "extract_tagged",
    "quarantined",
    "records_only",
    "records_from_dicts",
    "extract_raw",
    "extract_records",
    "payload_records",
    "read_pages",
    "repeated_pages",
    "stamp_records",
]
