"""Content-addressed WARC archive: payload bytes once by digest, record headers apart, records put together by joins.

An archive is a folder with two tables.  ``headers``: for every record its exact header bytes (the WARC header and, as
the block's first part, the HTTP header), the digest of its payload and the digest of the header itself.
``payloads``: every distinct payload once, under its SHA-256.  Writing verifies the digests: payloads that meet under one digest must agree in a second
digest and in length, else the write fails.  Reading back takes what a record says of itself from its header bytes
alone, recomputes the SHA-256 of every stored payload and header, and fails on any that differ; ``records``
gives the original bytes of every record.

Of records with equal payloads of at least ``LEAST`` bytes the first (smallest page_id, then url, then row) is the
response, the others are revisits that refer to it.  Groups fold before the shuffle to one row per digest, and only digests that occur
more than once are joined to the records, which are rows of ids and digests there; payloads move once, when equal ones meet.

Defined cases: null html is the empty payload; a record without url has no target; control characters and spaces
in a url are percent-encoded; a null page_id is a record without a number and comes last in its group; rows equal in everything are records
of their own, numbered; an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import broadcast_if_small, cut

LEAST = 100
DATE = "2024-01-01T00:00:00Z"
#: fixed value: the profile that WARC 1.1 names for revisits of an equal payload
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
HEADERS = "page_id long, header binary, header_digest string, payload_digest string"
PAYLOADS = "payload_digest string, payload binary"


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _url() -> Column:
    """The url with white space and control characters percent-encoded, so that it stays on its header line."""
    odd = [*range(33), 127]
    c = F.col("url")
    for code in odd:
        c = F.replace(c, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.col("url").rlike(r"[\x00-\x20\x7F]"), c).otherwise(F.col("url"))


def _urn(page: Column, copy: Column) -> Column:
    """A record's id: the page's, and a number that tells the records of one archive apart."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def described(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """row (a number of its own), page_id, url, payload_digest, payload_bytes, and first (row, page_id, url of the response) where the record is a revisit."""
    bare = cut(pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), _url().alias("url"),
                            F.sha2(_payload(), 256).alias("payload_digest"), F.octet_length(_payload()).cast("long").alias("payload_bytes")))
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url", "row")
    groups = bare.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    groups = cut(groups.where("n > 1").select("payload_digest", "first.row", "first.page_id", "first.url").toDF("payload_digest", "first_row", "first_page", "first_url"))
    met = bare.join(broadcast_if_small(groups), "payload_digest", "left")
    return met.withColumn("revisit", F.coalesce(F.col("first_row") != F.col("row"), F.lit(False)))


def headers(pages: DataFrame, date: str = DATE, least: int = LEAST) -> DataFrame:
    """page_id, header, header_digest, payload_digest of every record."""
    d = described(pages, least)
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("payload_bytes"))
    again = lambda c: F.when(F.col("revisit"), c)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _line("WARC-Profile", again(F.lit(PROFILE))),
        _line("WARC-Refers-To", again(_urn(F.col("first_page"), F.col("first_row")))),
        _line("WARC-Refers-To-Target-URI", again(F.col("first_url"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"), http).cast("binary")
    return d.select("page_id", head.alias("header"), F.sha2(head, 256).alias("header_digest"), "payload_digest")


def payloads(pages: DataFrame) -> DataFrame:
    """payload_digest and payload of every distinct payload; fails where two payloads share a digest."""
    p = _payload()
    rows = pages.select(F.sha2(p, 256).alias("payload_digest"), p.alias("payload"), F.struct(F.octet_length(p).alias("n"), F.xxhash64(p).alias("x"), F.crc32(p).alias("c")).alias("proof"))
    met = rows.groupBy("payload_digest").agg(F.first("payload").alias("payload"), F.min("proof").alias("least"), F.max("proof").alias("most"))
    checked = F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("two payloads under digest "), "payload_digest")).cast("binary"))
    return met.select("payload_digest", checked.alias("payload"))


def write(pages: DataFrame, root: str, date: str = DATE, least: int = LEAST) -> str:
    """Write the archive of ``pages`` (page_id, url, html) to the folder ``root``, which all executors share."""
    pages = pages.select("page_id", "url", "html")
    headers(pages, date, least).write.mode("overwrite").parquet(f"{root}/headers")
    payloads(pages).write.mode("overwrite").parquet(f"{root}/payloads")
    return root


def _verified(content: str, digest: str) -> Column:
    """The column, failing where its bytes don't have their digest."""
    return F.when(F.sha2(content, 256) == F.col(digest), F.col(content)).otherwise(F.raise_error(F.concat(F.lit(f"{content} differs from its digest "), digest)).cast("binary"))


def _field(name: str) -> Column:
    """A field of the WARC header, null where it has none."""
    found = F.regexp_extract(F.element_at(F.split("head", "\r\n\r\n", 2), 1), rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(found != "", found)


def read_headers(spark: SparkSession, root: str) -> DataFrame:
    """What the stored headers say: record_id, page_id, record_type, refers_to, target, payload_digest, block_bytes, and the header's bytes."""
    rows = spark.read.schema(HEADERS).parquet(f"{root}/headers").withColumn("header", _verified("header", "header_digest")).withColumn("head", F.decode("header", "utf-8"))
    page = lambda urn: F.regexp_extract(urn, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")
    said = rows.select("header", _field("WARC-Record-ID").alias("record_id"), _field("WARC-Type").alias("record_type"), _field("WARC-Refers-To").alias("refers"), _field("WARC-Target-URI").alias("target"),
                       F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"), _field("Content-Length").cast("long").alias("block_bytes"))
    return said.withColumn("page_id", page(F.col("record_id"))).withColumn("refers_to", page(F.col("refers"))).drop("refers")


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    """payload_digest and payload, every payload checked against its digest."""
    return spark.read.schema(PAYLOADS).parquet(f"{root}/payloads").withColumn("payload", _verified("payload", "payload_digest"))


def records(spark: SparkSession, root: str) -> DataFrame:
    """Every record with its payload and its original bytes: header, payload (of a response), two line ends.

    A digest that very many records share is one large partition of the join's header side, which the engine may split.
    """
    met = read_headers(spark, root).join(read_payloads(spark, root), "payload_digest")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return met.withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n")))


def query(pages: DataFrame) -> DataFrame:
    """Write the archive, read it back; a payload's size and digest are those of the stored bytes, checked once per payload."""
    spark = pages.sparkSession
    root = write(pages, scratch_dir(spark, "warc"))
    stored = read_payloads(spark, root).select("payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    return read_headers(spark, root).join(stored, "payload_digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST} AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id <> head THEN head END AS refers_to
FROM g
"""
