"""Quality rules: base rules of a text, and lines that too many documents of a host share.

A line is known by a hash of host and normalised text: A-Z in lower case, white space at the
ends dropped, runs of it one space.  Per host the documents
(distinct texts: copies count once) that hold a line are counted; a line in more than
``MIN_DOCS`` documents and more than ``SHARE`` of the host's is removed, wherever a text
repeats it. A document that keeps less than ``REST`` of the words in its distinct lines is
depleted and rejected; the others go on without their removed lines (``clean``).

All counts fold before the shuffle or shuffle 24 bytes a line; texts stay
where they are.  A line that very many documents share is one hot key: its
counts fold on the map side, and the join that marks it can be split by the
engine since nothing is grouped above it without another exchange.

Defined cases: a null text has no words and fails the base rules; a null host
is a host; a document without any line stays undepleted; blank lines are never removed; rows equal in host
and text get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, WORD, broadcast_if_small, cut, fresh, map_rows, slices

MIN_DOCS, SHARE, REST = 20, 0.02, 0.3
MIN_WORDS, REPEATS = 50, 0.5
SYMBOLS = "#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


def normal(line: bytes) -> bytes:
    """The form of a line that is counted."""
    return b" ".join(line.split()).translate(LOWER)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    n = len(known)
    if n < 1 << 20:
        key = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:  # the product could overflow: number the pairs first
        key = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1] * n + ids[2:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, words in distinct normalised lines."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    lines = [x for x in raw.split(b"\n") if x.strip(BLANKS)]
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or repeats > REPEATS * len(words)
    line_words = len(words) if len(lines) < 2 else sum(len(x.split(b" ")) for x in set(map(normal, lines)))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats, failed, line_words


COUNTS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("line_words", pa.int64()))


def _key(host: Column, text: Column) -> Column:
    return F.xxhash64(host, F.coalesce(text, F.lit("")))


def base_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, key (host and text) and the base counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            found = list(zip(*map(base_counts, b.column(2).to_pylist())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, (_, t) in zip(found, COUNTS))], ["doc_id", "key", *(n for n, _ in COUNTS)])

    src = docs.select("doc_id", _key(F.col(host), F.col("text")).alias("key"), "text")
    return map_rows(src, run, f"doc_id {dict(docs.dtypes)['doc_id']}, key long, " + ", ".join(f"{n} {'boolean' if n == 'base_failed' else 'long'}" for n, _ in COUNTS))


def lost_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """key, n_removed_lines, n_removed_words, lines (hashes) of the documents that lose lines; each distinct line once."""
    rows = docs.where(F.col("text").isNotNull()).select(_key(F.col(host), F.col("text")).alias("key"), F.xxhash64(host).alias("host"), F.col(host).alias("h"), F.explode(F.split("text", "\n", -1)).alias("l"))
    upper = "".join(map(chr, range(65, 91)))
    rows = rows.withColumn("l", F.translate(F.regexp_replace(F.btrim("l", F.lit(BLANKS.decode())), r"[\x20\x09-\x0D]+", " "), upper, upper.lower())).where("l <> ''")
    lines = rows.select("key", "host", F.xxhash64("h", "l").alias("line"), F.regexp_count("l", F.lit(WORD)).alias("words"))
    once = cut(lines.groupBy("key", "line").agg(F.max("host").alias("host"), F.max("words").alias("words")))
    hosts = once.select("host", "key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    seen = once.groupBy("line").agg(F.max("host").alias("host"), F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    often = cut(seen.join(hosts, "host").where(F.col("n") > F.col("docs") * share).select("line"))
    return once.join(broadcast_if_small(often), "line").groupBy("key").agg(F.count(F.lit(1)).alias("n_removed_lines"), F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("lines"))


def line_hash(host: str | None, line: bytes) -> int:
    """The hash of host and normalised line that ``lost_lines`` counts, for Python."""
    import xxhash

    seed = 42 if host is None else xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"), 42)
    h = xxhash.xxh64_intdigest(line, seed)
    return h - (1 << 64) if h >> 63 else h


def without_lines(text: str, host: str | None, lines: set[int]) -> str:
    """The text without the lines whose hash is among ``lines``."""
    kept = [x for x in text.split("\n") if not x.strip(BLANKS.decode()) or line_hash(host, normal(x.encode("utf-8", "surrogatepass"))) not in lines]
    return "\n".join(kept)


def verdicts(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, rest: float = REST) -> DataFrame:
    """doc_id, key, base counts, removed lines (number, words, hashes), kept, of every row."""
    none = F.lit(0).cast("long")
    joined = base_rules(docs, host).join(lost_lines(docs, host, min_docs, share), "key", "left")
    return (joined.withColumn("n_removed_lines", F.coalesce("n_removed_lines", none))
            .withColumn("n_removed_words", F.coalesce("n_removed_words", none))
            .withColumn("kept", ~F.col("base_failed") & (F.col("line_words") - F.col("n_removed_words") >= F.lit(rest) * F.col("line_words"))))


def clean(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, rest: float = REST) -> DataFrame:
    """The rows of ``docs`` that pass (see ``verdicts``), without their removed lines; n_chars, where there is such a column, follows.

    One join brings the removed lines to the texts that have any; verdict and removal are one pass over the rows.
    """
    key, words, lines = fresh(docs.columns, "key", "words", "lines")
    lost = cut(lost_lines(docs, host, min_docs, share).select(F.col("key").alias(key), F.col("n_removed_words").alias(words), F.col("lines").alias(lines)))
    joined = docs.withColumn(key, _key(F.col(host), F.col("text"))).join(broadcast_if_small(lost), key, "left").select(*docs.columns, words, lines)
    text_at, host_at = docs.columns.index("text"), docs.columns.index(host)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            texts, gone, passed, kept = b.column(text_at), b.column(b.num_columns - 1), [], []
            hosts = b.column(host_at).to_pylist() if gone.null_count < b.num_rows else [None] * b.num_rows
            for t, h, n, x in zip(texts.to_pylist(), hosts, b.column(b.num_columns - 2).to_pylist(), gone.to_pylist()):
                *_, failed, total = base_counts(t)
                passed.append(not failed and total - (n or 0) >= rest * total)
                kept.append(without_lines(t, h, set(x)) if x and passed[-1] else t)
            if gone.null_count < b.num_rows:
                texts = pa.array(kept, texts.type)
            cols = [texts if k == text_at else b.column(k) for k in range(b.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-2]).filter(pa.array(passed, pa.bool_()))

    out = map_rows(joined, run, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return verdicts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


# a line's documents are its distinct texts; equal names and limits as above
SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
u AS (SELECT DISTINCT source, text FROM d),
w AS (SELECT source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM u),
p AS (SELECT source, text, len(ws) AS n, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT *, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY source, text ORDER BY i)),
c AS (SELECT *, count(*) OVER (PARTITION BY source, text, x, y, z) AS k FROM g WHERE z IS NOT NULL),
r AS (SELECT source, text, count(DISTINCT i + j) AS rep FROM c, (SELECT unnest(range(3)) AS j) WHERE k > 1 GROUP BY ALL),
raw AS (SELECT source, text, unnest(string_split(text, chr(10))) AS l FROM u),
lines AS (SELECT source, text, l, translate(trim(regexp_replace(l, '[\\x20\\x09-\\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM raw),
dup AS (SELECT source, text, count(*) - count(DISTINCT l) AS dups FROM lines WHERE t <> '' GROUP BY ALL),
once AS (SELECT DISTINCT source, text, t, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n FROM lines WHERE t <> ''),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM once GROUP BY ALL),
often AS (SELECT source, t FROM once JOIN hosts USING (source) GROUP BY source, t, docs HAVING count(*) > {MIN_DOCS} AND count(*) > docs * {SHARE}),
lost AS (SELECT o.source, o.text, sum(o.n) AS gone FROM once o JOIN often f ON o.source = f.source AND o.t = f.t GROUP BY ALL),
tot AS (SELECT source, text, sum(n) AS total FROM once GROUP BY ALL),
v AS (SELECT w.source, w.text, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines, coalesce(rep, 0) AS n_repeat_words,
  (len(ws) < {MIN_WORDS} OR 100 * coalesce(rep, 0) > {int(100 * REPEATS)} * len(ws)) AS base_failed, coalesce(gone, 0) AS n_removed_words, coalesce(total, 0) AS total
  FROM w LEFT JOIN r ON r.source = w.source AND r.text = w.text LEFT JOIN dup ON dup.source = w.source AND dup.text = w.text
  LEFT JOIN lost ON lost.source = w.source AND lost.text = w.text LEFT JOIN tot ON tot.source = w.source AND tot.text = w.text)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND total - n_removed_words >= {REST} * total AS kept, CAST(n_removed_words AS BIGINT) AS n_removed_words
FROM d JOIN v ON d.source = v.source AND d.text = v.text
"""
