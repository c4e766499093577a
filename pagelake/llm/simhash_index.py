"""SimHash document fingerprints and permuted block tables. DataFrame functions only.

A fingerprint: every shingle of ``words`` words (an occurrence has weight one, so a term votes
with its frequency) is hashed to 64 bits and votes on each bit; a bit is 1 if more than half of
the votes set it.  Two counters of 32 bits travel in one long (bits i and i + 32),
so a text's votes are 32 sums, added up on the map side: one row per text is shuffled.

Block tables: 64 bits are cut into ``blocks`` blocks. Two fingerprints at most ``radius`` bits apart agree
in some ``blocks - radius`` whole blocks, so each choice of that many blocks is a table keyed by
them. The join compares what shares a key and keeps what is near; it works on distinct
fingerprints with their counts, so copies cost one row.

Defined cases: a null text is empty; a text with fewer words is one shingle; one without words has fingerprint
zero; nulls come first in id order and equal ids are ordered by their text's hash; the row after the last is
the first; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

WORDS, RADIUS, BLOCKS = 3, 3, 6
SPREAD = 8  # buckets of the id order for each shuffle partition


def shingles(text: Column, words: int = WORDS) -> Column:
    """Array of structs of up to ``words`` words."""
    w = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.greatest(F.size(w) - (words - 1), F.lit(1))
    return F.arrays_zip(*[F.slice(w, k + 1, n).alias(f"w{k}") for k in range(words)])


def fingerprints(rows: DataFrame, key: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """``key`` columns and fp (signed 64 bits) of every row; the key must tell rows apart."""
    names = [f"w{k}" for k in range(words)]
    terms = rows.select(*key, F.inline_outer(shingles(F.coalesce(F.col(text), F.lit("")), words)).alias(*names))
    terms = terms.select(*key, F.col("w0").isNotNull().cast("long").alias("one"), F.when(F.col("w0").isNotNull(), F.xxhash64(*names)).otherwise(F.lit(0)).alias("h"))
    pair = F.lit(0x100000001)
    votes = terms.groupBy(*key).agg(F.sum("one").alias("n"), *[F.sum(F.shiftrightunsigned("h", i).bitwiseAND(pair)).alias(f"v{i}") for i in range(32)])
    bits = F.lit(0).cast("long")
    for i in range(32):
        for at, count in ((i, F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"v{i}", 32))):
            bits = bits.bitwiseOR(F.when(2 * count > F.col("n"), F.lit((1 << at) - (1 << 64 if at == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")))
    return votes.select(*key, bits.alias("fp"))


def block_masks(radius: int, blocks: int) -> list[int]:
    edge = [64 * k // blocks for k in range(blocks + 1)]
    block = [sum(1 << i for i in range(a, b)) for a, b in zip(edge, edge[1:])]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def within(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, n, distance): every fingerprint of ``index`` (fp, n) within the radius of every one of ``queries`` (fp)."""
    tables = F.array(*[F.lit(m) for m in block_masks(radius, blocks)])

    def keyed(df: DataFrame, name: str, *more: str) -> DataFrame:
        return df.select(F.col("fp").alias(name), *more, F.posexplode(tables).alias("t", "mask")).select(name, *more, "t", F.col(name).bitwiseAND(F.col("mask")).alias("key"))

    found = keyed(queries, "query").join(keyed(index, "fp", "n"), ["t", "key"]).where(distance(F.col("query"), F.col("fp")) <= radius)
    return found.select("query", "fp", "n").distinct().withColumn("distance", distance(F.col("query"), F.col("fp")))


def ordered_buckets(docs: DataFrame) -> DataFrame:
    """doc_id, text, th (hash of the text) and bucket; buckets are ranges of the order by doc_id (nulls first), th.

    Cuts are quantiles of the ids. Cell j holds the ids above cut j - 1 up to cut j; an id that fills whole
    cells is a cut and the last in its cell: its rows, and the nulls, get 256 further buckets by hash.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * SPREAD
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    found = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0] or []
    cuts, heavy = sorted(set(found)), sorted({c for c, d in zip(found, found[1:]) if c == d})
    slot = F.shiftright("th", 56).cast("long") + 128  # in the order of the hash
    rows = rows.withColumn("cell", F.lit(0).cast("long"))
    edges, step = F.array(*[F.lit(c) for c in cuts]), (1 << len(cuts).bit_length()) // 2
    while step:  # the number of cuts below the id, by halving
        at = F.col("cell") + step
        rows = rows.withColumn("cell", F.when((at <= len(cuts)) & (F.element_at(edges, F.least(at, F.lit(len(cuts))).cast("int")) < F.col("doc_id")), at).otherwise(F.col("cell")))
        step //= 2
    last = F.when(F.col("doc_id").isin(heavy), slot + 1).otherwise(F.lit(0)) if heavy else F.lit(0)
    return rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), slot - 1024).otherwise(F.col("cell") * 257 + last)).drop("cell")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, th, bucket, ghost, next: the text of the next row in the order by doc_id (nulls first), th.

    The first row of each bucket also stands, as a ghost, at the end of the bucket before it, so every row
    finds its successor inside its bucket. The driver sees one id per bucket.
    """
    rows = ordered_buckets(docs)
    firsts = sorted((r.bucket, r.m) for r in rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "th")).alias("m")).collect())
    after = [(b, n.doc_id, n.th) for (b, _), (_, n) in zip(firsts, firsts[1:] + firsts[:1])]
    kind = dict(docs.dtypes)["doc_id"]
    wanted = docs.sparkSession.createDataFrame(after, f"_b long, _d {kind}, _t long")
    ghosts = (rows.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
              .select("doc_id", "text", "th", F.col("_b").alias("bucket"), F.lit(1).alias("ghost")).dropDuplicates(["bucket"]))
    both = rows.select("doc_id", "text", "th", "bucket", F.lit(0).alias("ghost")).unionByName(ghosts)
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "th")
    return both.withColumn("next", F.lead("text").over(order))


def neighbour_likeness(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp of every row.

    The edited text has its last quarter replaced by as much of the next document's beginning.
    """
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    rows = with_next(docs).withColumn("row", F.monotonically_increasing_id()).withColumn("n_chars", n.cast("long"))
    rows = rows.withColumn("edited", F.when(F.col("ghost") == 0, F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next", F.lit(1), quarter))))
    rows = rows.withColumn("edited_sha256", F.sha2(F.encode("edited", "utf-8"), 256))
    forms = F.array(F.struct(F.lit(0).alias("form"), F.col("text").alias("body")), F.struct(F.lit(1).alias("form"), F.col("edited").alias("body")))
    key = ["bucket", "ghost", "doc_id", "th", "row", "n_chars", "edited_sha256", "form"]
    rows = rows.select(*key[:-1], F.explode(forms).alias("f")).select(*key[:-1], "f.form", F.col("f.body").alias("body")).where("ghost = 0 or form = 0")
    fps = fingerprints(rows, key, "body", words)
    # in a bucket: a row's own form, its edited form, the next row's own form
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "th", "row", "form")
    fps = fps.withColumn("edited_fp", F.lead("fp").over(order)).withColumn("next_fp", F.lead("fp", 2).over(order))
    return fps.where("ghost = 0 and form = 0").select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def query(docs: DataFrame) -> DataFrame:
    """The contract's columns and, for ids divisible by 20, n_within: rows (itself included) whose fingerprint is within the radius."""
    rows = cut(neighbour_likeness(docs))
    index = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))).alias("asked"))
    near = within(index.where("asked").select("fp"), index.select("fp", "n")).groupBy("query").agg(F.sum("n").alias("n_within"))
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    like = lambda c: F.lit(1.0) - distance(F.col("fp"), F.col(c)) / F.lit(64.0)
    return rows.join(near.withColumnRenamed("query", "fp"), "fp", "left").select(
        "doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"),
        like("edited_fp").alias("near_edited"), like("next_fp").alias("near_next"), F.when(F.col("doc_id") % 20 == 0, F.col("n_within")).alias("n_within"))
