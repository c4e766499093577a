"""SimHash near-duplicates by covering locality-sensitive hashing.

Masks: every bit position gets a random non-zero vector of radius + 1 bits;
table v (every non-zero vector, 2^(radius+1) - 1 tables) keeps the bit
positions whose vector has odd inner product with v.  The vectors of at most
``radius`` differing positions never span the whole space, so some v is
orthogonal to all of them: that table masks every differing bit away and
the pair collides there. No pair within the radius is missed.

Work is on distinct fingerprints, so copies cost nothing.  In a bucket of at
most ``BUCKET`` fingerprints all pairs are checked.  Fingerprints of a larger
bucket are linked exactly without pairs, through the points of the cube
within radius / 2 of each: two fingerprints at distance d share a point
that halves their way, and all that share a point are within the radius
of each other, so a link to the smallest is enough.  For an odd radius one
side takes the points one bit further out.

Classes come from alternating large-star / small-star rounds; each round is
cut in the shared folder.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a null id counts after all ids as a representative; rows equal in id
and text are one document; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, cut, fresh, map_rows, slices

WORDS, RADIUS, BUCKET = 3, 2, 32


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the shingles' XXH64 values (seed 42), unsigned."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else iter([b" ".join(w)])
    votes, n, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    while True:
        h = np.fromiter((digest(g, 42) for g in islice(grams, 1 << 16)), dtype="<u8")
        if not h.size:
            break
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += h.size
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, th (hash of the text), fp (signed 64 bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            fp = np.array([fingerprint(t, words) for t in b.column(2).to_pylist()], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "th", "fp"])

    src = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return map_rows(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, th long, fp long")


def covering_masks(radius: int, bits: int = 64, seed: int = 7) -> list[int]:
    """One mask (as a signed long) per table."""
    rng = random.Random(seed)
    vec = [rng.randrange(1, 1 << (radius + 1)) for _ in range(bits)]
    masks = [sum(1 << i for i in range(bits) if bin(vec[i] & v).count("1") % 2) for v in range(1, 1 << (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _ball(fp: Column, radius: int) -> Column:
    """All points within ``radius`` of fp."""
    flips = [0] + [sum(1 << i for i in c) for k in range(1, radius + 1) for c in combinations(range(64), k)]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in flips])
    return F.transform(masks, lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b), a < b, that connect all of the distinct ``fps`` (column fp) within ``radius`` of each other."""
    masks = covering_masks(radius)
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]
    tables = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.t", "k.key", "fp")
    sizes = tables.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cut(tables.join(sizes, ["t", "key"]))
    some = held.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: (b > a) & (_distance(a, b) <= radius)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    edges = some.select(F.explode(pairs).alias("e")).select("e.a", "e.b")
    large = held.where(F.col("n") > bucket).select("fp").distinct()
    half = large.select("fp", F.explode(_ball(F.col("fp"), radius // 2)).alias("p"))
    heads = half.groupBy("p").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = half.join(heads, "p").where("fp > a").select("a", F.col("fp").alias("b"))
    if radius % 2:  # the odd step: a point of the larger ball on one side
        wide = large.select(F.col("fp").alias("b"), F.explode(_ball(F.col("fp"), radius // 2 + 1)).alias("p"))
        odd = wide.join(half.groupBy("p").agg(F.min("fp").alias("a")), "p").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
        stars = stars.unionByName(odd)
    return edges.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a < b) reaches."""
    edges = cut(edges.select("a", "b"))
    while True:
        # large star: every larger neighbour of a node goes to the smallest node around it
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct())
        # small star: a node's smaller neighbours and itself go to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = cut(large.join(low, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), "b"))).alias("e"))
                    .select("e.*").where("a < b").distinct())
        changed = small.join(edges, ["a", "b"], "left_anti").limit(1).count() + edges.join(small, ["a", "b"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def classes(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, th, fp and the class's representative (rep_id, rep_th) of every row.

    The representative has the smallest id, nulls last, then the smallest text hash.
    """
    rows = cut(fingerprints(docs, words))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    nodes = cut(rows.groupBy("fp").agg(rep.alias("first")))
    roots = cut(components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp"))
    grouped = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = grouped.groupBy("root").agg(F.min("first").alias("best"))
    label = grouped.join(best, "root").select("fp", F.col("best.doc_id").alias("rep_id"), F.col("best.th").alias("rep_th"))
    return rows.join(label, "fp")


def near_dedup(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that represent their class, one row each; columns as in ``docs``."""
    th, = fresh(docs.columns, "th")
    reps = classes(docs, words, radius).select(F.col("rep_id").alias("_d"), F.col("rep_th").alias(th)).distinct()
    keyed = docs.withColumn(th, F.xxhash64("text"))
    kept = keyed.join(reps.withColumnRenamed(th, "_t"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col(th) == F.col("_t")), "left_semi")
    return kept.dropDuplicates(["doc_id", th]).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("rep_id").alias("component_id"))
