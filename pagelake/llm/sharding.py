"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 64-bit hashes; a document
belongs to the first point clockwise of its own hash.  A full shard accepts
nothing more: what overflows continues clockwise to the next point of a
shard with room.  The load bound is exact here: capacities are the floor
or the ceiling of rows/shards and add up to the rows, so the law is
``rows`` (counts differ by at most one).

The ring is cut into arcs (between points) and each arc into slices.  Only
the row count of each slice (``vnodes * shards * parts`` numbers at most)
reaches the driver, which walks the ring with counts; rows of a slice
differ only by their rank in it.  Each row then finds its shard from its
slice and rank, by a broadcast table of the same bounded size.

Defined cases: a null text has size 1 and the crc of the empty text; a null
id takes its text's crc as ring key; equal ids share a ring place and are
ranked by crc and size; rows equal in all of these are interchangeable; an
empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARDS, VNODES, PARTS = 8, 64, 16
RING = 1 << 32  # places on the ring


def points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, in ring order."""
    return sorted((xxhash.xxh64_intdigest(f"{s}:{v}", seed=42) % RING, s) for s in range(shards) for v in range(vnodes))


def walk(counts: dict[tuple[int, int], int], ring: list[tuple[int, int]], shards: int) -> list[tuple]:
    """Place counted slices under the load bound.

    counts: (arc, part) -> rows.  Returns (arc, part, lo, hi, shard, slot): the rows of ranks lo to
    hi - 1 of the slice go to the shard, from that slot on.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, placed = [0] * shards, []
    waiting = [(arc, arc, part, 0, n) for (arc, part), n in sorted(counts.items()) if n]
    while waiting:
        over = []
        for at, arc, part, lo, hi in sorted(waiting):
            s = ring[at][1]
            take = min(hi - lo, room[s] - used[s])
            if take:
                placed.append((arc, part, lo, lo + take, s, used[s]))
                used[s] += take
            if lo + take < hi:
                over.append((at, arc, part, lo + take, hi))
        waiting = []
        for at, arc, part, lo, hi in over:  # clockwise to the next point of a shard with room
            step = next(k for k in range(1, len(ring) + 1) if used[ring[(at + k) % len(ring)][1]] < room[ring[(at + k) % len(ring)][1]])
            waiting.append(((at + step) % len(ring), arc, part, lo, hi))
    return placed


def shard(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document."""
    spark = docs.sparkSession
    ring = points(shards, vnodes)
    body = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    # the arc of a place: an array gives the first point of its grid cell, a few steps pass the points before it
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("text_crc32").cast("string")))), F.lit(RING))
    grid = 4096
    first = [bisect_left(ring, (cell * (RING // grid), -1)) for cell in range(grid + 1)]
    step = max(b - a for a, b in zip(first, first[1:]))
    edges = F.array(*[F.lit(p) for p, _ in ring])
    starts = F.array(*[F.lit(a) for a in first])
    rows = rows.withColumn("place", place).withColumn("arc", F.element_at(starts, (F.floor(F.col("place") / (RING // grid)) + 1).cast("int")))
    for _ in range(step):  # move past the points of the same grid cell that lie before the place
        rows = rows.withColumn("arc", F.when((F.col("arc") < len(ring)) & (F.element_at(edges, F.least(F.col("arc") + 1, F.lit(len(ring)))) < F.col("place")), F.col("arc") + 1).otherwise(F.col("arc")))
    rows = rows.withColumn("arc", F.col("arc") % len(ring)).withColumn("part", F.pmod(F.xxhash64("place", "text_crc32"), F.lit(parts)).cast("int"))
    rows = cut(rows)
    counts = {(r.arc, r.part): r.n for r in rows.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(walk(counts, ring, shards), "arc int, part int, lo long, hi long, shard int, first long")
    order = Window.partitionBy("arc", "part").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    found = ranked.join(F.broadcast(plan), ["arc", "part"]).where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("lo")).alias("slot"))


def query(docs: DataFrame) -> DataFrame:
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
