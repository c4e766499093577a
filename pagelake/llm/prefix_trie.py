"""Prefix trie of conversations: a node for every distinct sequence of first turns, by a splitter-skeleton.

A conversation becomes a path: a 16-byte digest for each turn's role and text.  Equal paths fold into one row
first, so a conversation that very many share is counted once.  Sampled paths give splitters, each the shortest
prefix that tells a path from the one before it; they cut the sorted paths into shards of about ``PER_SHARD`` turns.
The trie of the splitters, the skeleton, is broadcast (``SKELETON`` nodes at most; fewer splitters are taken until it
fits).  Every node outside the skeleton has all its paths between two splitters: one walk over a
sorted shard finishes it.  A skeleton node may go through many shards: each hands on a partial aggregate, the
partials are reduced by node, and the totals are folded from the leaves of the skeleton to its root.

The digest of the conversations that end at a node runs over all their ids in order.  Ids are packed into
runs of ``RUN`` consecutive values by Spark, and a task streams a node's runs through the hash, holding one at a time.

Defined cases: null role and null text are empty; turns come in order of turn (null first), ties in order of their
digest; rows without conv_id belong to no conversation and are left out; a conversation
whose rebuilt form has no turn ends at the root; an empty table has no nodes.
One conversation is one row here, about 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, map_rows

PER_SHARD, MAX_SHARDS, SKELETON = 8_192, 8_192, 1 << 16
SAMPLE_BYTES, SAMPLE_TURNS = 16 << 20, 512  # expected bytes of sampled paths; turns that a sampled path keeps
RUN = 4_096
DIGEST = 16  # bytes a turn takes in a path
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key (digest of role and text), size (code points of the text) of every row."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    key = F.unhex(F.substring(F.sha2(told, 256), 1, 2 * DIGEST))
    return conversations.where("conv_id is not null").select("conv_id", "turn", key.alias("key"), F.length(text).alias("size"))


def rebuilt(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """conv_id and said (turns as key and size): the first h turns of the block's first conversation, then the conversation's own
    after its first h; h is the id's crc32 by ``most``.

    One exchange by block serves the grouping and the look at the block's first conversation.
    """
    head = F.col("conv_id") - F.col("conv_id") % block
    rows = turns(conversations).withColumn("head", head).repartition("head")
    own = rows.groupBy("head", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "size"))).alias("own"))
    own = own.withColumn("own", F.transform("own", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))))
    first = F.max(F.when(F.col("conv_id") == F.col("head"), F.slice("own", 1, most - 1))).over(Window.partitionBy("head"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % most).cast("int")
    none = F.slice("own", 1, 0)
    own = own.withColumn("first", F.coalesce(first, none)).withColumn("h", h)
    return own.select("conv_id", F.concat(F.expr("slice(first, 1, h)"), F.expr("slice(own, h + 1, size(own))")).alias("said"))


def paths(said: DataFrame) -> DataFrame:
    """conv_id, path (digests in a row), sizes, kept in the shared folder: a few bytes a turn."""
    digests = F.unhex(F.array_join(F.transform("said", lambda t: F.hex(t["key"])), ""))
    return cut(said.select("conv_id", digests.alias("path"), F.transform("said", lambda t: t["size"]).alias("sizes")).withColumn("pkey", F.sha2("path", 256)))


def ends(found: DataFrame) -> DataFrame:
    """pkey, sha: the SHA-256 of the ids of the conversations with that path, in order, joined by commas."""
    at = F.floor(F.col("conv_id") / RUN)
    runs = found.groupBy("pkey", at.alias("at")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        give = lambda out: pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()), pa.array([s for _, s in out], pa.string())], ["pkey", "sha"])
        for b in batches:
            out = []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            yield give(out)
        if key is not None:
            yield give([(key, sha.hexdigest())])

    return map_rows(runs.repartition("pkey").sortWithinPartitions("pkey", "at"), run, "pkey string, sha string")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b)) // DIGEST
    for k in range(n):
        if a[k * DIGEST : (k + 1) * DIGEST] != b[k * DIGEST : (k + 1) * DIGEST]:
            return k
    return n


def splitters(sample: list[bytes], shards: int) -> list[bytes]:
    """At most ``shards`` - 1 prefixes that cut the sampled paths into parts of about equal turns."""
    sample = sorted(set(sample))
    total = sum(map(len, sample)) + len(sample)
    out, seen, part, before = [], 0, 0, b""
    for path in sample:
        now = seen * shards // max(total, 1)
        if path and now > part:
            out.append(path[: (common_turns(before, path) + 1) * DIGEST])
            part = now
        seen += len(path) + 1
        before = path
    return out


def trie_of(cuts: list[bytes]) -> dict[tuple[int, bytes], int]:
    """(node, turn) -> node of the splitters' trie; the root is node 0, a node's number is above its parent's."""
    trie: dict[tuple[int, bytes], int] = {}
    for path in cuts:
        node = 0
        for k in range(0, len(path), DIGEST):
            node = trie.setdefault((node, path[k : k + DIGEST]), len(trie) + 1)
    return trie


def skeleton(sample: list[bytes], shards: int, limit: int = SKELETON) -> tuple[list[bytes], dict[tuple[int, bytes], int]]:
    """Splitters and their trie, of at most ``limit`` nodes: half the shards until it fits."""
    while True:
        cuts = splitters(sample, shards) if shards > 1 else []
        trie = trie_of(cuts)
        if len(trie) <= limit:
            return cuts, trie
        shards //= 2


class Open:
    """A node on the path that the walk is at."""

    __slots__ = ("turn", "size", "node", "n", "conv", "children", "leaves", "saved", "sha", "waiting")

    def __init__(self, turn: bytes, size: int, node: int | None):
        self.turn, self.size, self.node = turn, size, node  # node: its number in the skeleton, None outside
        self.n = self.children = self.leaves = self.saved = 0
        self.conv: int | None = None
        self.sha: str | None = None
        self.waiting: list[tuple] = []  # children that need this node's conversation as their parent's

    def member(self, conv: int, n: int) -> None:
        self.n += n
        if self.conv is None or conv < self.conv:
            self.conv = conv


#: what the walk gives: node is the node's own number (partial of a skeleton node) or its parent's (a finished node below the skeleton)
PART = [("partial", pa.bool_(), "boolean"), ("node", pa.int64(), "long"), ("conv_id", pa.int64(), "long"), ("depth", pa.int64(), "long"), ("parent_conv_id", pa.int64(), "long"), ("n_convs", pa.int64(), "long"),
        ("n_children", pa.int64(), "long"), ("n_leaves", pa.int64(), "long"), ("saved_tokens", pa.int64(), "long"), ("size", pa.int64(), "long"), ("sha", pa.string(), "string")]


def walk(rows: Iterator[tuple[bytes, list[int], int, int, str]], trie: dict[tuple[int, bytes], int]) -> Iterator[tuple]:
    """Rows of PART of sorted distinct paths (path, sizes, n, smallest conv_id, sha)."""
    stack = [Open(b"", 0, 0)]

    def close() -> Iterator[tuple]:
        o, depth = stack.pop(), len(stack)
        if o.node is not None:
            yield True, o.node, o.conv, depth, None, o.n, o.children, o.leaves, o.saved, o.size, o.sha
            return
        o.leaves += not o.children
        o.saved += (o.n - 1) * o.size
        for child in o.waiting:
            yield False, None, *child[:2], o.conv, *child[2:]
        done = (o.conv, depth, o.n, o.children, o.leaves, o.saved, o.size, o.sha)
        up = stack[-1]
        up.member(o.conv, o.n)
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + o.leaves, up.saved + o.saved
        if up.node is None:
            up.waiting.append(done)
        else:
            yield False, up.node, *done[:2], None, *done[2:]

    before = b""
    for path, sizes, n, conv, sha in rows:
        same = common_turns(before, path)
        while len(stack) > same + 1:
            yield from close()
        for k in range(same, len(path) // DIGEST):
            turn, up = path[k * DIGEST : (k + 1) * DIGEST], stack[-1].node
            stack.append(Open(turn, sizes[k], None if up is None else trie.get((up, turn))))
        stack[-1].member(conv, n)
        stack[-1].sha = sha
        before = path
    while stack:
        yield from close()


def fold(partials: list, trie: dict[tuple[int, bytes], int]) -> list[tuple]:
    """The skeleton nodes (node, conv_id, depth, parent_conv_id, ...): partials summed up from the children to the root."""
    parent = {node: up for (up, _), node in trie.items()}
    got = {p.node: p.asDict() for p in partials}
    for node in sorted(got, reverse=True):
        p = got[node]
        p["n_leaves"] += not p["n_children"]
        p["saved_tokens"] += (p["n_convs"] - 1) * p["size"] if node else 0
        if node:
            up = got[parent[node]]
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                up[c] += p[c]
            up["n_children"] += 1
            up["conv_id"] = p["conv_id"] if up["conv_id"] is None else min(up["conv_id"], p["conv_id"])
    return [(node, p["conv_id"], p["depth"], got[parent[node]]["conv_id"] if node else None, p["n_convs"], p["n_children"], p["n_leaves"], p["saved_tokens"], p["sha"]) for node, p in got.items()]


def nodes(found: DataFrame, per_shard: int = PER_SHARD, limit: int = SKELETON) -> DataFrame:
    """The trie's nodes over ``found`` (conv_id, path, sizes, pkey; see ``paths``)."""
    spark: SparkSession = found.sparkSession
    same = found.groupBy("pkey").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    distinct = cut(same.join(ends(found), "pkey"))
    kept = F.substring("path", 1, SAMPLE_TURNS * DIGEST)
    total, rows, wide = distinct.agg(F.sum(F.size("sizes") + 1), F.count(F.lit(1)), F.sum(F.octet_length(kept) + 64)).first()
    if not rows:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    shards = max(1, min(MAX_SHARDS, -(-total // per_shard)))
    share = min(1.0, 32 * shards / rows, SAMPLE_BYTES / wide)
    sample = [bytes(r[0]) for r in distinct.where(_below(F.col("pkey"), share)).select(kept).collect()] if shards > 1 else []  # SAMPLE_BYTES are expected at most
    cuts, trie = skeleton(sample, shards, limit)
    shared = spark.sparkContext.broadcast((cuts, trie))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        cuts = shared.value[0]
        for b in batches:
            shard = pa.array([bisect_right(cuts, p) for p in b.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *b.columns], ["shard", *b.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie = [], shared.value[1]
        give = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(zip(*out), PART)], [n for n, _, _ in PART])
        rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(1, b.num_columns))))
        first = next(rows, None)
        if first is None:
            return
        for row in walk((r for it in ((first,), rows) for r in it), trie):
            out.append(row)
            if len(out) >= 20_000:
                yield give()
                out = []
        yield give()

    dealt = map_rows(distinct.select("path", "sizes", "n", "conv", "sha"), deal, "shard int, path binary, sizes array<int>, n long, conv long, sha string")
    parts = cut(map_rows(dealt.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path"), run, ", ".join(f"{n} {t}" for n, _, t in PART)))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partials = parts.where("partial").groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums, F.max("size").alias("size"), F.max("sha").alias("sha")).collect()  # at most ``limit`` + 1 rows
    top = spark.createDataFrame(fold(partials, trie), "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sha string")
    up = F.broadcast(top.select("node", F.col("conv_id").alias("up_conv")))  # at most ``limit`` + 1 rows
    below = parts.where("not partial").join(up, "node", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "sha"]
    return below.select(names).unionByName(top.select(names)).withColumnRenamed("sha", "ends_sha256").fillna({"ends_sha256": NOBODY})


def _below(key: Column, share: float) -> Column:
    """A share of the keys, fixed by the key."""
    return F.shiftrightunsigned(F.xxhash64(key), 11) * F.lit(2.0**-53) < F.lit(share)


def trie(conversations: DataFrame, per_shard: int = PER_SHARD, limit: int = SKELETON) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    said = turns(conversations).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "key", "size"))), lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("said"))
    return nodes(paths(said), per_shard, limit)


def query(conversations: DataFrame) -> DataFrame:
    return nodes(paths(rebuilt(conversations.select("conv_id", "turn", "role", "text"))))


# a node is the list of its turns; each node adds to all its ancestors
SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(said ORDER BY i) AS own FROM t GROUP BY conv_id),
h AS (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda p, q: CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384::BIGINT) ELSE p >> 1 END)) AS c FROM o),
p AS (SELECT h.conv_id, list_concat(list_slice(coalesce(g.own, []), 1, xor(h.c, 4294967295::BIGINT) % 6), list_slice(h.own, xor(h.c, 4294967295::BIGINT) % 6 + 1, len(h.own))) AS path
  FROM h LEFT JOIN o g ON g.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, list_slice(path, 1, d) AS node, d AS depth, len(path) = d AS ends FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM p)),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY node, depth),
k AS (SELECT n.node, n.depth, count(b.node) AS n_children FROM n LEFT JOIN n b ON b.depth = n.depth + 1 AND list_slice(b.node, 1, n.depth) = n.node GROUP BY n.node, n.depth),
f AS (SELECT n.*, n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[n.depth].x) END AS own_saved, n_children = 0 AS leaf FROM n JOIN k ON k.node = n.node AND k.depth = n.depth),
s AS (SELECT list_slice(node, 1, d) AS node, d AS depth, sum(own_saved) AS saved_tokens, sum(leaf::INT) AS n_leaves FROM (SELECT node, own_saved, leaf, unnest(range(depth + 1)) AS d FROM f) GROUP BY ALL)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.node = f.node AND s.depth = f.depth LEFT JOIN n u ON u.depth = f.depth - 1 AND u.node = list_slice(f.node, 1, f.depth - 1)
"""
