"""Phrase collocations by SETM: relational mining of frequent adjacent words.

A text is cut into pieces and these into words.  The sorted occurrence relation (piece, position, word) is written
to the shared folder once, in blocks: the words of some texts of one language in order, as codes into the block's own
list of distinct words, zero between pieces.  Then, for each length k:

* semi-join: occurrences whose (k-1)-word group is not frequent are dropped (words at k = 2; the frequent ones go by small numbers from here on);
* merge-join: an occurrence of a (k-1)-word group at a position meets the word k - 1 positions on, in the same piece;
* group-count: Spark adds up the groups that the blocks count, and keeps those with at least ``MIN`` occurrences.

What the semi-join leaves is written as the next sorted relation (the blocks without the words that no frequent group
reaches), so each length reads less than the one before; the relation before it is removed.  A block asks for its distinct groups: if the frequent groups are few
(``KEYS`` at most, counted) their 64-bit keys are broadcast, else the blocks' distinct groups are joined to them by key and come back
to their block.  A key that two groups share only lets an infrequent group pass, which its exact count drops later.
Words are counted by themselves, not by their hashes; the occurrences that the words' semi-join keeps must add up to
the frequent words' counts, else two words share a hash and the job fails.

Frequent phrases are then scored at all their cuts, against the counts of their parts, in decimals of 38 digits.

Defined cases: a null text is empty, a null language is ``und``; equal scores go by count, then by the phrase's UTF-8 bytes; a language
without a frequent phrase has no rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import BROADCAST_BYTES, broadcast_if_small, map_rows

MIN, LONGEST, COVER, TOP = 30, 4, 80, 2000
SMALL = 24 << 20  # bytes, measured, up to which the table of frequent words is broadcast to look up words
PARTS = 64  # parts of a language's phrases, each ranked on its own first
KEYS = 4 << 20  # frequent groups whose keys are broadcast at most, 8 bytes each
BLOCK = 1 << 20  # bytes of text in a block, about
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A-Z in lower case; a piece's end becomes a byte that UTF-8 never has
FOLD = bytes(0xFF if chr(b) in ".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b"\xff"
NAMES = [f"w{k}" for k in range(1, LONGEST + 1)]


class Codes(dict):
    """Codes of a block's words from 1 on; the end of a piece is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def words_of(text: str | None) -> list[bytes]:
    """The words in order, with ``END`` after each piece."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).replace(END, b" \xff ").split() + [END]


def packed(x: np.ndarray) -> bytes:
    """An array's bytes, compressed: blocks cross between Spark and Python several times."""
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True), kind)


def _key(words: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of word hashes."""
    h = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[:, k]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def occurrences(docs: DataFrame) -> DataFrame:
    """The sorted occurrence relation in blocks: block, lang, words (UTF-8, joined by spaces), hashes, codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 40, {}

        def give(langs):
            nonlocal number
            rows = []
            for lang in langs:
                codes, parts, _ = held.pop(lang)
                seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)  # a word's hash is Spark's xxhash64(lang, word)
                known = [w for w in codes if w != END]
                hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in known), np.uint64, len(known))
                rows.append((number, lang, b" ".join(known), packed(hashes), packed(np.concatenate(parts))))
                number += 1
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "lang", "words", "hashes", "codes"])

        total = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                codes, parts, _ = at = held.setdefault(lang, [Codes(), [], 0])
                found = words_of(text)
                parts.append(np.fromiter(map(codes.__getitem__, found), np.int32, len(found)))
                at[2] += len(text)
                total += len(text)
                if at[2] > BLOCK:
                    total -= at[2]
                    yield give([lang])
                elif total > 4 * BLOCK:  # many languages: none may be kept back for long
                    total = 0
                    yield give(list(held))
        if held:
            yield give(list(held))

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return map_rows(docs.select(lang.alias("lang"), "text"), run, "block long, lang string, words binary, hashes binary, codes binary")


def _written(df: DataFrame, root: str, name: str) -> DataFrame:
    """Persist a relation in the shared folder.

    Spark drops the write's shuffle files when it ends: what reads on, reads the relation, so the disk holds one step's shuffle at a time.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(f"{root}/{name}")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")


def _drop(spark: SparkSession, root: str, name: str) -> None:
    """Remove a relation of ``root`` that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows one at a time: a block is large, so no more than one is unpacked."""
    for b in batches:
        for k in range(b.num_rows):
            yield tuple(c[k].as_py() for c in b.columns)


def word_counts(blocks: DataFrame) -> DataFrame:
    """lk (the language's key), lang, w1 (hash), word, a of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _rows(batches):
            words = words.split()
            n = np.bincount(unpacked(codes, np.int32), minlength=len(words) + 1)[1:].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(n)], ["lang", "word", "n"])

    counted = map_rows(blocks.select("lang", "words", "codes"), run, "lang string, word string, n long")
    met = counted.groupBy("lang", "word").agg(F.sum("n").alias("a"))
    return met.select(F.xxhash64("lang").alias("lk"), "lang", F.xxhash64("lang", "word").alias("w1"), "word", "a")


def language_counts(words: DataFrame) -> DataFrame:
    """lk, lang and n, all word occurrences, of every language; fails where two languages share a key."""
    per = words.groupBy("lk", "lang").agg(F.sum("a").alias("n"))
    met = per.groupBy("lk").agg(F.min("lang").alias("least"), F.max("lang").alias("most"), F.sum("n").alias("n"))
    lang = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.raise_error(F.concat(F.lit("two languages share a key: "), "least", F.lit(" "), "most")).cast("string"))
    return met.select("lk", lang.alias("lang"), "n")


def numbered(words: DataFrame, least: int, root: str) -> DataFrame:
    """lk, w1, word, a and id (from 1, without gaps) of the frequent words; an id belongs to one language's word."""
    rows = _written(words.where(F.col("a") >= least).select("lk", "w1", "word", "a", F.monotonically_increasing_id().alias("at")), root, "frequent-words")
    part = F.shiftright("at", 33)
    per = sorted(tuple(r) for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each written partition
    if sum(n for _, n in per) >= 1 << 31:
        raise ValueError("more frequent words than 31 bits can number")
    before = rows.sparkSession.createDataFrame([(p, sum(n for _, n in per[:k])) for k, (p, _) in enumerate(per)], "p long, before long")
    met = rows.join(F.broadcast(before), part == F.col("p"))
    return met.select("lk", "w1", "word", "a", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("id"))


def groups(codes: np.ndarray, hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k-word groups that the (k-1)-word groups at ``at`` make with the word that follows them: where, as rows of hashes of
    the distinct ones, and which of these each occurrence is."""
    if k == 1:
        return at, hashes[:, None], codes[at] - 1
    at = at[at + k - 1 < len(codes)]
    at = at[codes[at + k - 1] > 0]  # the merge: same piece, next position
    wide = np.int64(len(hashes) + 1)
    of = codes[at].astype(np.int64)
    for j in range(1, k):
        _, first, of = np.unique(of * wide + codes[at + j], return_index=True, return_inverse=True)
    return at, np.stack([hashes[codes[at[first] + j] - 1] for j in range(k)], axis=1), of


def _block(row: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hashes, codes and positions of the frequent groups of a block; without positions, all words."""
    hashes, codes, at = row
    codes = unpacked(codes, np.int32)
    return unpacked(hashes, np.uint64), codes, unpacked(at, np.int32).astype(np.int64) if at is not None else np.flatnonzero(codes)


def _member(key: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(key), bool)
    return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key


def frequent_only(blocks: DataFrame, counts: DataFrame, k: int, keys: int = KEYS) -> DataFrame:
    """The semi-join: the blocks (block, lang, hashes, codes, at) with the occurrences of frequent k-word groups, and n, their number.

    blocks: k = 1, all words; else the positions of frequent (k-1)-word groups. Words that no frequent group reaches leave the codes.
    counts: k = 1, w1 and id of the frequent words, which go by their ids from here on; else w1 to wk, ids.
    """
    spark = blocks.sparkSession
    few = counts.count() <= keys
    cols = ["block", "lang", "hashes", "codes", "at"]
    names = ["w1", "id"] if k == 1 else NAMES[:k]
    shared = None

    def numbers(columns) -> list[np.ndarray]:
        return [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]

    if few:
        found = numbers(c.combine_chunks() for c in counts.select(*names).toArrow().columns)  # at most ``keys`` rows
        key = found[0] if k == 1 else _key(np.stack(found, axis=1).view(np.uint64)).view(np.int64)
        order = np.argsort(key)
        shared = spark.sparkContext.broadcast((key[order], found[1][order] if k == 1 else None))
        src = blocks.select(cols)
    else:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, *row in _rows(batches):
                hashes, codes, at = _block(row)
                key = np.unique(_key(groups(codes, hashes, at, k)[1])).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block)), pa.array(key)], ["block", "key"])

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = numbers(b.columns)
                key = found[0] if k == 1 else _key(np.stack(found, axis=1).view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(found[1])], ["key", "id"])

        asked = map_rows(blocks.select("block", "hashes", "codes", "at"), ask, "block long, key long")
        there = map_rows(counts.select(*names), keyed, "key long, id long").groupBy("key").agg(F.max("id").alias("id"))
        met = asked.join(there, "key").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("key", "id"))).alias("met"))  # a block's own groups at most
        src = blocks.select(cols).join(met.select("block", F.col("met.key").alias("known"), F.col("met.id").alias("ids")), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lang, *row in _rows(batches):
            hashes, codes, at = _block(row[:3])
            known, ids = shared.value if shared is not None else (np.array(row[3], np.int64), np.array(row[4], np.int64))
            at, rows, of = groups(codes, hashes, at, k)
            at = at[_member(_key(rows).view(np.int64), known)[of]] if len(at) else at
            # what is reached: the group and the words it may still grow by
            near = np.zeros(len(codes), np.int32)
            near[at] += 1
            past = at + (LONGEST if k > 1 else 1)  # an infrequent word ends every group
            near[past[past < len(codes)]] -= 1
            kept = np.cumsum(near) > 0
            gap = kept & np.append(False, ~kept[:-1])  # a gap that is left out ends a piece
            slot = np.cumsum(kept.astype(np.int64) + gap) - 1
            new = np.zeros(int(slot[-1]) + 1 if len(slot) else 0, np.int32)
            new[slot[kept]] = codes[kept]
            used, back = np.unique(np.append(0, new), return_inverse=True)
            name = hashes[used[1:] - 1]
            if k == 1 and len(name):
                name = ids[np.searchsorted(known, name.view(np.int64))].view(np.uint64)
            out = packed(name), packed(back[1:].astype(np.int32)), packed(slot[at].astype(np.int32)) if k > 1 else None
            row = [pa.array([block], pa.int64()), pa.array([lang], pa.string()), *(pa.array([x], pa.binary()) for x in out), pa.array([len(at)], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, [*cols, "n"])

    return map_rows(src, run, "block long, lang string, hashes binary, codes binary, at binary, n long")


def group_counts(blocks: DataFrame, k: int, least: int) -> DataFrame:
    """w1 to wk, a of the k-word groups with at least ``least`` occurrences; blocks have the frequent (k-1)-word groups.

    A group crosses the exchange as one number for two words.
    """
    pairs = [f"p{j}" for j in range((k + 1) // 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, codes, at = _block(row)
            _, rows, of = groups(codes, hashes, at, k)
            rows = np.column_stack([rows, np.zeros((len(rows), k % 2), np.uint64)])
            n = np.bincount(of, minlength=len(rows)).astype(np.int64)
            cols = [(rows[:, j] << np.uint64(32) | rows[:, j + 1]).view(np.int64) for j in range(0, rows.shape[1], 2)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(n)], [*pairs, "n"])

    counted = map_rows(blocks.select("hashes", "codes", "at"), run, ", ".join(f"{n} long" for n in pairs) + ", n long")
    often = counted.groupBy(*pairs).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    word = [F.shiftright(f"p{j // 2}", 32) if j % 2 == 0 else F.col(f"p{j // 2}").bitwiseAND(F.lit((1 << 32) - 1)) for j in range(k)]
    return often.select(*[w.alias(n) for w, n in zip(word, NAMES)], "a")


def frequent(docs: DataFrame, least: int = MIN, keys: int = KEYS, root: str | None = None) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Counts of all words (lk, lang, w1, word, a), the frequent words with their ids, and the counts of the frequent phrases of 1 to
    ``LONGEST`` words (w1, ..., a; words by id)."""
    spark = docs.sparkSession
    root = root or scratch_dir(spark, "collocations")
    relation = _written(occurrences(docs.select("lang", "text")), root, "occurrences-1")
    words = _written(word_counts(relation), root, "counts-1")
    known = _written(numbered(words, least, root), root, "frequent-words-numbered")
    out = [known.select(F.col("id").alias("w1"), "a")]
    relation = relation.withColumn("at", F.lit(None).cast("binary"))
    for k in range(2, LONGEST + 1):
        relation = _written(frequent_only(relation, known if k == 2 else out[-1], k - 1, keys), root, f"occurrences-{k}")
        if k == 2:
            total, count, different = known.agg(F.coalesce(F.sum("a"), F.lit(0)), F.count("w1"), F.count_distinct("w1")).first()
            if count != different or total != relation.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]:
                raise ValueError("two words share a hash")
        _drop(spark, root, f"occurrences-{k - 1}")
        out.append(_written(group_counts(relation, k, least), root, f"counts-{k}"))
    _drop(spark, root, f"occurrences-{LONGEST}")
    return words, known, out


def _as(df: DataFrame, names: list[str], count: str) -> DataFrame:
    """A count table keyed by the words ``names`` of a phrase from the first on."""
    return df.select(*[F.col(f"w{j + 1}").alias(n) for j, n in enumerate(names)], F.col("a").alias(count))


def _wide(n: Column, by: int) -> Column:
    return n.cast("decimal(38,0)") * F.lit(by).cast("decimal(10,0)")


def scored(counts: list[DataFrame], k: int) -> DataFrame:
    """The frequent k-word phrases with l, r and score of their lowest-scoring cut."""
    names, df = NAMES[:k], counts[k - 1]
    cuts = []
    for j in range(1, k):
        for part, of in ((names[:j], f"l{j}"), (names[j:], f"r{j}")):
            df = df.join(broadcast_if_small(_as(counts[len(part) - 1], part, of), SMALL if len(part) == 1 else BROADCAST_BYTES), part)
        score = F.call_function("div", _wide(F.col("a"), 2_000_000), (F.col(f"l{j}").cast("decimal(20,0)") + F.col(f"r{j}").cast("decimal(20,0)")))
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("cut"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")))
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    missing = [F.lit(None).cast("long").alias(n) for n in NAMES[k:]]
    return df.select(*names, *missing, "a", best.alias("best")).select(*NAMES, "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = MIN, top: int = TOP, cover: int = COVER, keys: int = KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``LONGEST`` words."""
    words, known, counts = frequent(docs, least, keys)
    every = None
    for k in range(2, LONGEST + 1):
        every = scored(counts, k) if every is None else every.unionByName(scored(counts, k))
    # the largest count of a longer candidate around each shorter one
    inside = None
    for k in range(3, LONGEST + 1):
        for m in range(2, k):
            for j in range(k - m + 1):
                part = [F.col(NAMES[j + i]).alias(NAMES[i]) if i < m else F.lit(None).cast("long").alias(NAMES[i]) for i in range(LONGEST)]
                some = counts[k - 1].select(*part, F.col("a").alias("longer"))
                inside = some if inside is None else inside.unionByName(some)
    # a missing word is zero on both sides, which is no word's id
    fill = lambda df: df.select(*[F.coalesce(n, F.lit(0)).alias(n) for n in NAMES], *[c for c in df.columns if c not in NAMES])
    longer = fill(inside).groupBy(*NAMES).agg(F.max("longer").alias("longer"))
    kept = fill(every).join(longer, NAMES, "left").where(F.isnull("longer") | (_wide(F.col("longer"), 100) < _wide(F.col("a"), cover)))
    texts = known.select("id", "lk", "word")
    for j, n in enumerate(NAMES):
        text = texts.select(F.col("id").alias(n), F.col("word").alias(f"t{j}"), *(["lk"] if j == 0 else []))
        kept = kept.join(broadcast_if_small(text, SMALL), n, "inner" if j < 2 else "left")
    phrase = F.concat_ws(" ", *[f"t{j}" for j in range(LONGEST)])
    order = Window.partitionBy("lk").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.select("lk", phrase.alias("phrase"), "a", "l", "r", "score")
    # the first of each part, then of these: a language's phrases don't meet in one task
    parts = Window.partitionBy("lk", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = first.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(language_counts(words), "lk").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = f"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece,
  generate_subscripts(string_split_regex(coalesce(text, ''), '[.,;:!?\\x0A-\\x0D]'), 1) AS pn FROM documents),
t AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^ \\t]+') AS ws FROM p),
w AS (SELECT pid, lang, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM t),
g AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY pid ORDER BY i)),
f AS (SELECT lang, [w1] AS ph, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN}
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN}
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN}),
c AS (SELECT lang, ph, f AS a FROM f WHERE len(ph) > 1),
k AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS k FROM c),
s AS (SELECT k.lang, k.ph, k.a, k.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * k.a // (x.f + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.ph = list_slice(k.ph, 1, k.k) JOIN f y ON y.lang = k.lang AND y.ph = list_slice(k.ph, k.k + 1, len(k.ph))),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
z AS (SELECT lang, list_slice(ph, i, i + m - 1) AS ph, max(a) AS longer FROM (SELECT lang, ph, a, m, unnest(range(1, len(ph) - m + 2)) AS i FROM (SELECT lang, ph, a, unnest(range(2, len(ph))) AS m FROM c)) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(ph) = 1 GROUP BY lang),
o AS (SELECT b.*, list_aggregate(b.ph, 'string_agg', ' ') AS phrase FROM b LEFT JOIN z ON z.lang = b.lang AND z.ph = b.ph WHERE z.longer IS NULL OR 100 * z.longer < {COVER} * b.a)
SELECT o.lang, CAST(row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n.n AS BIGINT) AS n, score
FROM o JOIN n ON n.lang = o.lang QUALIFY rank <= {TOP}
"""
