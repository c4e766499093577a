"""Toxicity: class-conditional Kneser-Ney models of words and word pairs, toxic against ordinary.

Counts are continuation counts: the documents of a class that hold an expression, so one long or repetitive
document counts once. What the discounts free goes to counts that both classes share, so
an expression that is rare in either class says little; one that a single document holds says least, but it counts.  A word after a known
pair's first word is scored by the pair, P(w | v) = P(v w) / P(v), else it backs off to the word alone.  A text is scored by length-normalised
log-likelihood ratios: the mean per word, and the highest of any expression against the text's length (a few toxic words in a long text).
A logistic curve over labelled rows that the counts did not use turns them into a score.

Every training row is counted but the ``CURVE`` (at most a fifth of the ids) that fit the curve; of an id whose many texts the curve only
samples, the others are counted.  Spark adds the counts up by 64-bit hash, and every expression is in the model.  The ``KEYS`` that most
documents hold are broadcast, 16 bytes each; further ones stay a table, and a bit set sized by their number (``BITS`` at most) says which
expressions can't be in it.  Scoring resolves what it can in the row.  What is left is asked for by blocks of texts: a block's distinct keys,
sorted and cut by the keys' high bits, meet the part of the table that has these bits; the answers come back in the block's order.
An expression that only one counted text holds needs no table when that text itself is scored: its class is the text's, known by the text's hash
(of ``OWN`` texts at most, others ask).

Defined cases: a null text is empty; an empty text has ratio zero and gets the curve's constant; labels other than 0 or 1 are
not learnt from; with labels of one class the score is flat; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .collocations import CLEANUP, packed, unpacked
from .common import broadcast_if_small, cut, map_rows, slices, uniform
from .labelled import calibrate, held_out, labelled_texts, sampled_texts, training_labels

KEYS, CURVE = 4_000_000, 4_000
DISCOUNT = 0.75
BITS = 27  # the bit set has 2^BITS bits at most
FLUSH, MEMO = 2_000_000, 300_000  # counted expressions a task holds before it hands them on; words whose hashes it remembers
OWN = 4_000_000  # counted texts whose class is broadcast at most, 9 bytes each
PART, ASKS, TEXTS = 1 << 20, 1 << 16, 4_096  # keys of the table that are at hand at once, about; open positions and texts of a block
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_024
WORD_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD_RUN.findall(text.lower()) if text else []


def log_ratio(tox: np.ndarray, ordn: np.ndarray, totals: tuple[float, float, float, float]) -> np.ndarray:
    """log P(x | toxic) - log P(x | ordinary) by interpolated Kneser-Ney with the class as context.

    totals: tokens and types of the toxic, then of the ordinary class.  The discounted mass of a class goes to the
    continuation counts that both share: the number of classes an expression occurs in (half for none).
    """
    shared = np.maximum((tox > 0).astype(float) + (ordn > 0), 0.5) / max(totals[1] + totals[3], 1.0)
    out = []
    for count, tokens, types in ((tox, *totals[:2]), (ordn, *totals[2:])):
        tokens = max(tokens, 1.0)
        out.append(np.log(np.maximum(count - DISCOUNT, 0) / tokens + DISCOUNT * max(types, 1.0) / tokens * shared))
    return out[0] - out[1]


def _ratio(totals: tuple[float, float, float, float]) -> Column:
    """``log_ratio`` of the columns tox and ord."""
    shared = F.greatest((F.col("tox") > 0).cast("double") + (F.col("ord") > 0).cast("double"), F.lit(0.5)) / max(totals[1] + totals[3], 1.0)
    one = lambda c, tokens, types: F.log(F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / max(tokens, 1.0) + shared * (DISCOUNT * max(types, 1.0) / max(tokens, 1.0)))
    return one("tox", *totals[:2]) - one("ord", *totals[2:])


class Keys(dict):
    """Hashes of words, even numbers, remembered for a while."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        k = self[word] = (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) | 1) - 1 or 2
        return k

    def of(self, text: str | None) -> np.ndarray:
        w = words_of(text)
        return np.fromiter(map(self.__getitem__, w), np.uint64, len(w))


def pair_keys(h: np.ndarray) -> np.ndarray:
    """A hash, an odd number, of each word with the one before it."""
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) | np.uint64(1)


def _find(keys: np.ndarray, values: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The value of each key, nan where it has none; ``keys`` are sorted."""
    if not len(keys):
        return np.full(len(key), np.nan)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at], np.nan)


def _dense(keys: np.ndarray) -> bytes:
    """Sorted keys as bytes: their differences, compressed byte by byte of all; the fewer bits these need, the smaller."""
    d = np.diff(keys.view(np.uint64), prepend=np.uint64(0))
    return packed(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T))


def _keys(data: bytes) -> np.ndarray:
    d = np.array(unpacked(data, np.uint8).reshape(8, -1).T, order="C").view(np.uint64).ravel()
    return np.cumsum(d, out=d).view(np.int64)


def _parts(keys: np.ndarray, shift: int) -> np.ndarray:
    """The part of the table that each key is in, in the keys' order: its bits from ``shift`` on."""
    return (keys >> shift) + (1 << (63 - shift))


class Model:
    """Ratios of the most frequent expressions by sorted key, of unknown words, and the bits of the keys in the table of others.

    ``own``, if given, has sorted hashes of counted texts and their class; ``single`` the ratio of a word and a pair (rows) that only one
    ordinary or toxic document (columns) holds; ``often`` the bits of the table's keys that two documents or more hold; ``shift``
    cuts keys into parts of the table.
    """

    def __init__(self, table: tuple[np.ndarray, np.ndarray], unknown: float, bits: np.ndarray | None):
        values, of = np.unique(table[1], return_inverse=True)  # many keys have the same ratio
        self.table = table[0], of.astype(np.min_scalar_type(len(values))), values
        self.unknown, self.bits, self.curve = unknown, bits, np.zeros(4)
        self.own = self.single = self.often = None
        self.shift = 63

    def __getstate__(self) -> dict:
        """As it is broadcast, by few bytes a key."""
        k, of, values = self.table
        return self.__dict__ | {"table": (_dense(k), packed(of), of.dtype, values)}

    def __setstate__(self, state: dict) -> None:
        k, of, kind, values = state.pop("table")
        self.__dict__.update(state)
        self.table = _keys(k), unpacked(of, kind), values

    @staticmethod
    def maybe(bits: np.ndarray | None, key: np.ndarray) -> np.ndarray:
        """Which keys may be among those of the bits."""
        if bits is None:
            return np.zeros(len(key), bool)
        at = key.view(np.uint64) & np.uint64(64 * len(bits) - 1)
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def ratios(self, keys: np.ndarray) -> np.ndarray:
        """The ratio of each key that is held here, nan for others; equal keys are looked up once."""
        distinct, of = np.unique(keys, return_inverse=True)
        which = _find(*self.table[:2], distinct)
        found = ~np.isnan(which)
        which[found] = self.table[2][which[found].astype(np.int64)]
        return which[of]

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        """The class of each text that was counted, by its hash; -1 for others."""
        y = _find(*self.own, hashes) if self.own else np.full(len(hashes), np.nan)
        return np.where(np.isnan(y), -1, y).astype(np.int64)

    def look(self, texts: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """For texts of word hashes and their classes: sum and highest of the ratios (of each word after the word before it) that are resolved
        here, and of the open positions the text, the keys of pair, word and word before, what is known of them (nan: nothing), whether they are asked for."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        word = np.concatenate([np.zeros(0, np.uint64), *texts])
        text, first = np.repeat(np.arange(len(texts)), size), np.zeros(len(word), bool)
        first[(np.cumsum(size) - size)[size > 0]] = True  # no word is before the first
        lead = np.append(word[:1], word[:-1])
        pair = np.append(np.zeros(len(word[:1]), np.uint64), pair_keys(word))
        pair[first] = 0
        keys = [x.view(np.int64) for x in (pair, word, lead)]
        r = self.ratios(keys[1])
        known = [self.ratios(keys[0]), r, np.append(r[:1], r[:-1])]
        own, ask = y[text], []
        for j, (x, k) in enumerate(zip(known, keys)):
            at = np.flatnonzero(np.isnan(x) & ~first) if j != 1 else np.flatnonzero(np.isnan(x))
            counted = own[at] >= 0
            may = np.where(counted, self.maybe(self.often, k[at]), self.maybe(self.bits, k[at]))
            ask.append(np.zeros(len(word), bool))
            ask[j][at[may]] = True
            if counted.any():  # no other document holds it
                at = at[counted & ~may]
                x[at] = self.single[int(j == 0)][own[at]]
        has = ~np.isnan(known[0])
        ask[1] &= ~has  # a known pair needs the word before, an unknown one the word
        ask[2] &= has | ask[0]
        value = _value(*known, self.unknown)
        open_ = ask[0] | ask[1] | ask[2]
        value[open_] = 0.0
        total = np.bincount(text, value, minlength=len(texts)).astype(float)  # whole numbers where there is no word
        peak = np.full(len(texts), -1e300)
        value[open_] = -1e300
        if len(word):
            peak[size > 0] = np.maximum.reduceat(value, np.flatnonzero(first))
        return total, peak, text[open_], *([x[open_] for x in part] for part in (keys, known, ask))


def _value(pair: np.ndarray, word: np.ndarray, lead: np.ndarray, unknown: float) -> np.ndarray:
    """The ratio of a word after another: by the pair if it is known, else by the word."""
    first, alone = (np.where(np.isnan(r), unknown, r) for r in (lead, word))
    return np.where(np.isnan(pair), alone, pair - first)


def _counts(texts: DataFrame) -> DataFrame:
    """k, tox, ord: documents of each class with an expression; the last bit of k tells pairs (1) from words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(parts):
            k, n = (np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, np.int64) for j in (0, 1))
            order = np.argsort(k, kind="stable")
            k, n = k[order], n[order]
            start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(k[start]), pa.array(np.add.reduceat(n, start) if len(k) else n)], ["k", "n"])

        keys, parts, held = Keys(), [], 0
        for b in slices(batches, 64):
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = keys.of(text)
                k = np.unique(np.concatenate([h, pair_keys(h)])).view(np.int64)
                parts.append((k, np.full(len(k), 1 << 32 if y else 1, np.int64)))
                held += len(k)
                if held > FLUSH:
                    yield give(parts)
                    parts, held = [], 0
        yield give(parts)

    # both counts in one number: toxic documents above bit 32, ordinary ones below
    n = map_rows(texts.select("y", "text"), run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    return n.select("k", F.shiftright("n", 32).cast("int").alias("tox"), F.col("n").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("ord"))


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """What is run in here gets Arrow batches of ``ROWS`` rows at most, as texts and blocks are long, and loses its shuffle files when it ends."""
    rows = int(spark.conf.get(BATCH))
    new = {CLEANUP: "true", BATCH: str(min(rows, ROWS) if rows > 0 else ROWS)}
    before = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _written(df: DataFrame) -> DataFrame:
    """Evaluate once into a compressed table in the shared folder: a checkpoint of these rows takes more disk."""
    path = scratch_dir(df.sparkSession, "toxicity")
    with _tidy(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and ratios of (k, r)."""
    t = df.select("k", "r").toArrow()
    k, r = t.column(0).to_numpy(), t.column(1).to_numpy()
    order = np.argsort(k)
    return k[order], r[order]


def _bits(rest: DataFrame, n: int) -> np.ndarray | None:
    """A bit for every key of ``rest``: about sixteen bits a key, 2^``BITS`` at most. Each task sets its own, then pieces of them meet."""
    if not n:
        return None
    size = 1 << min(BITS, max(12, (16 * n - 1).bit_length()))
    step = min(size >> 6, 1 << 15)

    def given(pieces: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array([packed(x) for x in pieces.values()], pa.binary())], ["i", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size >> 6, np.uint64)
        for b in batches:
            at = b.column(0).to_numpy().view(np.uint64) & np.uint64(size - 1)
            np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        yield given({lo: bits[lo : lo + step] for lo in range(0, len(bits), step) if bits[lo : lo + step].any()})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {}  # of 2^BITS bits at most
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1)):
                x = unpacked(data.as_py(), np.uint64)
                pieces[i] = pieces[i] | x if i in pieces else x
        yield given(pieces)

    with _tidy(rest.sparkSession):
        got = map_rows(map_rows(rest.select("k"), run, "i int, data binary").repartition("i"), meet, "i int, data binary").toArrow()  # 2^BITS bits at most
    bits = np.zeros(size >> 6, np.uint64)
    for i, data in zip(got.column(0).to_pylist(), got.column(1)):
        bits[i : i + step] = unpacked(data.as_py(), np.uint64)
    return bits


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", keys: int = KEYS, curve_rows: int = CURVE, least: int = 2) -> tuple[Model, DataFrame]:
    """The model and the table (k, r) of the expressions that it doesn't hold.

    Expressions of fewer than ``least`` documents count in their class's totals only; the query takes 1, so all are in the model.
    """
    train = training_labels(labels, label)
    total = train.count()
    aside = uniform(F.lit("curve"), F.col("doc_id")) < min(0.2, curve_rows / max(total, 1))
    # the curve: rows the counts do not use, in their natural shares
    sample = sampled_texts(docs, train.where(aside).select("doc_id", "y"), curve_rows)
    texts = labelled_texts(docs, train.select("doc_id", "y")).withColumn("text_hash", F.xxhash64("text"))
    texts = texts.join(broadcast_if_small(cut(sample.select("doc_id", "text_hash").distinct())), ["doc_id", "text_hash"], "left_anti")
    counted = _counts(texts)
    # every expression is counted in its class's totals; one that isn't in the model needs no key
    counted = _written(counted.select(F.when(F.col("tox") + F.col("ord") >= least, F.col("k")).alias("k"), F.col("k").bitwiseAND(F.lit(1)).alias("pair"), "tox", "ord"))
    sums = [F.sum("tox"), F.count_if(F.col("tox") > 0), F.sum("ord"), F.count_if(F.col("ord") > 0)]
    by = {r.pair: tuple(float(x or 0) for x in r[1:]) for r in counted.groupBy("pair").agg(*sums).collect()}
    of_words, of_pairs = by.get(0, (0.0,) * 4), by.get(1, (0.0,) * 4)
    known = counted.where("k is not null").select("k", (F.col("tox") + F.col("ord")).alias("n"), F.when(F.col("pair") == 0, _ratio(of_words)).otherwise(_ratio(of_pairs)).alias("r"))
    # the most frequent: all above the count at which they would be too many, then by key
    sizes = sorted(((r.n, r.c) for r in known.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)  # a row for every count that occurs
    most, held = 0, 0
    for n, c in sizes:
        if held + c > keys:
            most = n
            break
        held += c
    top, rest = known.where(F.col("n") > most), known.where(F.col("n") <= most)
    unknown = float(log_ratio(np.zeros(1), np.zeros(1), of_words)[0])
    left = sum(c for _, c in sizes) - held
    model = Model(_table(top), unknown, _bits(rest, left))  # at most ``keys`` rows
    model.shift = 63 - max(0, math.ceil(math.log2(max(left, 1) / PART)))
    if left and least == 1:
        model.often = _bits(rest.where("n > 1"), sum(c for n, c in sizes if 1 < n <= most))
        model.single = [log_ratio(np.array([0.0, 1.0]), np.array([1.0, 0.0]), of) for of in (of_words, of_pairs)]
        model.own = _own(texts)
    rest = rest.select("k", "r")
    model.curve = _curve(sample, model, rest)
    return model, rest


def _own(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and classes of the counted texts, ``OWN`` at most; a text that was counted more often has no expression of its own, whichever class is kept."""
    once = cut(texts.groupBy("text_hash").agg(F.max("y").alias("y")))
    few = once.where(uniform(F.lit("own"), F.col("text_hash")) < 0.98 * OWN / max(once.count(), 1))
    return _table(few.select(F.col("text_hash").alias("k"), F.col("y").cast("byte").alias("r")))


def _sealed(**columns) -> bytes:
    """Columns of one length as compressed bytes."""
    batch, sink = pa.RecordBatch.from_pydict(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


BLOCKS = "b long, p int, n int, data binary, spots binary"


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of ``BLOCKS``."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)], ["b", "p", "n", "data", "spots"])


def _cuts(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Part, begin and end of each run of equal parts."""
    start = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else np.zeros(0, np.int64)
    return zip(parts[start].tolist(), start.tolist(), np.append(start[1:], len(parts)).tolist())


def _block(number: int, model: Model, kept: pa.Array, total: np.ndarray, peak: np.ndarray, size: np.ndarray, text: np.ndarray, keys: list, known: list, ask: list) -> list[tuple]:
    """Rows of a block: its texts and open positions (p = -1), and the distinct keys that these ask for, by part of the table."""
    every, of = np.unique(np.concatenate([k[a] for k, a in zip(keys, ask)]), return_inverse=True)
    spots, at = {"text": text.astype(np.int32)}, 0
    for j, (x, a) in enumerate(zip(known, ask)):
        answer = np.full(len(text), -1, np.int32)
        answer[a] = of[at : at + a.sum()]
        at += int(a.sum())
        spots |= {f"x{j}": x, f"a{j}": answer}
    rows = [(number, -1, len(every), _sealed(kept=kept, total=total, peak=peak, size=size), _sealed(**spots))]
    return rows + [(number, p, hi - lo, _dense(every[lo:hi]), None) for p, lo, hi in _cuts(_parts(every, model.shift))]


def _answered(asked: DataFrame, rest: DataFrame, shift: int) -> DataFrame:
    """The blocks' keys become their ratios, nan where the table ``rest`` hasn't got them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(parts):
            k, r = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(k)
            k, r = k[order], r[order]
            return _rows_of([(-1, p, hi - lo, _dense(k[lo:hi]), packed(r[lo:hi])) for p, lo, hi in _cuts(_parts(k, shift))])

        parts, held = [], 0
        for b in batches:
            parts.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            held += b.num_rows
            if held > FLUSH:
                yield give(parts)
                parts, held = [], 0
        if held:
            yield give(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, table = None, [], None
        for b in batches:
            out = []
            for j in range(b.num_rows):
                block, p, n, data, spots = (c[j].as_py() for c in b.columns)
                if p != at:
                    at, parts, table = p, [(np.zeros(0, np.int64), np.zeros(0))], None
                keys = _keys(data)
                if block < 0:
                    parts.append((keys, unpacked(spots, np.float64)))
                    continue
                if table is None:  # a part's table comes before its blocks
                    k, r = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(k)
                    table, parts = (k[order], r[order]), []
                out.append((block, p, n, packed(_find(*table, keys)), None))
            yield _rows_of(out)

    met = map_rows(rest.select("k", "r"), pack, BLOCKS).unionByName(asked)
    return _written(map_rows(met.repartition("p").sortWithinPartitions("p", "b"), run, BLOCKS))


def _features(df: DataFrame, model: Model, rest: DataFrame, keep: str) -> DataFrame:
    """``keep`` and the features of every row of (keep, text): mean and highest ratio, log length."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[keep].dataType.simpleString()
    whole = f"kept {kind}, x double, peak double, n long"
    asks, unknown = model.bits is not None, model.unknown

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m, keys, number = shared.value, Keys(), TaskContext.get().partitionId() << 32
        held, texts, spots = [], 0, 0

        def give():
            kept, total, peak, size, text, *three = zip(*held)
            first = np.cumsum([0, *map(len, kept)])
            three = [[np.concatenate(x) for x in zip(*part)] for part in three]
            columns = [np.concatenate(x) for x in (total, peak, size)]
            return _rows_of(_block(number, m, pa.concat_arrays(kept), *columns, np.concatenate([t + at for t, at in zip(text, first)]), *three))

        for b in slices(batches, 64):
            h = [keys.of(t) for t in b.column(1).to_pylist()]
            total, peak, text, *three = m.look(h, m.classes(b.column(2).to_numpy()))
            size = np.fromiter(map(len, h), np.int64, len(h))
            if not asks:
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (total, peak, size))], ["kept", "x", "peak", "n"])
                continue
            held.append((b.column(0), total, peak, size, text, *three))
            texts, spots = texts + len(h), spots + len(text)
            if spots > ASKS or texts > TEXTS:
                yield give()
                held, texts, spots, number = [], 0, 0, number + 1
        if held:
            yield give()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's texts and positions come first, then its answers in the keys' order."""

        def give(data, spots, answers):
            t, s = _opened(data), _opened(spots)
            r = np.concatenate([np.zeros(0), *answers, [np.nan]])  # what is not asked for (-1) has no answer
            x = [np.where(s[f"a{j}"].to_numpy() < 0, s[f"x{j}"].to_numpy(), r[s[f"a{j}"].to_numpy()]) for j in range(3)]
            value, text = _value(*x, unknown), s["text"].to_numpy()
            total, peak = t["total"].to_numpy() + np.bincount(text, value, minlength=t.num_rows), t["peak"].to_numpy().copy()
            np.maximum.at(peak, text, value)
            return pa.RecordBatch.from_arrays([t["kept"], pa.array(total), pa.array(peak), t["size"]], ["kept", "x", "peak", "n"])

        held = None
        for b in batches:
            for j in range(b.num_rows):
                p = b.column(1)[j].as_py()
                if p < 0:
                    if held:
                        yield give(*held)
                    held = b.column(3)[j].as_py(), b.column(4)[j].as_py(), []
                else:
                    held[2].append(unpacked(b.column(3)[j].as_py(), np.float64))
        if held:
            yield give(*held)

    rows = map_rows(df.select(keep, "text", F.xxhash64("text")), run, BLOCKS if asks else whole)
    if asks:
        blocks = _written(rows)
        shared.destroy()  # every executor keeps a copy on disk
        answers = _answered(blocks.where("p >= 0"), rest, model.shift)
        rows = map_rows(blocks.where("p < 0").unionByName(answers).repartition("b").sortWithinPartitions("b", "p"), close, whole)
    return rows.select(F.col("kept").alias(keep), F.when(F.col("n") > 0, F.col("x") / F.col("n")).otherwise(F.lit(0.0)).alias("mean"), "peak", F.log1p(F.col("n").cast("double")).alias("size"))


def _curve(texts: DataFrame, model: Model, rest: DataFrame) -> np.ndarray:
    """Of the rows (y, n, text); y and n go as one number."""
    both = texts.select((F.col("n") * 2 + F.col("y")).alias("both"), "text")
    got = _features(both, model, rest, "both").toArrow().to_pandas().sort_values(["both", "mean", "peak", "size"])  # bounded by the curve's rows
    both = got["both"].to_numpy(int)
    return calibrate(got[["mean", "peak", "size"]].to_numpy(float), (both % 2).astype(float), (both // 2).astype(float))


def score(docs: DataFrame, model: Model, rest: DataFrame) -> DataFrame:
    """doc_id, mean, peak and score of every row."""
    *w, c = (float(x) for x in model.curve)
    margin = sum((F.lit(a) * F.col(n) for a, n in zip(w, ("mean", "peak", "size"))), F.lit(c))
    return _features(docs, model, rest, "doc_id").withColumn("score", F.lit(1.0) / (F.exp(-margin) + 1.0))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score(docs, *fit(docs, labels, least=1))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
