"""Best-fit-decreasing packing of tokenized documents into sequences.

Pieces of equal length are interchangeable, and so are sequences with equal
room.  The packer therefore works on the histogram of piece lengths (at most
``size`` numbers, whatever the corpus) and on runs of sequences with equal
room: longest pieces first, each into the tightest sequence that still fits,
found by a segment tree over the remaining capacities.  This is the packing
that best-fit decreasing gives over all pieces of all documents, not one
per partition.  Its plan says, for every length, which ranks of its pieces
go to which sequences; every piece then finds its place from its length
and rank.

Ranks come from slices of a length: counts by slice, running sums over the
slices, a row number within a slice.  A length has as many slices as its
rows need, so many equal documents don't meet in one task.

Defined cases: a null text is empty and gives the closing token alone; rows
equal in everything are interchangeable; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_rows, slices

SIZE = 2048
VOCABULARY = "byte_bpe_50k.json"
SLICES = 4096  # slices beyond one per length, in all
MEMO, STORED = 120_000, 750_000  # words at hand, and words of a stored generation, that a worker keeps encoded
#: runs of letters, digits and signs as a byte-level vocabulary cuts them, for words of these characters alone; \p{L} and \p{N} of rarer ones are the tokenizer's to know
LETTER, DIGIT, SIGN = "A-Za-zÀ-ÖØ-öø-ſ", "0-9", r"!-/:-@\[-`{-~"
PLAIN = re.compile(f"[{LETTER}{DIGIT}{SIGN}]+").fullmatch
PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{DIGIT}]+| ?[{SIGN}]+").findall
#: the characters that stand for the bytes in a byte-level vocabulary
UNSEEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
SHOWN = "".join(chr(256 + UNSEEN.index(b)) if b in UNSEEN else chr(b) for b in range(256))


class Store:
    """Tokens of words by 64-bit hash, in arrays: about 30 bytes a word."""

    def __init__(self):
        self.keys, self.start, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def add(self, keys: np.ndarray, tokens: list[bytes]) -> None:
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        start = np.cumsum(size) - size + len(self.pool)
        keys, first = np.unique(keys, return_index=True)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = np.insert(self.keys, at, keys), np.insert(self.start, at, start[first]), np.insert(self.size, at, size[first])
        self.pool = np.append(self.pool, np.frombuffer(b"".join(tokens), np.uint8))

    def find(self, keys: np.ndarray) -> list[bytes | None]:
        if not len(self.keys):
            return [None] * len(keys)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        raw = memoryview(self.pool)
        return [bytes(raw[s : s + n]) if yes else None for yes, s, n in zip((self.keys[at] == keys).tolist(), self.start[at].tolist(), self.size[at].tolist())]


class Encoder:
    """Token ids of texts as little-endian bytes, with a bounded memory of encoded words.

    A byte-level vocabulary never joins across the parts that its pattern cuts. In a run of white space the last character
    goes with the word after it if it is a space, and stands alone otherwise; the run's others are one part. So where no run is longer
    than two (one at the text's end), a text is cut at line ends and spaces, and each word is looked up with the space before it.
    A new word of Latin letters, digits and ASCII signs is cut as the pattern cuts it, and its parts go straight to the tokenizer's model. Other new
    words of some texts go through the tokenizer together, a line each: the token of the line end tells them apart.  Other texts, and
    vocabularies of another kind, are encoded whole.

    A worker keeps ``MEMO`` words at hand and two generations of ``STORED`` words in compact arrays (together about 80 MB at most; a word's
    key is its hash in this process): a
    word asked for again is handed on, the others go with their generation.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.near: dict[str, bytes] = {}  # words at hand
        self.fresh: list[tuple[np.ndarray, list[bytes]]] = []  # words at hand that the store doesn't have
        self.store, self.older = Store(), Store()
        self.uneven = re.compile(r"\s\s(?:\s|\Z)").search
        self.end = self._ids("\n")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and spec["normalizer"] is None and spec["post_processor"] is None and len(self.end) == 1)
        self.by_part = self.by_word and spec["model"]["type"] == "BPE" and all(t["special"] for t in spec["added_tokens"])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        whole, cut, asked = [], {}, set()
        for k, t in enumerate(texts):
            if not self.by_word or self.uneven(t):
                whole.append(k)
                continue
            # a word at the start of a line is kept with the line end before it, any other is kept bare
            words = t.replace("\n", " \n").split(" ")
            words[0] = "\n" + words[0]
            cut[k] = words
            asked.update(words)
        self._learn(asked)
        look, first = self.near.__getitem__, len(self.end) * 4
        for k, words in cut.items():
            out[k] = b"".join(map(look, words))[first:]
        for lo in range(0, len(whole), 16):
            some = whole[lo : lo + 16]
            for k, e in zip(some, self.tok.encode_batch_fast([texts[k] for k in some], add_special_tokens=False)):
                out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def _learn(self, asked: set[str]) -> None:
        """All words of ``asked`` to hand."""
        if len(self.near) > MEMO:
            for keys, tokens in self.fresh:
                self.store.add(keys, tokens)
            self.near, self.fresh = {"\n": self.end.tobytes()}, []
            if len(self.store.keys) > STORED:
                self.store, self.older = Store(), self.store
        missing = list(asked.difference(self.near))
        keys = np.fromiter(map(hash, missing), np.int64, len(missing)).view(np.uint64)
        found = self.store.find(keys)
        lost = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(lost, self.older.find(keys[lost])):
            found[k] = x
        new = [k for k in lost if found[k] is None]
        for k, x in zip(new, self._encoded([missing[k] for k in new])):
            found[k] = x
        self.near.update(zip(missing, found))
        if lost:
            self.fresh.append((keys[lost], [found[k] for k in lost]))

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Tokens of " word" or, at the start of a line, of the line end and "word"."""
        if not self.by_part:
            return self._by_line(words)
        ids, at, rest = [], [0], []
        model, number, end = self.tok.model.tokenize, attrgetter("id"), int(self.end[0])
        for w in words:
            line = w[:1] == "\n"
            if w.isalpha() and w.isascii():
                ids.extend(map(number, model("Ġ" + w)))
            elif PLAIN(w, line):  # from 1 on if the line end is there
                if line:
                    ids.append(end)
                for part in PARTS(w, 1) if line else PARTS(" " + w):
                    # the bytes of a part, each as the character that shows it
                    ids.extend(map(number, model(part.replace(" ", "Ġ") if part.isascii() else charmap_decode(part.encode(), "strict", SHOWN)[0])))
            else:
                rest.append(len(at) - 1)
            at.append(len(ids))
        raw = np.array(ids, "<u4").tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(at, at[1:])]
        for k, x in zip(rest, self._by_line([words[k] for k in rest])):
            out[k] = x
        return out

    def _by_line(self, words: list[str]) -> list[bytes]:
        head, out = self.end.tobytes(), []
        # white space in a word is a run with what stands around it
        alone = {k for k, w in enumerate(words) if len(w.split()) != 1 or w[-1].isspace() or w[1:2].isspace() or (w[0] != "\n" and w[0].isspace())}
        for lo in range(0, len(words), 4096):
            some = [w for k, w in enumerate(words[lo : lo + 4096], lo) if k not in alone]
            ids = self._ids("".join([w[1:] + "\n" if w[0] == "\n" else f" {w}\n" for w in some]))
            ends = (4 * np.flatnonzero(ids == self.end[0])).tolist()  # the one token that no word has
            raw = ids.tobytes()
            lines = iter([raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends)])
            for k, w in enumerate(words[lo : lo + 4096], lo):
                if k in alone:
                    out.append(head + self._ids(w[1:]).tobytes() if w[:1] == "\n" else self._ids(" " + w).tobytes())
                else:
                    out.append(head + next(lines) if w[0] == "\n" else next(lines))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, kept between tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of a document's pieces: whole ones, the first takes what is over."""
    full, over = divmod(n, size)
    return ([over] if over else []) + [size] * full


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its token ids if asked for.

    path: the vocabulary file on the executors; by default the public one by name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path
        if where is None:
            import public_tokenizers

            where = public_tokenizers.path(VOCABULARY)
        enc = encoder(where)
        for b in slices(batches, 128):
            row, cols = [], [[], [], [], [], []]
            for k, e in enumerate(enc.encode([t or "" for t in b.column(1).to_pylist()])):
                e += b"\0\0\0\0"
                at = 0
                for j, n in enumerate(cut_lengths(len(e) // 4, size)):
                    part = e[4 * at : 4 * (at + n)]
                    row.append(k)
                    for col, v in zip(cols, (j, at, n, zlib.crc32(part), part if ids else None)):
                        col.append(v)
                    at += n
            out = [b.column(0).take(pa.array(row, pa.int32())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:4])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                out, names = [*out, pa.array(cols[4], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


class Tree:
    """Segment tree over capacities 0 to size: is there an open sequence with that room?"""

    def __init__(self, size: int):
        self.n = 1 << size.bit_length()
        self.has = [False] * (2 * self.n)

    def set(self, room: int, yes: bool) -> None:
        k = self.n + room
        self.has[k] = yes
        while k > 1:
            k //= 2
            self.has[k] = self.has[2 * k] or self.has[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest room of at least ``need``."""
        k = self.n + need
        if self.has[k]:
            return need
        while k > 1:
            if k % 2 == 0 and self.has[k + 1]:
                k += 1
                while k < self.n:
                    k = 2 * k if self.has[2 * k] else 2 * k + 1
                return k - self.n
            k //= 2
        return None


def best_fit(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counted lengths.

    Returns (length, first rank, sequences, pieces per sequence, first sequence, offset): that many sequences from
    the first on take so many pieces each, from the offset on, in order of rank. Only the last
    sequence of a row may get fewer.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)
    tree, plan, opened = Tree(size), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, per = size, size // length
                first, have = opened, -(-left // per)
                opened += have
            else:
                per = room // length
                first, have = runs[room].pop()
            use = min(have, -(-left // per))
            took = min(left, use * per)
            plan.append((length, rank, use, per, first, size - room))
            if have > use:
                runs[room].append((first + use, have - use))
            elif room < size and not runs[room]:
                tree.set(room, False)
            full, odd = divmod(took, per)
            for start, n, items in ((first, full, per), (first + full, 1, odd)):
                rest = room - items * length
                if n and items and rest:
                    runs.setdefault(rest, []).append((start, n))
                    tree.set(rest, True)
            rank, left = rank + took, left - took
    return plan


def place(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``items`` (with length, written or cut) with sequence_id and offset."""
    spark = items.sparkSession
    hist = {r.length: r.n for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
    total = sum(hist.values())
    plan = np.array(best_fit(hist, size), dtype=np.int64).reshape(-1, 6)
    share = spark.createDataFrame([(k, 1 + n * SLICES // total) for k, n in hist.items()], "length long, parts long")
    sliced = items.join(F.broadcast(share), "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "parts")).drop("parts")
    per = sliced.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect()  # at most size + SLICES rows
    at, before = dict.fromkeys(hist, 0), []
    for r in sorted(per):
        before.append((r.length, r.part, at[r.length]))
        at[r.length] += r.n
    before = spark.createDataFrame(before, "length long, part long, before long")
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (sliced.withColumn("rank", F.row_number().over(order).cast("long") - 1)
              .join(F.broadcast(before), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part"))
    # the plan, in order of (length, first rank), as one sorted key
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))] if len(plan) else plan
    wide = 1 << 50
    keys = plan[:, 0] * wide + plan[:, 1]  # lengths stay below 2^13, ranks below 2^50
    shared = spark.sparkContext.broadcast((keys, plan))
    cols = ranked.columns
    li, ri = cols.index("length"), cols.index("rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, plan = shared.value
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (li, ri))
            row = plan[np.searchsorted(keys, length * wide + rank, side="right") - 1]
            j = rank - row[:, 1]
            sequence, offset = row[:, 4] + j // row[:, 3], row[:, 5] + j % row[:, 3] * length
            rest = [k for k in range(len(cols)) if k != ri]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in rest), pa.array(sequence), pa.array(offset)], [*(cols[k] for k in rest), "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return map_rows(ranked, run, schema + ", sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    return place(cut(pieces(docs, path, size, ids)), size)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
