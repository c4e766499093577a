"""Language identification: known words first, shorter and shorter character n-grams for the rest.

A word the training texts know scores by its log frequency in each language.
An unseen word scores by its known character n-grams of the longest order that has any,
from 4 down to 1 (word edges count as characters). A text's score is the mean over its words.

The model is fitted on a bounded sample: about ``ROWS`` training rows per language,
chosen by a hash of id and text, whole texts. That bounds its tables, which keep every word and
n-gram of the sample. Prediction is one pass over all rows without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; a null id counts as the empty text for the
split; without any training row everything is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_crc, map_rows, slices, uniform

ROWS, ORDER = 2_000, 4
MEMO = 50_000  # unseen words a worker remembers
WORD_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and letter-like signs that hold a letter."""
    return [w for w in WORD_RUN.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []


def grams(word: str, n: int) -> list[str]:
    w = f" {word} " if n > 1 else word
    return [w[k : k + n] for k in range(len(w) - n + 1)]


class Table(dict):
    """Log frequencies by language: value -> row of ``logs``."""

    def __init__(self, values: list[str], logs: np.ndarray):
        super().__init__(zip(values, range(len(values))))
        self.logs = logs

    def __reduce__(self):
        return Table, (list(self), self.logs)


def _table(df: DataFrame, name: str, langs: list[str]) -> Table:
    """Log frequencies by language of all values of the sample."""
    got = df.groupBy(name, "lang").agg(F.sum("n").alias("n")).toArrow().combine_chunks()  # bounded by the sample
    if not got.num_rows:
        return Table([], np.zeros((0, len(langs)), np.float32))
    value, lang = (got.column(c).chunk(0).dictionary_encode() for c in (name, "lang"))
    counts = np.full((len(value.dictionary), len(langs)), 0.1)
    column = np.array([langs.index(x) for x in lang.dictionary.to_pylist()])
    counts[value.indices.to_numpy(), column[lang.indices.to_numpy()]] += got.column("n").to_numpy()
    return Table(value.dictionary.to_pylist(), np.log(counts / np.maximum(counts.sum(0), 0.1)).astype(np.float32))


class Model:
    """Log frequencies by language for words and for n-grams of each order."""

    def __init__(self, langs: list[str], words: Table, orders: list[Table]):
        self.langs, self.words, self.orders, self.memo = langs, words, orders, {}

    def __getstate__(self):
        return {"langs": self.langs, "words": self.words, "orders": self.orders, "memo": {}}

    def vector(self, word: str) -> np.ndarray:
        at = self.words.get(word)
        if at is not None:
            return self.words.logs[at]
        v = self.memo.get(word)
        if v is None:
            v = np.zeros(len(self.langs), np.float32)
            for n, table in zip(range(len(self.orders), 0, -1), reversed(self.orders)):
                known = [table[g] for g in grams(word, n) if g in table]
                if known:
                    v = table.logs[known].mean(axis=0, dtype=np.float64).astype(np.float32)
                    break
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = v
        return v

    def predict(self, text: str | None) -> tuple[str, float]:
        count = Counter(words_of(text))
        if not count or not self.langs:
            return "und", 0.0
        n = np.fromiter(count.values(), float, len(count))
        mean = n @ np.array([self.vector(w) for w in count], float) / n.sum()
        e = np.exp((mean - mean.max()) * min(n.sum(), 10.0))  # the likelihood of ten words at most: a score that long texts don't push to 1
        best = int(mean.argmax())
        return self.langs[best], float(e[best] / e.sum())


def fit(docs: DataFrame, rows: int = ROWS) -> Model:
    """Model of the rows with a non-null text and lang; about ``rows`` of each language."""
    known = docs.where("lang is not null and text is not null")
    per = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(per)
    if not langs:
        return Model([], Table([], np.zeros((0, 0))), [])
    part = F.create_map(*[F.lit(x) for k in langs for x in (k, rows / per[k])])[F.col("lang")]
    sample = known.where(uniform(F.lit("language"), F.col("doc_id"), F.col("text")) < part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            count = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                count.update((lang, w) for w in words_of(text))
            keys = list(count)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(count.values()), pa.int64())], ["lang", "word", "n"])

    seen = cut(map_rows(sample.select("lang", "text"), run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    orders = []
    for n in range(1, ORDER + 1):
        edged = seen.withColumn("word", F.concat(F.lit(" "), "word", F.lit(" "))) if n > 1 else seen
        at = edged.where(F.length("word") >= n).select("lang", "word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - (n - 1))).alias("k"))
        table = at.groupBy("lang", F.substring("word", F.col("k"), F.lit(n)).alias("gram")).agg(F.sum("n").alias("n"))
        orders.append(_table(table, "gram", langs))
    return Model(langs, _table(seen, "word", langs), orders)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, 512):
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def query(docs: DataFrame) -> DataFrame:
    held = id_crc(F.col("doc_id"), 4) == 2
    return identify(docs, fit(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")
