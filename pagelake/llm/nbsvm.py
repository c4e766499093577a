"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of its token n-grams (1 to ``NGRAM`` tokens) and of the n-grams of its token shapes
(lower, capitalised and upper-case words, digits, each punctuation run, repeats), hashed into ``SIZE``
places.  Each indicator is scaled by its class log-count ratio; a linear hinge-loss model is
fitted to the scaled rows by dual coordinate descent; a logistic curve over margins of rows that the fit
did not see turns margins into scores.

Fit on a bounded sample: about ``ROWS`` labelled rows, whole texts, by a hash of the id; equal rows enter once with their number, and
an id that repeats with many texts adds about ``ROWS`` more at most.  The model is two arrays of ``SIZE`` numbers.  Scoring is one pass over all rows without a shuffle.

Defined cases: a null text is empty; an empty text has no feature and is scored by the model's constant; a label
other than 0 or 1 is not learnt from; with labels of one class the score is flat; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, slices
from .labelled import calibrate, chance, held_out, sampled_texts, training_labels

ROWS, SIZE = 12_000, 1 << 20
SMOOTH, C, EPOCHS, NGRAM = 1.0, 1.0, 12, 3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")


def _shape(token: str, last: str) -> str:
    if token == last:
        return "="
    if token[0].isalpha():
        return "a" if token.islower() else "A" if token.isupper() and len(token) > 1 else "Aa"
    return "9" if token[0].isdigit() else token[:4]


def features(text: str | None) -> np.ndarray:
    """Sorted places of the indicators."""
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.zeros(0, np.int32)
    words = [t.lower() for t in tokens]
    terms = set(words)
    shapes = [_shape(t, p) for t, p in zip(tokens, ["", *tokens])]
    for n in range(2, NGRAM + 1):
        terms.update(map(" ".join, zip(*(words[k:] for k in range(n)))))
    for n in range(1, NGRAM + 1):
        terms.update(map("\x00".join, zip(*(shapes[k:] for k in range(n)))) if n > 1 else ("\x01" + s for s in set(shapes)))
    places = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) % SIZE for t in terms), np.int64, len(terms))
    return np.unique(places).astype(np.int32)


def _row(places: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    v = ratio[places]
    return v / max(float(np.sqrt(v @ v)), 1e-9)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, c: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> np.ndarray:
    """Weights (the last is the constant) of the L2-regularised hinge loss; y is +1 or -1, c the cost of each row."""
    w, alpha, rng = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for k in rng.permutation(len(rows)):
            at, v = rows[k]
            g = y[k] * (w[at] @ v + w[-1]) - 1
            step = min(max(alpha[k] - g / (v @ v + 1), 0.0), c[k]) - alpha[k]
            if step:
                alpha[k] += step
                w[at] += step * y[k] * v
                w[-1] += step * y[k]
                worst = max(worst, abs(step))
        if worst < 1e-4:
            break
    return w


class Model:
    def __init__(self, ratio: np.ndarray, weight: np.ndarray, curve: np.ndarray):
        self.ratio, self.weight, self.curve = ratio.astype(np.float32), weight.astype(np.float32), curve

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([float(self.weight[p] @ _row(p, self.ratio)) + float(self.weight[-1]) for p in rows]).reshape(-1, 1)

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return chance(self.margins(rows), self.curve)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> Model:
    """Model of about ``rows`` labelled rows; a fifth of them only sets the curve."""
    train = training_labels(labels, label)
    total = train.count()
    chosen = train.where(F.col("u") < rows / max(total, 1)).select("doc_id", "y", (F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(5)) == 0).alias("curve"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            found = pa.array([features(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), found], [*kept, "places"])

    kept = ["doc_id", "y", "curve", "text_hash", "n"]
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, y int, curve boolean, text_hash long, n long, places array<int>"
    got = map_rows(sampled_texts(docs, chosen, rows), run, schema).toArrow().to_pandas()  # bounded by ``rows``
    got = got.sort_values(["doc_id", "text_hash", "y"], kind="stable")
    places, y, curve, n = list(got["places"]), got["y"].to_numpy(int), got["curve"].to_numpy(bool), got["n"].to_numpy(float)
    counts = np.zeros((2, SIZE))
    for p, k, m in zip(places, y, n):
        counts[k, p] += m
    counts += SMOOTH
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    learn = np.flatnonzero(~curve) if (~curve).any() else np.arange(len(y))
    share = np.bincount(y[learn], n[learn], minlength=2) / max(n[learn].sum(), 1)
    cost = C * 0.5 * n[learn] / np.maximum(share[y[learn]], 1e-6) if len(learn) else np.zeros(0)
    weight = dual_descent([(places[k], _row(places[k], ratio)) for k in learn], 2 * y[learn] - 1, SIZE, cost)
    model = Model(ratio, weight, np.zeros(2))
    test = np.flatnonzero(curve) if curve.any() else np.arange(len(y))
    model.curve = calibrate(model.margins([places[k] for k in test]), y[test].astype(float), n[test])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, 512):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.scores([features(t) for t in b.column(1).to_pylist()]), pa.float64())], ["doc_id", "score"])

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
