"""Labelled training texts and logistic calibration, for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, id_crc, uniform


def held_out(doc_id: Column) -> Column:
    return id_crc(doc_id, 5) == 0


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, y (0 or 1), u (a number in [0, 1) fixed by the id) of the rows that may be learnt from."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    return rows.select("doc_id", F.col(label).cast("int").alias("y"), uniform(F.lit(label), F.col("doc_id")).alias("u"))


def labelled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (doc_id, y, ...) with the texts. The ids are broadcast if they measure small, else both sides are shuffled."""
    return docs.select("doc_id", "text").join(broadcast_if_small(cut(chosen)), "doc_id")


def sampled_texts(docs: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """``chosen`` (doc_id, y, ...) with the texts and n, how often this row occurs; equal rows once.

    ``chosen`` holds about ``rows`` ids. Where an id repeats with many different texts, these are sampled by their hash: about twice
    ``rows`` rows come back at most, however often an id occurs in either table.
    """
    names = chosen.columns
    ids = cut(chosen.groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    texts = docs.select("doc_id", "text").join(broadcast_if_small(ids), "doc_id").withColumn("text_hash", F.xxhash64("text"))
    met = cut(texts.groupBy(*names, "text_hash").agg(F.sum("n").alias("n")))
    few = met.where(uniform(F.lit("text"), F.col("doc_id"), F.col("text_hash")) < 2 * rows / max(met.count(), 1))
    of = [*names, "text_hash"]
    once = texts.drop("n").join(broadcast_if_small(few), of).dropDuplicates(of)
    return once.select(*names, "text", "text_hash", "n")


def calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, steps: int = 25, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression of y on the columns of x and a constant, by Newton steps; row k counts n[k] times. Flat where y has one class only."""
    a = np.column_stack([x, np.ones(len(x))]) if len(x) else np.zeros((0, x.shape[1] + 1))
    w = np.zeros(a.shape[1])
    n = np.ones(len(a)) if n is None else n
    if not len(a):
        return w
    if len(set(y.tolist())) < 2:
        w[-1] = 4.0 if y[0] else -4.0
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (n * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, a.T @ (n * (y - p)) - ridge * w)
    return w


def chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
