"""Secret scans with multipart credential linking.

Base kinds (assignments, access keys, long hex runs) stand by themselves.
Other finds are weak: an access identifier, a secret value or an endpoint
alone is ordinary text.  Within each scope (a block of lines between blank
lines) the three kinds of weak parts are joined by intervals: a secret is
completed by an identifier or an endpoint anywhere in its scope, and
both are reported; an identifier and an endpoint alone are not.  A secret
inside an endpoint is part of that address: only an identifier completes it,
and another endpoint is reported when it is in the scope of the two.
The interval join works on sorted positions with
binary search (the part before and after in the scope), so a text with very many
parts costs n log n and makes no pairs.

Each row is scanned by itself: nothing is shuffled, and a lost task is
simply run again.  Defined cases: a null text counts as empty; texts without
finds have an empty span list; spans are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")

# weak parts: alone they prove nothing
WEAK_ID = re.compile(r"""(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}|AKIA[A-Z0-9]{8,13}(?![A-Z0-9])""", re.I | re.A)
WEAK_SECRET = re.compile(r"""(?:pwd|pass(?:phrase|word|wd)?|secret|token|api_?key|client_?secret|private_?key|auth)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|(?-i:(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{24,}={0,2})""", re.I | re.A)
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|(?:host|server|endpoint|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{3,}""", re.I | re.A)
BLANK = re.compile(r"\n[ \t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _near(a: np.ndarray, b: np.ndarray, reach: int | None = None) -> np.ndarray:
    """For each interval of ``a`` (scope, start, end): is one of ``b`` in its scope, not overlapping it and, with a ``reach``, at most so far off?

    Intervals of one kind don't overlap each other, so starts and ends are sorted alike, and the last
    that ends before and the first that starts after decide.
    """
    if not len(b):
        return np.zeros(len(a), bool)
    prev = np.searchsorted(b[:, 2], a[:, 1], side="right") - 1
    nxt = np.searchsorted(b[:, 1], a[:, 2], side="left")
    before, after = b[np.maximum(prev, 0)], b[np.minimum(nxt, len(b) - 1)]
    left = (prev >= 0) & (before[:, 0] == a[:, 0])
    right = (nxt < len(b)) & (after[:, 0] == a[:, 0])
    if reach is not None:
        left &= a[:, 1] - before[:, 2] <= reach
        right &= after[:, 1] - a[:, 2] <= reach
    return left | right


def linked_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts that complete each other; strong base finds serve as partners but are not reported again."""
    ids, ends = list(WEAK_ID.finditer(text)), list(ENDPOINT.finditer(text))
    if not ids and not ends and not any(k == 1 for _, k, _ in base):
        return []  # without an identifier or an endpoint nothing can be linked
    secrets = list(WEAK_SECRET.finditer(text))
    cuts = np.array([m.start() for m in BLANK.finditer(text)], np.int64)

    def table(found, strong):
        spans = sorted({(m.start(), m.end()) for m in found} | {(s, e) for s, k, e in base if k in strong})
        keep, last = [], -1  # one kind's parts don't overlap: the first of an overlap stays
        for s, e in spans:
            if s >= last:
                keep.append((s, e))
                last = e
        x = np.array(keep, np.int64).reshape(-1, 2)
        return np.column_stack([np.searchsorted(cuts, x[:, 0]), x]) if len(x) else np.zeros((0, 3), np.int64)

    i, s, p = table(ids, (1,)), table(secrets, (0, 2)), table(ends, ())
    # endpoints don't overlap each other: a secret is apart from all where as many start before its end as end by its start
    free = s[np.searchsorted(p[:, 1], s[:, 2], side="left") == np.searchsorted(p[:, 2], s[:, 1], side="right")]
    by_end = free[_near(free, p)]
    i, s = i[_near(i, s)], s[_near(s, i)]
    p = p[_near(p, free) | _near(p, i) & _near(p, s)]
    s = np.unique(np.concatenate([s, by_end]), axis=0)
    known = {(a, b) for a, _, b in base}
    return [(int(a), k, int(b)) for k, x in ((3, i), (4, s), (5, p)) for _, a, b in x if (int(a), int(b)) not in known]


def all_spans(text: str | None) -> tuple[list, list]:
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + (linked_spans(text, base)))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str | None, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str | None:
    """The text with every span, overlaps merged, replaced by ``mark``."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end; by start, then kind as listed) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches, 256):
            found = [all_spans(t)[1] for t in b.column(1).to_pylist()]
            spans = pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found], kind)
            yield pa.RecordBatch.from_arrays([b.column(0), spans], ["doc_id", "spans"])

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all finds replaced in the text; n_chars, where there is such a column, follows. All rows stay."""
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            texts = pa.array([redacted(t, all_spans(t)[1]) for t in b.column(text_at).to_pylist()], b.column(text_at).type)
            cols = [texts if k == text_at else b.column(k) for k in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    out = map_rows(docs, run, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    s = scan(docs)
    one = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:3]))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return s.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                    F.sha2(F.concat_ws(",", F.transform(base, one)), 256).alias("base_sha256"),
                    F.concat_ws(",", F.transform("spans", one)).alias("spans"))
