"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text alone. Trees are complete to a fixed depth and
flattened into arrays, so numpy walks all rows down a tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, ship
from .textkernel import Words

#: Frequent function words of the languages at hand.
COMMON = "the of and to in is that it for was as with by on are this be at from or an he a de la le les et un une des du que en est dans pour par sur au il ne qui el los las por con una del se su al lo no der die das und ist von zu den mit auf ein eine im nicht für sich".split()  # noqa: SIM905
_MARKS = b"!%$*#&|.,;:?-_=<>{}[]()\"'/\\@"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(range(48, 58))] = 1
_CLASS[list(range(65, 91))] = 2
_CLASS[list(range(97, 123))] = 3
_CLASS[128:] = 4
_CLASS[32], _CLASS[10], _CLASS[[9, 13]] = 5, 6, 7
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 8 + _i
_CLASSES = 8 + len(_MARKS)
N_FEATURES = 17 + len(_MARKS)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of statistics per text; empty texts give defined values (mostly 0)."""
    out = [_chunk(texts[a:b]) for a, b in chunks([len(t) for t in texts], 500_000)]
    return np.concatenate(out) if out else np.zeros((0, N_FEATURES), np.float32)


def _chunk(texts: list[str]) -> np.ndarray:
    n = len(texts)
    w = Words(texts, lower=False)
    doc = np.repeat(np.arange(n), w.sizes)
    cls = _CLASS[w.bytes]
    counts = np.bincount(doc * _CLASSES + cls, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    counts[:, 6] -= 1  # the newline that ends each text
    size = np.maximum(w.sizes - 1, 1)
    n_words = np.diff(w.first)
    words = np.maximum(n_words, 1)
    length = (w.ends - w.starts).astype(float)
    per = lambda x: np.bincount(w.doc, x, minlength=n)
    mean = per(length) / words
    spread = np.sqrt(np.maximum(per(length**2) / words - mean**2, 0))
    low = Words(texts)
    hashes = low.hash
    same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (low.doc[1:] == low.doc[:-1])
    n_low = np.maximum(np.diff(low.first), 1)
    perlow = lambda x: np.bincount(low.doc, x, minlength=n)
    common = np.isin(hashes, Words([" ".join(COMMON)]).hash)

    def distinct(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, docs))
        k, d = keys[order], docs[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        return np.bincount(d[new], minlength=n)

    pairs = hashes[1:] * np.uint64(31) + hashes[:-1] if len(hashes) > 1 else np.zeros(0, np.uint64)
    inside = low.doc[1:] == low.doc[:-1] if len(hashes) > 1 else np.zeros(0, bool)
    n_pairs = np.maximum(n_low - 1, 1)
    ends = np.flatnonzero(w.bytes == 10)
    begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    line_doc, line_len = doc[ends], (ends - begins).astype(float)
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    upper_start = _CLASS[w.bytes[w.starts]] == 2
    upper_end = _CLASS[w.bytes[w.ends - 1]] == 2
    twice = np.zeros(len(w.bytes), bool)
    twice[1:] = (w.bytes[1:] == w.bytes[:-1]) & (cls[1:] >= 8)
    cols = [
        np.log1p(size), np.log1p(n_words), mean, spread,
        counts[:, 1] / size, counts[:, 2] / size, (counts[:, 3] + counts[:, 4]) / size, counts[:, 5] / size,
        n_lines / size, np.bincount(line_doc, line_len, minlength=n) / n_lines, distinct(w.span_hash(begins, ends), line_doc) / n_lines,
        distinct(hashes, low.doc) / n_low, perlow(same) / n_low, distinct(pairs[inside], low.doc[1:][inside]) / n_pairs, perlow(common) / n_low,
        per(upper_start & upper_end & (length > 1)) / words, np.bincount(doc, twice, minlength=n) / size,
        *(counts[:, 8:] / words[:, None]).T,
    ]
    return np.stack(cols, 1).astype(np.float32)


@dataclass
class Forest:
    """Complete trees of one depth as arrays: (trees, 2**depth - 1) and (trees, 2**depth)."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, rows = np.full(len(x), self.prior), np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while inner and len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            raw += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Forest:
    """Boost on the logistic loss. One class or no rows gives the constant prior."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    prior = float(np.log(share / (1 - share)))
    empty = Forest(np.zeros((0, 2**depth - 1), int), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), prior)
    if not len(y) or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(k, c, "left") for k, c in zip(cuts, x.T, strict=True)])
    raw, out = np.full(len(y), prior), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(2**depth - 1, int), np.full(2**depth - 1, np.inf)
        at = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local, best = at - first, np.zeros(width)
            for j, (c, k) in enumerate(zip(code, cuts, strict=True)):
                if not len(k):
                    continue
                slots = local * bins + c
                left = [np.bincount(slots, v, minlength=width * bins).reshape(width, bins).cumsum(1)[:, : len(k)] for v in (g, h, None)]
                (gl, hl, nl), (gt, ht) = left, (np.bincount(local, v, minlength=width)[:, None] for v in (g, h))
                nt = np.bincount(local, minlength=width)[:, None]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(nl < least) | (nt - nl < least)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                won = value > best + 1e-9
                best[won] = value[won]
                feature[first : first + width][won] = j
                threshold[first : first + width][won] = k[top[won]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        slot = at - (2**depth - 1)
        leaf = rate * np.bincount(slot, g, minlength=2**depth) / (np.bincount(slot, h, minlength=2**depth) + ridge)
        raw += leaf[slot]
        out.append((feature, threshold, leaf))
    f, t, v = (np.stack(z) for z in zip(*out, strict=True))
    return Forest(f, t, v, prior)


def held_out(doc_id):
    """Column: whether crc32 of the id as text leaves remainder 0 by 5 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000, **how) -> Forest:
    """Fit on the labelled rows that are not held out.

    ``bound`` limits the rows: those whose id has the smallest hash are taken. The
    driver thus holds at most ``bound`` rows of statistics. Null or other labels
    and null ids are passed over; of several labels of one id the smallest counts.
    """
    ship(docs.sparkSession)
    mine = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
    mine = mine.where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_y").alias("_y"))
    sample = mine.orderBy(F.xxhash64("_id"), "_id").limit(bound)
    joined = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(sample), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "y", "x"])

    rows = joined.select("_id", "_t", "_y").mapInArrow(lean(run), "id long, y int, x binary").toArrow()
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    y = rows.column("y").to_numpy().astype(float)[order]
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)[order]
    return fit(x, y, **how)


def score_documents(docs: DataFrame, model: Forest, *, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text; one row per input row.

    Null texts are empty and get a score too; null ids pass through (held_out
    false); repeated rows are scored alike; an empty table gives no rows; other
    columns are ignored. Returns doc_id, held_out, score, predicted.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(statistics([t or "" for t in b.column(2).to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Forest, *, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows whose score reaches ``threshold``, with all their columns."""
    ship(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(statistics([t or "" for t in b.column(at).to_pylist()]))
            yield b.filter(pa.array(score >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)
