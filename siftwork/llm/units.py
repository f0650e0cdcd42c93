"""Units of texts (lines, stretches of words) and the near-duplicate classes among them.

A unit's uid is a 64-bit hash of its bytes, so exact copies share it. Signatures
and sets are made from all of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neardup
from .common import chunks, discard, lean, materialise
from .components import connected_components
from .neardup import ranges
from .textkernel import Words, band_keys, inner_bytes, min_hashes, mix

_CHUNK = 200_000  # characters whose arrays fit a core's cache
SCHEMA = "uid long, doc long, th long, no int, start long, end long, words int, keys array<bigint>"


_LOWEST = -(2**63)


@dataclass
class Units:
    """Units of a chunk, in order: text index, number in the text, byte span, uid, words."""

    kernel: Words
    doc: np.ndarray
    no: np.ndarray
    start: np.ndarray
    end: np.ndarray
    words: np.ndarray
    uid: np.ndarray | None = None

    def __post_init__(self):
        if self.uid is None:
            self.uid = self.kernel.span_hash(self.start, self.end).view(np.int64)

    def take(self, rows: np.ndarray) -> Units:
        return Units(self.kernel, *(x[rows] for x in (self.doc, self.no, self.start, self.end, self.words, self.uid)))


_BASE = np.uint64(0xD6E8FEB86659FD93)


def rolling(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` code points from each one on (a power of two); zeros follow the last."""
    h, base = np.zeros(len(points) + k, np.uint64), _BASE
    h[: len(points)] = points
    width = 1
    while width < k:
        far = h[width:] * base
        far += h[:-width]
        h = far
        base, width = np.uint64(int(base) * int(base) & (2**64 - 1)), 2 * width
    return h[: len(points)]


class Lines:
    """Lines that have a word; shingles of ``k`` characters of the lower-cased line.

    A line of fewer characters is one shingle. Between tasks a line travels as its
    bytes, an eighth of its set.
    """

    k, part_bytes = 8, neardup.PART_BYTES // 8

    def blobs(self, u: Units) -> list[bytes]:
        raw = u.kernel.bytes.tobytes()
        return [raw[a:b] for a, b in zip(u.start.tolist(), u.end.tolist(), strict=True)]

    def expand(self, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
        end = np.cumsum([len(x) + 1 for x in blobs]) - 1
        values, cut = self.sets(raw, np.concatenate(([0], end[:-1] + 1)), end)
        return values, np.diff(cut)

    def units(self, texts: list[str]) -> Units:
        w = Words(texts)
        ends = np.flatnonzero(w.bytes == 10)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        doc = np.searchsorted(w.bounds, starts, "right") - 1
        no = np.arange(len(starts)) - np.searchsorted(starts, w.bounds[:-1])[doc]
        words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
        return Units(w, doc, no, starts, ends, words).take(words > 0)

    def shingles(self, u: Units) -> tuple[np.ndarray, np.ndarray]:
        return self.sets(u.kernel.bytes, u.start, u.end)

    def sets(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of the byte spans, end to end, and where each span's begin."""
        points, inner = raw, inner_bytes(raw)
        if len(inner):  # bytes to code points
            start, end = start - np.searchsorted(inner, start), end - np.searchsorted(inner, end)
            points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
        size = end - start
        at, cut = ranges(start, np.maximum(size - self.k + 1, 1))
        values = rolling(points, self.k)[at]
        short = np.flatnonzero(size < self.k)
        if len(short):
            one = np.zeros(len(short), np.uint64)
            for j in range(self.k - 1):
                inside = size[short] > j
                one[inside] = one[inside] * _BASE + points[start[short[inside]] + j] + np.uint64(1)
            values[cut[short]] = mix(one + size[short].astype(np.uint64))
        return values, cut


class Stretches:
    """Paragraph-sized stretches of words, cut by content; shingles of ``n`` words.

    A word ends a stretch if its hash is less than those of the ``reach`` words before
    it and not greater than those of the ``reach`` words after it, so a passage is cut
    alike wherever it stands, but for some words at its ends, and whatever its
    punctuation. Stretches have ``reach`` + 1 words or more, 2 * ``reach`` + 1 on
    average; after ``long`` words without an end (a word repeated) one is cut.
    """

    least, n, reach, long, part_bytes = 5, 5, 4, 24, neardup.PART_BYTES
    expand = staticmethod(neardup.as_sets)

    def blobs(self, u: Units) -> list[bytes]:
        values, cut = self.shingles(u)
        return [np.unique(values[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def units(self, texts: list[str]) -> Units:
        w = Words(texts, lower=False, ascii_lower=True)
        n = len(w.starts)
        if not n:
            none = np.zeros(0, np.int64)
            return Units(w, none, none, none, none, none)
        order, far = (w.hash >> np.uint64(32)).astype(np.int64), np.int64(2**32)
        cut = np.ones(n, bool)
        for j in range(1, min(self.reach, n - 1) + 1):
            same = w.doc[j:] == w.doc[:-j]
            cut[j:] &= order[j:] < np.where(same, order[:-j], far)
            cut[:-j] &= order[:-j] <= np.where(same, order[j:], far)
        # Each text's last word ends a stretch; others end only with ``reach`` words after them.
        last = w.first[1:][np.diff(w.first) > 0] - 1
        place = np.arange(n) - w.first[w.doc]
        cut &= (place >= self.reach) & (w.first[w.doc + 1] - w.first[w.doc] - place > self.reach)
        cut[last] = True
        first = np.concatenate(([0], np.flatnonzero(cut)[:-1] + 1))
        size = np.diff(np.append(first, n))
        pieces = -(-size // self.long)
        inner, at = ranges(np.zeros(len(first), np.int64), pieces)
        first = np.repeat(first, pieces) + inner * self.long
        end = np.append(first[1:], n) - 1
        doc = w.doc[first]
        no = np.arange(len(first)) - np.searchsorted(first, w.first[:-1])[doc]
        return Units(w, doc, no, w.starts[first], w.ends[end], end - first + 1)

    def shingles(self, u: Units) -> tuple[np.ndarray, np.ndarray]:
        w = u.kernel
        first = np.searchsorted(w.starts, u.start)
        at, cut = ranges(first, np.maximum(u.words - self.n + 1, 1))
        end = np.repeat(first + u.words, np.diff(cut))
        values = np.zeros(len(at), np.uint64)
        for j in range(self.n):
            inside = at + j < end
            values = values * np.uint64(0x100000001B3) + np.where(inside, w.hash[np.minimum(at + j, len(w.hash) - 1)], np.uint64(7))
        return mix(values), cut


def text_key(id_col: str, text_col: str) -> tuple:
    """Columns doc, th and text: id and a hash of the text tell documents apart.

    Null ids come first and null texts are empty. Different texts under one id, the
    null id too, are different documents; rows equal in both are one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)), F.xxhash64(text), text


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text), see ``text_key``."""
    return docs.select(*(c.alias(n) for c, n in zip(text_key(id_col, text_col), ("doc", "th", "text"), strict=True)))


def unit_rows(docs: DataFrame, kind, bands: int, rows: int) -> DataFrame:
    """Every unit of (doc, th, text) rows, with band keys on one of equal units per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for a, b in chunks([len(t) for t in texts], _CHUNK):
                u = kind.units(texts[a:b])
                if not len(u.doc):
                    continue
                letters = u.kernel.letters
                origin = letters(u.kernel.bounds[u.doc])
                keyed = np.zeros(len(u.doc), bool)
                keyed[np.unique(u.uid, return_index=True)[1]] = True
                keyed &= u.words >= getattr(kind, "least", 1)
                some = u.take(keyed)
                values, cut = kind.shingles(some)
                keys = band_keys(min_hashes(values, cut, bands * rows), rows)
                ends = np.concatenate(([0], np.cumsum(keyed * bands))).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(u.uid), pa.array(ids[a:b][u.doc]), pa.array(hashes[a:b][u.doc]), pa.array(u.no.astype(np.int32)), pa.array(letters(u.start) - origin), pa.array(letters(u.end) - origin), pa.array(u.words.astype(np.int32)), listed], ["uid", "doc", "th", "no", "start", "end", "words", "keys"])

    return docs.mapInArrow(lean(run), SCHEMA)


def unit_sets(docs: DataFrame, wanted: DataFrame, kind) -> DataFrame:
    """(uid, set) of the wanted (uid, doc, th) units, from (doc, th, text) rows."""
    lists = materialise(wanted.groupBy("doc", "th").agg(F.collect_list("uid").alias("uids")), "lists")
    found = docs.join(neardup.bounded(lists, 8 * F.size("uids")), ["doc", "th"]).select("text", "uids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch):
            texts, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks([len(t) for t in texts], _CHUNK):
                u = kind.units(texts[a:b])
                want = np.unique(np.array([x for xs in lists[a:b] for x in xs], np.int64))
                keep = np.zeros(len(u.doc), bool)
                keep[np.unique(u.uid, return_index=True)[1]] = True
                u = u.take(keep & np.isin(u.uid, want))
                yield from zip(u.uid.tolist(), kind.blobs(u), strict=True)

        for batch in batches:
            yield from neardup.set_batches(rows(batch))

    # A unit that stands in two texts of one batch of documents may come twice; the
    # tasks that compare sets pass over repeats.
    return found.mapInArrow(lean(run), "uid long, set binary")


def unit_classes(docs: DataFrame, units: DataFrame, kind, *, threshold: float, small: int = 4000, depth: int = 2) -> DataFrame:
    """(node, component) among the units that are near another, different one.

    ``small`` and ``depth`` decide how large buckets are taken apart, not what is found.
    """
    keys = units.where("size(keys) > 0").select(F.explode("keys").alias("key"), "uid")
    buckets = neardup.live_buckets(keys)
    near = materialise(buckets.select("uid").distinct(), "near")
    # Any text that has a unit will do; both columns are of the same row.
    wanted = materialise(units.select("uid", "doc", "th").join(neardup.bounded(near), "uid", "left_semi").groupBy("uid").agg(F.first("doc").alias("doc"), F.first("th").alias("th")), "wanted")
    sets = materialise(unit_sets(docs, wanted, kind), "sets")
    buckets = neardup.split_exactly(buckets, sets, small, threshold, depth, kind.expand)
    out = materialise(connected_components(neardup.links(buckets, sets, threshold, kind.part_bytes, kind.expand)), "classes")
    discard(near, wanted, sets)
    return out
