"""N-gram Jaccard join by chosen paths.

A document is its set of word n-grams. Each run samples n-grams by a hash that all
documents share: a set of size n takes those below 1/(threshold * n), so it takes
1/threshold of them on average, and similar sets take common ones. Sets that chose
the same n-gram share a bucket; large buckets are split again on further sampled
n-grams; small ones are compared in full. Runs are repeated until a pair at the
threshold is found with the target recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neardup
from .common import chunks, discard, lean, materialise, ship
from .components import connected_components
from .textkernel import Words, mix, shingles

_LOWEST = -(2**63)


def gram_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-grams; a shorter text is one gram of all its words."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(shingles(words, min(n, len(words))))


def runs_for(recall: float, threshold: float) -> int:
    """Runs that find a pair at the threshold with probability ``recall``.

    The shared n-grams are 2t/(1+t) of each set's and each is sampled at 1/(t*n).
    """
    meet = 1 - math.exp(-(2 * threshold / (1 + threshold)) / threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def choose(grams: np.ndarray, seeds: np.ndarray, threshold: float) -> list[tuple[int, np.ndarray]]:
    """For each seed, the keys of the sampled n-grams."""
    if not len(grams):
        return []
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(grams)))))
    out = []
    for s in seeds:
        h = mix(grams ^ s)
        out.append(mix(h[h <= limit] + s))
    return out


def _seeds(runs: int, level: int) -> np.ndarray:
    return mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))


def text_sets(texts: list[str], n: int) -> Iterator[np.ndarray]:
    for a, b in chunks([len(t) for t in texts], 500_000):
        w = Words(texts[a:b])
        for i in range(b - a):
            yield gram_set(w.hash[w.first[i] : w.first[i + 1]], n)


def sampled_keys(docs: DataFrame, n: int, threshold: float, runs: int) -> DataFrame:
    """From (uid, text) rows, one row per text: uid, keys of the first level, n, bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(runs, 0)
        for b in batches:
            pick = dict(zip(b.column(0).to_pylist(), range(b.num_rows), strict=True))
            uids, texts = list(pick), b.column(1).take(pa.array(list(pick.values()), pa.int64())).to_pylist()
            keys, ends, sizes, bits = [], [0], [], []
            for grams in text_sets(texts, n):
                mine = choose(grams, seeds, threshold)
                keys += mine
                ends.append(ends[-1] + sum(map(len, mine)))
                sizes.append(len(grams))
                bits.append(neardup.bitmap(grams))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), listed, pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())], ["uid", "keys", "n", "bits"])

    return docs.mapInArrow(lean(run), "uid long, keys array<bigint>, n long, bits binary")


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(uid, set) of the wanted uids, from (doc, uid, text) rows and (uid, doc) rows."""
    places = neardup.bounded(wanted.select("uid", "doc"))
    found = docs.join(places, ["doc", "uid"], "left_semi").select("uid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from neardup.set_batches(zip(b.column(0).to_pylist(), (s.tobytes() for s in text_sets(b.column(1).to_pylist(), n)), strict=True))

    return found.mapInArrow(lean(run), "uid long, set binary").dropDuplicates(["uid"])


def split_buckets(buckets: DataFrame, sets: DataFrame, small: int, threshold: float, runs: int, depth: int, expand=neardup.as_sets) -> DataFrame:
    """Split buckets with more than ``small`` members on further sampled n-grams.

    A bucket that is mostly near its first member stays whole (see ``neardup.dense``).
    """
    done, now = None, buckets
    for level in range(1, depth + 1):
        sized = materialise(now.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > small), "counts")
        if sized.isEmpty():
            return now if done is None else done.unionByName(now)
        big = materialise(now.join(sized, "key", "left_semi"), "big")
        apart = sized.join(neardup.dense(big, sets, threshold, expand), "key", "left_anti").select("key")
        apart = materialise(apart, "apart")
        fine = now.join(apart, "key", "left_anti")
        done = fine if done is None else done.unionByName(fine)
        if apart.isEmpty():
            return done
        seeds = _seeds(runs, level)

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys, owners = [], []
                for i, j in chunks(pc.binary_length(b.column(2)).to_pylist(), neardup.CHUNK_BYTES):
                    values, count = expand(b.column(2)[i:j].to_pylist())
                    sets = np.split(values, np.cumsum(count)[:-1])
                    for key, uid, values in zip(b.column(0)[i:j].to_pylist(), b.column(1)[i:j].to_pylist(), sets, strict=True):
                        own = mix(seeds ^ np.uint64(key & (2**64 - 1)))
                        for k in choose(np.unique(values), own, threshold):
                            keys.append(k)
                            owners += [uid] * len(k)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(owners, pa.int64())], ["key", "uid"])

        parents = sets.join(neardup.bounded(now.join(apart, "key", "left_semi")), "uid").select("key", "uid", "set")
        now = neardup.live_buckets(materialise(parents.mapInArrow(lean(run), "key long, uid long"), "split"))
    return done.unionByName(now)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(_LOWEST)).alias("doc"), F.xxhash64("text").alias("uid"), "text")


def _classes(rows: DataFrame, n: int, threshold: float, recall: float, small: int, depth: int, count: bool) -> DataFrame:
    """(uid, class_doc, class_uid, n_links) of every distinct text."""
    # A pair meets at the first level and at every split, so each gets its share of the misses.
    runs = runs_for(recall ** (1 / (depth + 1)), threshold)
    texts = materialise(rows.groupBy("uid").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies")), "texts")
    sampled = materialise(sampled_keys(rows.select("uid", "text"), n, threshold, runs), "sampled")
    met = neardup.live_buckets(sampled.select(F.explode("keys").alias("key"), "uid"))
    buckets = neardup.live_buckets(neardup.prune(met, sampled.select("uid", "n", "bits"), threshold))
    wanted = materialise(buckets.select("uid").distinct().join(texts, "uid").select("uid", "doc"), "wanted")
    sets = materialise(sets_of(rows.select("doc", "uid", "text"), wanted, n), "sets")
    buckets = split_buckets(buckets, sets, small, threshold, runs, depth)
    linked = materialise(connected_components(neardup.links(buckets, sets, threshold)), "classes")
    members = linked.select(F.col("node").alias("uid"), "component").join(texts, "uid")
    named = members.groupBy("component").agg(F.min(F.struct("doc", "uid")).alias("first"))
    of = members.join(named, "component").select("uid", "first")
    full = texts.join(of, "uid", "left").withColumn("first", F.coalesce("first", F.struct("doc", "uid")))
    if count:
        near = neardup.count_links(members.select("uid", "component", "copies"), sets, threshold)
        full = full.join(near, "uid", "left").withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
    else:
        full = full.withColumn("n_links", F.lit(None).cast("long"))
    out = materialise(full.select("uid", F.col("first.doc").alias("class_doc"), F.col("first.uid").alias("class_uid"), "n_links"), "full")
    discard(texts, sampled, wanted, sets, linked)
    return out


def jaccard_classes(docs: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.99, small: int = 4000, depth: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its class and its number of links.

    Two rows are linked if their sets of word n-grams have a Jaccard similarity of
    at least ``threshold``; classes are the connected components. Exact copies are
    one text until the end. Buckets that stay large after ``depth`` splits are
    compared all the same, in parts. A row's links are counted by comparing it with
    all texts of its class.

    Texts without words (null, empty) are linked to nothing but exact copies of the
    same text; null texts count as empty. Null ids pass through; repeated rows are
    copies; an empty table gives no rows; other columns are ignored. Returns doc_id,
    class_id (the least doc_id of the class; null only if that id is null), n_links.
    """
    rows = _rows(docs, id_col, text_col)
    full = _classes(rows, n, threshold, recall, small, depth, True)
    out = rows.select("doc_id", "uid").join(full, "uid")
    return out.select("doc_id", F.when(F.col("class_doc") != _LOWEST, F.col("class_doc")).alias("class_id"), "n_links")


def keep_one(docs: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.99, small: int = 4000, depth: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that with the least id, with all its columns.

    Null ids count as the least. Different texts under one id are different
    documents; of repeated rows (same id and text) one stays.
    """
    rows = _rows(docs, id_col, text_col)
    full = _classes(rows, n, threshold, recall, small, depth, False)
    placed = materialise(rows.groupBy("doc", "uid").agg(F.count(F.lit(1)).alias("m")).join(full, "uid"), "placed")
    out = placed.where("doc <> class_doc or uid <> class_uid").select("doc", "uid")
    again = placed.where("m > 1 and doc = class_doc and uid = class_uid").select("doc", "uid")
    keyed = docs.withColumns({"_sift_doc": F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)), "_sift_uid": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    on = lambda d: (keyed["_sift_doc"] == d["doc"]) & (keyed["_sift_uid"] == d["uid"])
    drop = out if again.isEmpty() else out.union(again)
    drop = neardup.bounded(drop)
    kept = keyed.join(drop, on(drop), "left_anti")
    if not again.isEmpty():
        again = neardup.bounded(again)
        kept = kept.unionByName(keyed.join(again, on(again), "left_semi").dropDuplicates(["_sift_doc", "_sift_uid"]))
    return kept.drop("_sift_doc", "_sift_uid")
