"""Best-fit packing of all pieces at once, planned on counts of lengths.

Each input partition tokenises its documents and numbers the pieces of each length.
Best-fit decreasing looks at lengths alone, so it is planned on how many pieces of
each length all partitions have: bins of equal content are one group with a count,
and the plan's size depends on the capacity and not on the documents. Each piece
then looks up its place by its length and its number among the pieces of that
length. Only piece metadata moves between tasks, never ids or texts, and no bin is
closed while a piece anywhere could still fill it.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import lean, materialise, ship, slices

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"
BLOCK = 50_000


def best_fit(items: list[tuple[int, list]], capacity: int) -> list[tuple[int, list]]:
    """Best-fit decreasing of (size, members); offsets of members shift into place.

    A bit set over the free space finds the tightest bin in constant time.
    """
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[tuple[int, list]] = []
    mask = 0
    for size, members in sorted(items, key=lambda x: -x[0]):
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            k = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
            fill, had = bins[k]
            had.extend((*m[:5], m[5] + fill) for m in members)
            bins[k] = (fill + size, had)
            free -= size
        else:
            k, free = len(bins), capacity - size
            bins.append((size, list(members)))
        if free:
            by_free[free].append(k)
            mask |= 1 << free
    return bins


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces of each length.

    Returns runs (length, first, sequence, each, offset) in ascending order: of the
    pieces of a length, number ``first`` and those after it, up to the next run, fill
    the sequences from ``sequence`` on, ``each`` pieces a sequence, from ``offset`` on.
    A piece that fits twice into the tightest bin goes there twice, as it then is the
    tightest still.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # free space: (first sequence, how many)
    frees: list[int] = []
    runs, made = [], 0

    def put(free: int, seq: int, m: int) -> None:
        if free and m:
            groups.setdefault(free, []).append((seq, m))

    for size in sorted(counts, reverse=True):
        left, at = counts[size], 0
        frees = [f for f in groups if f >= size]
        heapq.heapify(frees)
        while left:
            if frees:
                free = frees[0]
                seq, m = groups[free].pop()
                if not groups[free]:
                    del groups[free]
                    heapq.heappop(frees)
            else:
                free, seq, m = capacity, made, -(-left // (capacity // size))
                made += m
            each = free // size
            whole = min(m, left // each)
            rest = min(left - whole * each, each - 1) if whole < m else 0
            runs.append((size, at, seq, each, capacity - free))
            at += whole * each + rest
            left -= whole * each + rest
            used = whole + (rest > 0)
            put(free - each * size, seq, whole)
            put(free - rest * size, seq + whole, used - whole)
            put(free, seq + used, m - used)
    return sorted(runs)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", slack: int = 8, forward: int = 4096, rows_per_task: int = 20_000) -> DataFrame:
    """Pack every document's ids into sequences of at most ``capacity``.

    A document is its ids followed by ``end_id``; only longer ones are cut, into
    pieces of ``capacity`` (the last may be shorter). As many sequences come out as
    one best-fit decreasing over all pieces makes, however documents are dealt to
    partitions. ``slack``, ``forward`` and ``rows_per_task`` set when the former tree
    of rounds closed bins; they are still taken and change nothing.

    Null texts are empty (one piece, the end id); null ids and repeated rows are
    packed as any other row; an empty table gives no rows; other columns are
    ignored. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = tokens.load(spark, tokenizer)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen, rows = tokens.encoder(shared.value), TaskContext.get().partitionId(), Counter(), []

        def batch_of(rows):
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids = batch.column(0).to_pylist()
            for doc, raw in zip(ids, enc.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                raw += end
                for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[a : a + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, k, a // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
                    if len(rows) >= BLOCK:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    pieces = materialise(narrow.mapInArrow(lean(cut), PIECES), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows reach the driver.
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(np.array(plan(total, capacity), np.int64).reshape(-1, 5))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, seq, each, offset = runs.value.T
        start = (size << 44) + first
        for batch in batches:
            length, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 5))
            r = np.searchsorted(start, (length << 44) + nth, "right") - 1
            at = nth - first[r]
            placed = [pa.array(seq[r] + at // each[r]), pa.array(offset[r] + at % each[r] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *placed], [*batch.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(lean(place), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
