"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask picks some positions of a stretch of words and ignores the others, so two
stretches that differ only in ignored positions have the same hash. Hashes of all
masks at all positions of the documents are joined to those of the benchmark. Each
hit fixes an alignment; the words around it are compared one by one and the
overlap stands if enough of them agree.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import words_of

#: Positions that count, from the first; the rest of each stretch is ignored.
MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 3, 6, 7, 9), (0, 2, 3, 5, 8, 10))


def _hashes(masks, at: str, words: str):
    return F.array(*(F.when(F.get(words, F.col(at) + m[-1]).isNotNull(), F.xxhash64(F.lit(k), *(F.get(words, F.col(at) + o) for o in m))) for k, m in enumerate(masks)))


def seeds(benchmark: DataFrame, *, masks=MASKS, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(hash, item_id, at, item): one row per mask, position and item; null texts have none."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), words_of(F.col(text_col)).alias("item")).distinct()
    at = items.select("item_id", "item", F.posexplode("item").alias("at", "_w"))
    hashed = at.select("item_id", "item", "at", F.explode(_hashes(masks, "at", "item")).alias("hash"))
    return hashed.where("hash is not null").select("hash", "item_id", "at", "item")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, masks=MASKS, window: int = 20, least: float = 0.8, block_rows: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs of a document row and a benchmark item that it contains.

    Around a hit, a window of ``window`` words (or the whole item, if shorter) is
    compared; the pair stands if at least the share ``least`` agrees in one window.
    Items with fewer words than the shortest mask reaches can't be told from chance
    and never match. The benchmark is broadcast in blocks of items of about
    ``block_rows`` seeds each, so the broadcast stays bounded however large it is.

    Null or empty texts match nothing; null ids pass through; repeated document rows
    give a row each, repeated items count once; either table may be empty; other
    columns are ignored. Returns doc_id, row (a number of the document's row),
    item_id, n_hits, n_matched (words of the item that agree on the best
    alignment), overlap (their share), first_word, last_word (of the hits).
    """
    wanted = seeds(benchmark, masks=masks)
    blocks = max(1, -(-wanted.count() // block_rows))
    parts = [_against(docs, wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else wanted, masks, window, least, id_col, text_col) for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, parts)


def _against(docs: DataFrame, wanted: DataFrame, masks, window: int, least: float, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), words_of(F.col(text_col)).alias("words"))
    at = rows.select("doc_id", "row", "words", F.posexplode("words").alias("i", "_w"))
    keyed = at.select("doc_id", "row", "words", "i", F.explode(_hashes(masks, "i", "words")).alias("d_hash"))
    hits = keyed.join(F.broadcast(wanted), F.col("d_hash") == F.col("hash"))
    n = F.size("item")
    size = F.least(n, F.lit(window))
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.lit(window // 3), n - size))
    same = lambda j: F.get("words", F.col("i") - F.col("at") + j) == F.get("item", j)
    agree = lambda a, b: F.size(F.filter(F.sequence(a, b - 1), same))
    # Words are compared after the join, on hits alone: the join itself then stays
    # one compiled loop that copies no document's words. The filter on the best
    # window stands above the aggregate so that it is not pushed into the join.
    near, whole = agree(begin, begin + size) / size, agree(F.lit(0), n)
    judged = hits.select("doc_id", "row", "item_id", "i", n.alias("_n"), near.alias("_near"), whole.alias("_all"))
    good = F.col("_near") >= least
    only = lambda c: F.when(good, c)
    return (
        judged.groupBy("doc_id", "row", "item_id")
        .agg(F.count_if(good).alias("n_hits"), F.max(only(F.col("_all"))).cast("long").alias("n_matched"), F.max(only(F.col("_all") / F.col("_n"))).alias("overlap"), F.min(only(F.col("i"))).cast("long").alias("first_word"), F.max(only(F.col("i"))).cast("long").alias("last_word"))
        .where("n_hits > 0")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns.

    Rows are dropped by id; rows with a null id are kept only if no null-id row
    overlaps.
    """
    bad = find_overlaps(docs, benchmark, id_col=id_col, **how).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["_bad"]), "left_anti")
