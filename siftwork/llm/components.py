"""Connected components of links, as a distributed union-find.

Alternating large-star and small-star rounds hang every node under ever smaller
roots until each component is a star. A round aggregates minima and joins them
back, so no node's links are ever gathered in one place; every round is written to
the shared folder. Up to ONE_TASK links, which is 16 MB of them, one task joins
them up by itself: the same result without the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, lean, materialise, ship

#: Links that one task joins up.
ONE_TASK = 1_000_000


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node of each one's component) of the links a[i] - b[i]."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)].copy(), at[len(a) :].copy()
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:  # every node follows its label's label to the end
            far = label[label]
            if (far == label).all():
                break
            label = far
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[label]


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if both:
        nodes, labels = least_labels(*(np.concatenate(x) for x in zip(*both, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], ["node", "component"])


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, rounds: int = 40, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) of all nodes with a link to another; component: the least node.

    ``edges`` has columns a and b (long). Null ends and self links are passed over,
    repeated links count once, no links give no rows.
    """
    ship(edges.sparkSession)
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    few = materialise(pairs, "links")
    if few.count() <= one_task:
        return few.coalesce(1).mapInArrow(lean(_one_task), "node long, component long")
    now = materialise(few.distinct(), "links")
    discard(few)
    before = _state(now)
    for _ in range(rounds):
        if not before[0]:
            break
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("mu"), F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("mu")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "links")
        under = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("ma"), "m")
        small = large.join(under, F.col("a") == F.col("ma"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(under.select("ma", "m")).toDF("a", "b").distinct()
        small = materialise(small, "links")
        after = _state(small)
        discard(now, large)
        now = small
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b")).distinct()
