"""Sets of ids in a self-referencing entity, as DataFrames of one column ``id``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Levels that are walked one by one before strides double.
_LEVELS = 8


class _Scratch:
    """Tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

    def __init__(self, spark: SparkSession):
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("a hierarchy needs spark.checkpoint.dir, a folder that driver and executors share")
            found = "file://" + tempfile.mkdtemp(prefix="siftwork-")
            spark.conf.set("spark.checkpoint.dir", found)
        self.spark, self.root = spark, f"{found.rstrip('/')}/siftwork-walk-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: its lineage ends in storage that outlives executors."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _walk(pairs: DataFrame, start: DataFrame) -> DataFrame:
    """Ids reached from ``start`` along (src, dst), ``start`` included, at any depth.

    The first levels are walked one by one from the ids that the last one found first.
    What is deeper is reached by strides that double each round (pairs joined to
    themselves), so a chain of any length takes as many rounds as its length has binary
    digits. A round that finds no new id ends the walk, so cycles end, too.
    """
    scratch = _Scratch(pairs.sparkSession)
    pairs = pairs.select("src", "dst").persist()
    fresh = reached = scratch.keep(start.distinct(), "start")
    stride, rounds = pairs, 0
    while not fresh.isEmpty():
        rounds += 1
        origin = fresh if rounds <= _LEVELS else reached
        after = origin.join(stride, origin["id"] == stride["src"]).select(F.col("dst").alias("id")).distinct()
        fresh = scratch.keep(after.join(reached, "id", "left_anti"), f"fresh{rounds}")
        reached = reached.union(fresh)
        if rounds > _LEVELS:
            reached = scratch.keep(reached, f"reached{rounds}")
            far = stride.select(F.col("src").alias("mid"), F.col("dst").alias("end"))
            stride = scratch.keep(stride.join(far, stride["dst"] == far["mid"]).select("src", F.col("end").alias("dst")).distinct(), f"stride{rounds}")
    pairs.unpersist()
    return reached


def below(table: DataFrame, key: str, parent: str, v, include: bool) -> DataFrame:
    """The descendants of ``v``, with or without itself."""
    pairs = table.select(F.col(parent).alias("src"), F.col(key).alias("dst")).where(F.col("src").isNotNull() & (F.col("src") != F.col("dst")))
    first = table.where(F.col(key) == v).select(F.col(key).alias("id"))
    out = _walk(pairs, first)
    return out if include else out.where(F.col("id") != v)


def above(table: DataFrame, key: str, parent: str, v, include: bool) -> DataFrame:
    """The ancestors of ``v``, with or without itself."""
    pairs = table.select(F.col(key).alias("src"), F.col(parent).alias("dst")).where(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    first = table.where(F.col(key) == v).select(F.col(key).alias("id"))
    out = _walk(pairs, first)
    return out if include else out.where(F.col("id") != v)


def reports(users: DataFrame, user, teams: DataFrame | None = None) -> DataFrame:
    """A user and everyone who reports to them; with ``teams``, their teams too."""
    start = users.sparkSession.range(1).select(F.lit(user).cast(users.dtypes[0][1]).alias("id"))
    people = _walk(users.toDF("dst", "src").where("src is not null and src <> dst").select("src", "dst"), start)
    if teams is None:
        return people
    t = teams.toDF("team", "member")
    return people.union(t.join(people, t["member"] == people["id"], "left_semi").select("team")).distinct()


def child_counts(table: DataFrame, parent: str) -> DataFrame:
    """(id, n) for every id that some row names as its parent."""
    return table.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("id")).agg(F.count(F.lit(1)).alias("n"))
