"""Small helpers the corpus operators share: tables, scratch space, batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from . import textkernel


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each Spark context.

    They need not have it installed; the archive is served by the driver.
    """
    sc = spark.sparkContext
    if getattr(sc, "_siftwork_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    where = os.path.join(tempfile.mkdtemp(prefix="siftwork-"), "siftwork.zip")
    with zipfile.ZipFile(where, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(where)
    sc._siftwork_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session leaves it unset (tests) a temporary folder is made once and
    recorded under that name; on a cluster that is an error, as each machine would
    write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="siftwork-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/siftwork-{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage in storage that survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the scratch tables of ``materialise`` once nothing reads them."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def chunks(sizes, limit: int):
    """(start, end) index ranges whose summed sizes stay near ``limit``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(batch: pa.RecordBatch, column: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of near ``limit`` bytes of text, so few texts are Python strings at once."""
    for a, b in chunks(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), limit):
        yield batch.slice(a, b - a)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, whose worker gives its memory back to the system at a task's end.

    Workers are reused; what they keep between tasks is missing to the next stage.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            textkernel.forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return whole
