"""Token-ID output: flat unsigned-integer shards with 64-bit document offsets.

A dataset is a folder of shards in ascending document order. Shard ``i`` has
``NAME.bin`` (the ids of its documents, end to end), ``NAME.idx`` (n+1 64-bit
offsets into it, in ids) and ``NAME.doc`` (n 64-bit document ids). ``index.json``
lists the shards with the number of ids before each, from prefix sums, so any
document's place in the whole stream is its shard's base plus its offset.

Each shard is written by one task under a name that holds the task attempt; only
the attempts that Spark accepted are listed, so repeated attempts do no harm.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import lean, scratch_path, ship, slices

NULL_ID = -(2**63)
#: Text units that a worker keeps, more than by default, as no other stage holds memory.
KEEP = 1_800_000


def id_type(tokenizer_json: str, end_id: int) -> str:
    """The narrowest unsigned type that holds every id."""
    spec = json.loads(tokenizer_json)
    vocab = spec["model"]["vocab"]
    top = max([end_id, *(vocab.values() if isinstance(vocab, dict) else [len(vocab)]), *(a["id"] for a in spec.get("added_tokens") or [])])
    return "<u2" if top < 2**16 else "<u4"


def _write(root: str, shared, dtype: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = pafs.FileSystem.from_uri(root)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        enc = tokens.encoder(shared.value, dtype, keep=KEEP)
        end = np.array([end_id], dtype).tobytes()
        width, ids, ends, total, first = np.dtype(dtype).itemsize, [], [0], 0, None
        out = None
        for batch in (part for whole in batches for part in slices(whole, 1)):
            if out is None:
                out = where.open_output_stream(f"{base}/{name}.bin")
            docs = batch.column(0).fill_null(NULL_ID).to_pylist()
            first = docs[0] if first is None else first
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for raw in enc.encode(texts):
                out.write(raw)
                out.write(end)
                total += len(raw) // width + 1
                ends.append(total)
            ids += docs
        if out is None:
            return
        out.close()
        for ext, values in (("idx", ends), ("doc", ids)):
            with where.open_output_stream(f"{base}/{name}.{ext}") as f:
                f.write(np.array(values, "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"shard": pa.array([ctx.partitionId()], pa.int32()), "name": [name], "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    return run


def write_token_files(docs: DataFrame, tokenizer: str, root: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> str:
    """Encode every text, append ``end_id``, write the shards and ``index.json``.

    Documents are range-partitioned and sorted by ``id_col`` (null ids first; rows
    with the same id by their text). Null texts count as empty, so each row has
    at least the end id; an empty table gives a dataset without shards. Other
    columns are ignored. The driver sees one small row for each shard.

    Returns the dataset's path.
    """
    spark = docs.sparkSession
    ship(spark)
    root = root or scratch_path(spark, "tokens")
    shared = tokens.load(spark, tokenizer)
    dtype = id_type(shared.value, end_id)
    where, base = pafs.FileSystem.from_uri(root)
    where.create_dir(base, recursive=True)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    placed = narrow.repartitionByRange(F.col("doc"), F.xxhash64("text")).sortWithinPartitions("doc", "text")
    shards = placed.mapInArrow(lean(_write(root, shared, dtype, end_id)), "shard int, name string, n_docs long, n_tokens long").collect()
    listed, before_ids, before_docs = [], 0, 0
    for s in sorted(shards, key=lambda s: s["shard"]):
        listed.append({"name": s["name"], "n_docs": s["n_docs"], "n_tokens": s["n_tokens"], "base": before_ids, "doc_base": before_docs})
        before_ids, before_docs = before_ids + s["n_tokens"], before_docs + s["n_docs"]
    with where.open_output_stream(f"{base}/index.json") as f:
        f.write(json.dumps({"dtype": dtype, "n_tokens": before_ids, "n_docs": before_docs, "shards": listed}).encode())
    return root


class Shard:
    """A shard opened for reading; local files are memory-mapped."""

    def __init__(self, root: str, name: str, dtype: str):
        where, base = pafs.FileSystem.from_uri(root)
        self.dtype = np.dtype(dtype)
        local = isinstance(where, pafs.LocalFileSystem)
        full = lambda ext: f"{base}/{name}.{ext}"
        if local:
            self.offsets, self.docs = np.memmap(full("idx"), "<i8", "r"), np.memmap(full("doc"), "<i8", "r")
            self.ids = np.memmap(full("bin"), self.dtype, "r")
            self.file = None
        else:
            whole = lambda ext: np.frombuffer(where.open_input_file(full(ext)).read(), "<i8")
            self.offsets, self.docs = whole("idx"), whole("doc")
            self.file = where.open_input_file(full("bin"))

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int) -> np.ndarray:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        if self.file is None:
            return self.ids[a:b]
        w = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((b - a) * w, a * w), self.dtype)


def read_index(root: str) -> dict:
    where, base = pafs.FileSystem.from_uri(root)
    with where.open_input_file(f"{base}/index.json") as f:
        return json.loads(f.read())


class TokenDataset:
    """Random access by document position over all shards."""

    def __init__(self, root: str):
        self.root, self.index = root, read_index(root)
        self.bases = np.array([s["doc_base"] for s in self.index["shards"]], np.int64)
        self.shards: dict[int, Shard] = {}

    def __len__(self) -> int:
        return self.index["n_docs"]

    def __getitem__(self, i: int) -> np.ndarray:
        k = int(np.searchsorted(self.bases, i, "right")) - 1
        if k not in self.shards:
            self.shards[k] = Shard(self.root, self.index["shards"][k]["name"], self.index["dtype"])
        return self.shards[k][i - int(self.bases[k])]


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    index = read_index(root)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not index["shards"]:
        return spark.createDataFrame([], schema)
    dtype = index["dtype"]
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(root, name, dtype)
                for a in range(0, len(shard), 4096):
                    b = min(a + 4096, len(shard))
                    crc = [zlib.crc32(shard[i].astype("<u4").tobytes()) for i in range(a, b)]
                    docs, off = np.array(shard.docs[a:b]), np.array(shard.offsets[a : b + 1])
                    yield pa.RecordBatch.from_arrays([pa.array(docs, mask=docs == NULL_ID), pa.array(off[:-1] + base), pa.array(np.diff(off)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = [(s["name"], s["base"]) for s in index["shards"]]
    return spark.createDataFrame(rows, "name string, base long").repartition(len(rows)).mapInArrow(lean(run), schema)
