"""A corpus pipeline: five stages, each calling one operator of ``siftwork.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
All but the last return the columns of ``documents``. The stages are written as
Parquet between one another, so a lost executor costs no more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import decontaminate, jaccard_join, linededup, packing, quality
from siftwork.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below 0.3 go.

    The classifier learns from the labelled documents of the whole table that are
    not held out (at most 20,000 of them) and sees only their texts.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), bound=20_000)
    return quality.keep_good(docs, model, threshold=0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines the first stays; ``n_chars`` follows the new text."""
    out = linededup.dedup_lines(docs, threshold=0.8)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in out.columns else out


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the least id.

    Documents that line dedup has emptied are equal texts, so one of them stays.
    """
    return jaccard_join.keep_one(docs, n=5, threshold=0.8)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the near-duplicate stages and the tokenizer are beyond SQL; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage{i}")
    return docs
