"""The stages one by one on a small corpus, and the registered names."""

import __spark_entry__ as entry
import corpus_pipeline
from siftwork.llm import registry


def test_registered():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)} and names < set(entry.queries()) and "pipeline" in entry.queries()


def test_stages_keep_columns_and_clean_documents(spark, prose, tmp_path):
    shouted = lambda t: " ".join(f"{w.upper()}!!" for w in t.split())
    item = prose(40)
    base = [prose(80) for _ in range(150)]
    rows = [(i, shouted(t) if i % 5 == 0 else t, "en", "s", len(t)) for i, t in enumerate(base)]
    rows += [(500, base[1], "en", "s", 1), (501, base[2].replace(base[2].split()[3], "edit"), "en", "s", 1), (502, prose(20) + " " + item, "en", "s", 1), (503, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    good = {i for i in range(150) if i % 5}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    one = stages["quality classifier"](spark, docs, str(tmp_path))
    assert one.columns == docs.columns and good | {500, 501, 502} <= ids(one) <= good | {500, 501, 502, 503}
    two = stages["line dedup"](spark, docs, str(tmp_path))
    assert two.columns == docs.columns and ids(two) == ids(docs) and {r.doc_id for r in two.where("text = ''").collect()} == {500, 501}
    three = stages["n-gram Jaccard join"](spark, docs, str(tmp_path))
    assert three.columns == docs.columns and ids(three) == ids(docs) - {500, 501}
    four = stages["benchmark decontamination"](spark, docs, str(tmp_path))
    assert four.columns == docs.columns and ids(four) == ids(docs) - {502}
    five = stages["best-fit packing"](spark, docs, str(tmp_path))
    assert ids(five) == ids(docs)
    whole = ids(corpus_pipeline.run(spark, str(tmp_path)))
    assert good <= whole and 502 not in whole
