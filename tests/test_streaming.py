"""A query's filters and projections over a streaming source."""

from siftwork.sources.catalog import Catalog, Entity


def test_filter_and_join_over_a_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a", 5.0), (2, "b", 7.0), (3, None, 9.0)], "id long, kind string, v double").write.parquet(f"{tmp_path}/in")
    kinds = spark.createDataFrame([("a", "first"), ("b", "second")], "kind string, label string")
    stream = lambda s: s.readStream.schema("id long, kind string, v double").parquet(f"{tmp_path}/in")
    c = Catalog(spark, [Entity("event", stream, "id"), Entity("kind", lambda s: kinds, "kind")])
    q = c.query("event", alias="e").join(c.query("kind", alias="k"), lambda r: r.kind, lambda r: r.kind).where(lambda r: r.e.v > 5).select(lambda r: {"id": r.e.id, "label": r.k.label})
    df = q.to_df()
    assert df.isStreaming
    w = df.writeStream.format("memory").queryName("joined_stream").trigger(availableNow=True).start()
    w.awaitTermination(60)
    assert [tuple(r) for r in spark.table("joined_stream").collect()] == [(2, "second")]
