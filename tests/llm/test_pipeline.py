import corpus_pipeline


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir).cache()
        assert after.columns == columns and 0 < after.count() <= docs.count()
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
