import corpus_pipeline


def test_stages_keep_the_columns(spark, documents, nothing, tmp_path):
    benchmark = spark.createDataFrame([(1, "no such passage is in any of these texts at all")], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents.select(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == corpus_pipeline.COLUMNS and kept.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert stage(spark, nothing, str(tmp_path)).count() == 0
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert mixed.count() == docs.count() and {"taken", "repeats"} <= set(mixed.columns)
    ids = {r["doc_id"] for r in docs.collect()}
    assert {1, 4, 5, 6, 12} <= ids and not {2, 3, 7, 8, 9} & ids
