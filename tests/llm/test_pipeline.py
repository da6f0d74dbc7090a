from standbyspark.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, left = [n for n, _ in pipeline.STAGES], docs
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        left = stage(spark, left, SF)
        assert left.columns[: len(docs.columns)] == docs.columns and (i == 4 or left.columns == docs.columns)
        sizes.append(left.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] >= 0.6 * sizes[0]
    whole = pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in left.collect())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
