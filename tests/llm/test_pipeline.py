"""The stages one after the other over a fixture, by hand."""

from pyspark.sql import functions as F

from .test_llm import prose


def test_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    bench = prose(900, 30)
    texts = {0: prose(0, 80), 1: prose(1, 80), 2: prose(1, 80), 3: bench + " " + prose(3, 40), 4: prose(4, 60) + " password=abcdef123456", 5: prose(5, 70), 6: None, 7: ""}
    texts |= {i: prose(i, 60) + (" vexidor " + prose(i, 5) if i % 6 == 0 else "") for i in range(100, 400)}
    docs = spark.createDataFrame([(i, t, "en", "a" if i % 2 else None, len(t or ""), "x") for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long, label string")
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(100, 400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        got = stage(spark, kept, str(tmp_path))
        if k < len(pipeline.STAGES) - 1:
            assert got.columns == docs.columns, name
        got.write.parquet(f"{tmp_path}/{k}.parquet")
        kept = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    every = set(texts)
    toxic = {i for i in range(100, 400) if i % 6 == 0}
    assert ids[0] == every - toxic
    assert ids[1] == ids[0] - {2}
    assert ids[2] == ids[1] - {3}
    assert ids[3] == ids[2]
    assert kept.where(F.col("text").contains("abcdef123456")).count() == 0
    assert ids[4] <= ids[3] - {6, 7} and kept.where("copies < 1 or copies > 3").count() == 0


def test_empty_tables_and_clashing_names(spark, tmp_path):
    import corpus_pipeline as pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, copies string, row_key int, size int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame([(i, f"one two {i}", "en", "a", 1, "mine", 1, 2) for i in range(3)], schema)
    got = pipeline.mix_sources(spark, docs, str(tmp_path))
    assert got.columns == [*docs.columns, "copies_"] and got.where("copies != 'mine'").count() == 0
