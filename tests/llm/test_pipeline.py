from __future__ import annotations

import corpus_pipeline
from ionloom.llm import jaccard, packing, quality, suffixes

from .helpers import frame, odd_rows


def test_stages_and_names():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in corpus_pipeline.queries()


def test_stages_keep_columns_and_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, n = docs.columns, docs.count()
    good = quality.keep_good(docs, spark.read.parquet(f"{small}/labels.parquet"))
    lone = jaccard.one_of_each(good)
    assert good.columns == lone.columns == columns and lone.count() < good.count() <= n
    assert jaccard.jaccard_join(lone).where("n_links > 0").count() == 0
    cut = suffixes.without_repeats(lone)
    assert cut.count() == lone.count()


def test_whole_run(spark, small):
    out = corpus_pipeline.run(spark, small).toPandas()
    assert len(out) and (out.groupby("sequence_id")["length"].sum() <= packing.CAPACITY).all()


def test_stages_bear_odd_documents(spark, tmp_path):
    (tmp_path / "x").mkdir()
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "x" / "labels.parquet"))
    for rows in (odd_rows(), []):
        docs = frame(spark, rows) if rows else spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{len(rows)}-{k}")
            stage(spark, docs, str(tmp_path / "x")).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() >= (1 if rows else 0)
