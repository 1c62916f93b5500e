"""The queries of the ten operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.jaccard import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.packing import best_fit_packing

    return best_fit_packing(_table(spark, sf_dir, "documents"), with_ids=False)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.mixing import mix

    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("copies").cast("int").alias("copies"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.language_model import score

    return score(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.toxicity import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.extraction import main_text

    return main_text(_table(spark, sf_dir, "pages"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.fingerprints import compare_edited

    return compare_edited(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.quality import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ionloom.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {}
