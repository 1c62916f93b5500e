"""From raw documents to training sequences: each stage works on all rows that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ionloom.llm import jaccard, mixing, packing, quality, suffixes
from ionloom.llm.shared import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labelled ones, doesn't reject.

    Null and empty texts are scored as texts without words. Without usable labels all rows stay. No rows give no rows.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Null texts are empty, and equal texts are copies. Rows without id come last in their group; unrelated texts stay, whatever
    their ids. No rows give no rows.
    """
    return jaccard.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long strings that an earlier place holds as well.

    All rows stay, those without id last in order. Null texts stay null, short ones whole. No rows give no rows.
    """
    return suffixes.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Texts without words are never taken; a null source is a source. No rows give no rows.
    """
    return mixing.apply_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokens and their places in sequences.

    Null and empty texts are an end alone. Rows that repeat are packed as often as they come. No rows give no pieces.
    """
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages: models, hashes of token ids and packing. tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on documents; each result is written as Parquet and read again as the next one's docs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
