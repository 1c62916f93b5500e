"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ionloom.llm.shared import crc_mod

#: Labelled documents, at most, that a classifier is fitted on.
SAMPLE_ROWS = 8000
#: Rows whose crc32(doc_id as text) leaves this remainder are never learnt from.
FOLDS, HELD_OUT = 5, 0


def held_out(column, folds: int = FOLDS, remainder: int = HELD_OUT):
    return F.coalesce(crc_mod(column, folds) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, y of at most `bound` labelled documents, outside the held-out fold, in an order that ids alone decide.

    Several labels of one document count as their majority (ties: 1); null labels and null ids don't count. Of documents
    that share an id the smallest text is learnt from, so at most `bound` rows come back, the same ones each time.
    """
    ids = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("double").alias("y")).where("doc_id is not null and y is not null")
    ids = ids.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
