"""Library identification: results of a search joined to clusters, and a search of our own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ionloom.functions.kernels import shifted_cosine_of
from ionloom.operators.joins import range_join


def remapped(results: DataFrame, joined: DataFrame, scan: str = "scan") -> DataFrame:
    """results with cluster_id: the cluster that has joined the scan (joined: id, joined_ids), else the scan itself."""
    via = joined.select(F.col("id").alias("_id"), F.explode("joined_ids").alias("_scan"))
    return results.join(via, results[scan] == via["_scan"], "left").withColumn("cluster_id", F.coalesce("_id", scan)).drop("_id", "_scan")


def joined_results(clusters: DataFrame, results: DataFrame, columns: list[str], score: str = "mq_score", spectrum: str = "spectrum_id") -> DataFrame:
    """clusters (id) left-joined with their results: the best of each library spectrum, best first, ';' between, prefix gnps_."""
    best = Window.partitionBy("cluster_id", spectrum).orderBy(F.desc(score))
    own = results.withColumn("_n", F.row_number().over(best)).where("_n = 1")
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(spectrum).alias("i"), F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias("v")))), lambda x: x["v"]), ";")
    held = own.groupBy("cluster_id").agg(*[listed(c).alias(f"gnps_{c}") for c in columns])
    return clusters.join(held, clusters["id"] == held["cluster_id"], "left").drop("cluster_id")


def with_compounds(hits: DataFrame, compounds: DataFrame, key: str = "compound_id") -> DataFrame:
    """Hits with their compounds; a hit whose compound isn't known fails when rows are read."""
    met = hits.join(compounds.withColumn("_known", F.lit(True)), key, "left")
    return met.withColumn("_known", F.when(F.col("_known"), True).otherwise(F.raise_error(F.concat(F.lit("no such compound: "), F.col(key).cast("string"))).cast("boolean"))).where("_known").drop("_known")


def top_results(clusters: DataFrame, hits: DataFrame, most: int, columns: list[str], score: str = "score") -> DataFrame:
    """clusters (id) with the values of at most `most` hits, best first, ';' between; NA where there is none."""
    place = Window.partitionBy("cluster_id").orderBy(F.desc(score), *columns)
    own = hits.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= most)
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_n"), F.col(c).cast("string").alias("v")))), lambda x: x["v"]), ";")
    held = own.groupBy("cluster_id").agg(*[listed(c).alias(c) for c in columns])
    return clusters.join(held, clusters["id"] == held["cluster_id"], "left").drop("cluster_id").fillna("NA", columns)


def search(spectra: DataFrame, library: DataFrame, mz_tolerance: float, fragment_tolerance: float, least: float = 0.2, top_k: int = 10) -> DataFrame:
    """cluster_id, compound_id, score, matched, rank: library spectra of near precursor mass, best cosines first.

    spectra: id, precursor_mz, peaks; library: compound_id, precursor_mz, peaks.
    """
    l = spectra.select("id", "precursor_mz", "peaks").alias("l")
    r = library.select("compound_id", "precursor_mz", "peaks").alias("r")
    met = range_join(l, r, F.col("l.precursor_mz"), F.col("r.precursor_mz"), mz_tolerance)
    scored = met.select(F.col("l.id").alias("cluster_id"), "compound_id", shifted_cosine_of(F.col("l.peaks"), F.col("r.peaks"), F.lit(0.0), fragment_tolerance).alias("s"))
    scored = scored.select("cluster_id", "compound_id", F.col("s.cosine").alias("score"), F.col("s.matched").alias("matched")).where(F.col("score") >= least)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("score"), "compound_id"))).where(F.col("rank") <= top_k)
