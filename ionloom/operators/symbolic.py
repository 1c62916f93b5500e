"""Symbolic clusters: ions of one molecule merged by annotation, class after class, with ids of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ionloom.operators.graph import cut, numbered

ORDER = ("isotopes", "adducts", "dimers", "multicharges", "fragments")


def symbolic_clusters(quant: DataFrame, clusters: DataFrame, annotations: DataFrame, protonated_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(members, counts). members: symbolic_id, class, source, merged (array of real ids); counts: symbolic_id, sample, n_spectra, area.

    clusters: id, blanks_total, representative; annotations: id, class, target. Each class in turn looks at real clusters
    and at symbolic ones made before, leaves blanks out (and, by default, all but representatives), and adds the targets
    that the source hasn't merged yet. New ids follow the next power of ten above the largest id.
    """
    top = clusters.agg(F.max("id")).first()[0] or 0
    start = 10 ** len(str(max(top - 1, 0))) if top > 1 else 1
    now = clusters.where(F.coalesce("blanks_total", F.lit(0)) == 0)
    if protonated_only:
        now = now.where("representative >= 1")
    now = now.select("id", F.col("id").alias("origin"), F.array("id").alias("merged"))
    made = None
    blanks = clusters.where("blanks_total > 0").select(F.col("id").alias("target"))
    for kind in ORDER:
        own = annotations.where(F.col("class") == kind).select(F.col("id").alias("origin"), "target").distinct().join(blanks, "target", "left_anti")
        targets = now.join(own, "origin").where(~F.array_contains("merged", F.col("target"))).groupBy("id", "origin", "merged").agg(F.array_sort(F.collect_set("target")).alias("more"))
        fresh = cut(numbered(targets, "id", "place").select((F.col("place") + F.lit(start) - 1).cast("long").alias("symbolic_id"), F.lit(kind).alias("class"), F.col("id").alias("source"), "origin", F.array_union("merged", "more").alias("merged")), "symbolic")
        start += fresh.count()
        made = fresh if made is None else made.unionByName(fresh)
        now = now.unionByName(fresh.select(F.col("symbolic_id").alias("id"), "origin", "merged"))
    real = made.select("symbolic_id", F.explode("merged").alias("cluster_id"))
    counts = real.join(quant, "cluster_id").groupBy("symbolic_id", "sample").agg(F.sum("n_spectra").alias("n_spectra"), F.sum("area").alias("area"))
    return made.drop("origin"), counts
