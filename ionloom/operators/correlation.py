"""Bioactivity: preparation, correlation with counts, best hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ionloom.functions import stats

#: Rows of samples by group and bioactivity that every cluster meets.
MOST_MEMBERS = 100_000


def prepared_bioactivity(metadata: DataFrame, cutoff: float = 0.0) -> DataFrame:
    """sample, bioactivity (name), value. What isn't a number, is below the cutoff or belongs to a blank without a value is 0; names that are 0 everywhere go."""
    own = metadata.select(F.col("sample_code").alias("sample"), F.explode("bioactivity").alias("bioactivity", "value"))
    own = own.withColumn("value", F.coalesce("value", F.lit(0.0))).withColumn("value", F.when(F.col("value") < cutoff, 0.0).otherwise(F.col("value")))
    alive = own.groupBy("bioactivity").agg(F.max(F.abs("value")).alias("m")).where("m > 0").select("bioactivity")
    return own.join(alive, "bioactivity", "left_semi")


def correlation_groups(metadata: DataFrame) -> DataFrame:
    """sample, cor: members of each correlation group whose marks are all 0 or 1 (others went when the table was read)."""
    own = metadata.select(F.col("sample_code").alias("sample"), F.explode("cor").alias("cor", "member"))
    sound = own.groupBy("cor").agg(F.count_if(F.col("member").isNull()).alias("bad")).where("bad = 0").select("cor")
    return own.where("member").join(sound, "cor", "left_semi").select("sample", "cor")


def correlate(quant: DataFrame, bioactivity: DataFrame, groups: DataFrame, clusters: DataFrame, method: str = "spearman", value: str = "area") -> DataFrame:
    """cluster_id, cor, bioactivity, corr, corr_status for each cluster, group and bioactivity.

    A group of one sample, or whose bioactivity is constant, is skipped. A cluster without any count has neither value nor
    status; one whose counts don't vary has the status CTE.
    """
    members = groups.join(bioactivity, "sample")
    usable = members.groupBy("cor", "bioactivity").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).where("n > 1 and low < high").select("cor", "bioactivity")
    members = members.join(usable, ["cor", "bioactivity"], "left_semi")
    # samples and groups are metadata: few; every cluster meets each of them, as its zero counts matter
    if members.limit(MOST_MEMBERS + 1).count() > MOST_MEMBERS:
        raise ValueError(f"more than {MOST_MEMBERS} samples of groups and bioactivities: correlate fewer at a time")
    full = clusters.select("cluster_id").distinct().crossJoin(F.broadcast(members)).join(quant.select("cluster_id", "sample", F.col(value).cast("double").alias("x")), ["cluster_id", "sample"], "left").fillna(0.0, ["x"])
    key = ["cluster_id", "cor", "bioactivity"]
    found = {"pearson": stats.pearson, "spearman": stats.spearman}[method](full, key, "x", "value") if method != "kendall" else stats.kendall(full, key, "x", "value", "sample")
    sums = full.groupBy(*key).agg(F.sum("x").alias("total"))
    status = F.when(F.col("corr").isNull() & (F.col("total") != 0), F.lit("CTE"))
    return found.join(sums, key).select(*key, "corr", status.alias("corr_status"))


def top_hits(correlations: DataFrame, clusters: DataFrame, n: int, least: float) -> DataFrame:
    """cluster_id, hits (labels <cor>_top_<i>, sorted): of clusters outside blanks and beds, the n best of each correlation.

    Best by correlation, then by the cluster's largest one, then by base peak; ties to the smaller id.
    """
    keep = clusters.where((F.coalesce("blanks_total", F.lit(0)) == 0) & (F.coalesce("beds_total", F.lit(0)) == 0)).select("cluster_id", "base_peak_int")
    own = correlations.where(F.col("corr") >= least).join(keep, "cluster_id")
    own = own.withColumn("largest", F.max("corr").over(Window.partitionBy("cluster_id")))
    name = F.concat_ws("_", "cor", "bioactivity")
    order = Window.partitionBy("cor", "bioactivity").orderBy(F.desc("corr"), F.desc("largest"), F.desc("base_peak_int"), "cluster_id")
    placed = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    return placed.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.concat(name, F.lit("_top_"), F.col("place").cast("string")))).alias("hits"))


def preamble(bioactivity: DataFrame, samples: list[str]) -> list[str]:
    """Lines that stand above a correlation table's header: each bioactivity's values by sample. Metadata alone: a few rows."""
    wide = bioactivity.groupBy("bioactivity").pivot("sample", samples).agg(F.first("value")).orderBy("bioactivity")
    return [",".join([r["bioactivity"], *("" if r[s] is None else repr(r[s]) for s in samples)]) for r in wide.collect()]
