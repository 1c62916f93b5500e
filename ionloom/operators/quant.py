"""Quantification: long tables by cluster and sample, reducers that merge rows, pivots only at sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ionloom.operators.joins import near_exists


def quantify(members: DataFrame, cluster: str = "cluster_id", sample: str = "sample", area: str = "peak_area") -> DataFrame:
    """cluster, sample, n_spectra, area: the sum of distinct truncated areas. Equal truncated areas count once."""
    whole = F.floor(F.col(area))
    return members.groupBy(cluster, sample).agg(F.count("*").alias("n_spectra"), F.sum_distinct(whole).cast("double").alias("area"))


def pivoted(quant: DataFrame, cluster: str, sample: str, samples: list, n_spectra: bool = True, area: bool = True) -> DataFrame:
    """The wide table of a sink: <sample>_spectra and <sample>_area, 0 where there is none. samples is the metadata's list."""
    parts = []
    if n_spectra:
        parts += [F.coalesce(F.sum(F.when(F.col(sample) == s, F.col("n_spectra"))), F.lit(0)).alias(f"{s}_spectra") for s in samples]
    if area:
        parts += [F.coalesce(F.sum(F.when(F.col(sample) == s, F.col("area"))), F.lit(0.0)).alias(f"{s}_area") for s in samples]
    return quant.groupBy(cluster).agg(*parts)


def base_peaks(members: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return members.groupBy(cluster).agg(F.max("base_peak_int").alias("base_peak_int"))


def rolled_up(parts: DataFrame, membership: DataFrame) -> DataFrame:
    """Counts of sub-clusters (sub_id, sample, n_spectra, area) summed by the cluster that holds them (sub_id, cluster_id)."""
    return parts.join(membership, "sub_id").groupBy("cluster_id", "sample").agg(F.sum("n_spectra").alias("n_spectra"), F.sum("area").alias("area"))


def group_sums(quant: DataFrame, tags: DataFrame, cluster: str = "cluster_id", value: str = "area") -> DataFrame:
    """cluster, tag, value summed over the tag's samples; tags: sample, tag (a sample may have several)."""
    return quant.join(tags, "sample").groupBy(cluster, "tag").agg(F.sum(value).alias(value))


def type_totals(quant: DataFrame, types: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Spectra by sample type, 0 where there are none; types: sample, sample_type."""
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("sample_type") == kind, F.col("n_spectra"))), F.lit(0))
    return quant.join(types, "sample").groupBy(cluster).agg(total("blank").alias("blanks_total"), total("control").alias("controls_total"), total("bed").alias("beds_total"))


def near_flags(clusters: DataFrame, mz_tolerance: float, mz: str = "mz") -> DataFrame:
    """clusters (mz, blanks_total, controls_total, beds_total) with bflag, cflag, bedflag: such a sample's mass is near."""
    for flag, total in (("bflag", "blanks_total"), ("cflag", "controls_total"), ("bedflag", "beds_total")):
        clusters = near_exists(clusters, mz, clusters.where(F.col(total) > 0), mz, mz_tolerance, flag)
    return clusters


def hit_samples(clusters: DataFrame, hits: DataFrame, mz_tolerance: float) -> DataFrame:
    """clusters (id, mz) with hflag: the hit samples (hits: sample, mz) whose masses lie within the tolerance, sorted; null if none."""
    width = mz_tolerance if mz_tolerance > 0 else 1.0
    spread = hits.select("sample", F.col("mz").alias("_hit")).distinct().withColumn("_near", F.explode(F.array(*[F.floor(F.col("_hit") / width) + k for k in (-1, 0, 1)])))
    met = clusters.join(spread, (F.floor(F.col("mz") / width) == F.col("_near")) & (F.abs(F.col("mz") - F.col("_hit")) <= mz_tolerance))
    listed = met.groupBy("id").agg(F.array_sort(F.collect_set("sample")).alias("hflag"))
    return clusters.join(listed, "id", "left")


def noise_filtered(clusters: DataFrame, factor: float, blank: Column, value: str = "base_peak_int") -> DataFrame:
    """Rows above median + factor * (third quartile - first), of blank rows where there are any, else of all."""
    return clusters.crossJoin(F.broadcast(cutoff(clusters, factor, blank, value))).where(F.col(value) > F.col("cutoff")).drop("cutoff")


def cutoff(clusters: DataFrame, factor: float, blank: Column, value: str = "base_peak_int", spread_from: float = 0.25) -> DataFrame:
    """One row: median + factor * (q3 - q1) of blank rows, or of all rows where none is blank."""

    def of(x: Column) -> Column:
        q = F.percentile(x, F.array(F.lit(spread_from), F.lit(0.5), F.lit(0.75)))
        return q[1] + F.lit(float(factor)) * (q[2] - q[0])

    return clusters.agg(F.coalesce(of(F.when(blank, F.col(value))), of(F.col(value))).alias("cutoff"))


# Reducers: what becomes of each column when rows merge ---------------------------------------------------------------


def weighted_mean(value: str, weight: str, digits: int = 4) -> Column:
    return F.bround(F.sum(F.col(value) * F.col(weight)) / F.sum(weight), digits)


def listed(values: str, order: str) -> Column:
    """All values in turn, null ones left out."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(values).isNotNull(), F.struct(F.col(order).alias("o"), F.col(values).alias("v"))))), lambda x: x["v"])


def united(lists: str, order: str) -> Column:
    """Arrays' distinct values, in order of first appearance."""
    held = F.array_sort(F.collect_list(F.when(F.col(lists).isNotNull(), F.struct(F.col(order).alias("o"), F.col(lists).alias("v")))))
    return F.array_distinct(F.flatten(F.transform(held, lambda x: x["v"])))


def reducers(kind: str, columns: list[str], key: str = "id", weight: str = "sum_ints") -> list[Column]:
    """Aggregates by column for rows that merge: "clean" (similar spectra), "symbolic" (ion variants: the first row gives
    identity), "ms1" (peaks without spectra). Counts and areas add up; flags hold if any does; lists are joined."""
    blank = F.max((F.col("rt_min") == 0) & (F.col("rt_max") == 1_000_000)) if {"rt_min", "rt_max"} <= set(columns) else F.lit(False)
    first = lambda c: F.min_by(c, key)
    out = []
    for c in columns:
        if c == "id":
            e = F.min(c)
        elif c in ("mz", "rt_mean"):
            e = first(c) if kind == "symbolic" else weighted_mean(c, weight)
        elif c in ("rt_min", "rt_max"):
            e = first(c) if kind == "symbolic" else F.when(blank, F.lit(0.0 if c == "rt_min" else 1_000_000.0)).otherwise(weighted_mean(c, weight))
        elif c == "num_joins":
            e = F.sum(c) + F.count("*") - 1
        elif c == "base_peak_int":
            e = F.max(c)
        elif c == "blank_dist":
            e = F.min(c)
        elif c.endswith("flag") and c != "hflag":
            e = F.max(F.coalesce(F.col(c), F.lit(False)))
        elif c in ("peak_ids", "hflag"):
            e = united(c, key)
        elif c in ("joined_ids", "scans"):
            e = F.flatten(listed(c, key))
        elif c == "peaks":
            e = first(c) if kind == "symbolic" else F.flatten(listed(c, key))
        elif c in ("smiles", "compound"):
            e = F.array_join(listed(c, key), "," if kind == "symbolic" else ";")
        elif c == "sum_areas" and kind == "ms1":
            e = F.sum(F.floor(c)).cast("double")
        else:
            e = F.sum(c)
        out.append(e.alias(c if c != key or key == "id" else key))
    return out


def merged(rows: DataFrame, group: str, kind: str = "clean", key: str = "id", weight: str = "sum_ints") -> DataFrame:
    """One row for each group, by the reducers of its columns."""
    own = [c for c in rows.columns if c != group]
    return rows.groupBy(group).agg(*reducers(kind, own, key, weight))


def quality_statistics(clusters: DataFrame, n_spectra: str = "n_spectra") -> DataFrame:
    """One row: clusters, those outside blanks, spectra, distinct masses to two digits, mean clusters a mass."""
    mass = F.bround("mz", 2)
    return clusters.agg(
        F.count_distinct("id").alias("n_clusters"), F.count_if(F.coalesce("blanks_total", F.lit(0)) == 0).alias("n_not_blank"), F.sum(n_spectra).alias("n_spectra"),
        F.count_distinct(mass).alias("n_masses"), (F.count_distinct("id") / F.count_distinct(mass)).alias("clusters_a_mass"),
    )


def size_histogram(clusters: DataFrame, n_spectra: str = "n_spectra") -> DataFrame:
    return clusters.groupBy(F.col(n_spectra).alias("size")).agg(F.count("*").alias("n_clusters"))


def isomer_diagnostics(clusters: DataFrame) -> DataFrame:
    """Per cluster (id, peak_ids like 12_S1 or fake_S1): samples, samples with several real peaks, real and fake peaks."""
    ids = clusters.select("id", F.explode_outer("peak_ids").alias("peak"))
    sample = F.regexp_extract("peak", r"^[^_]*_(.*)$", 1)
    fake = F.col("peak").startswith("fake_")
    per = ids.where("peak is not null").groupBy("id", sample.alias("sample")).agg(F.count_if(~fake).alias("real"), F.count_if(fake).alias("fake"))
    out = per.groupBy("id").agg(F.count("*").alias("n_samples"), F.count_if(F.col("real") > 1).alias("n_samples_joined"), F.sum("real").alias("n_real"), F.sum("fake").alias("n_fake"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return clusters.select("id").join(out, "id", "left").select("id", zero("n_samples"), zero("n_samples_joined"), zero("n_real"), zero("n_fake"))


def isomer_histogram(masses: DataFrame, peaks: DataFrame, mz_tolerance: float, most: int = 301) -> DataFrame:
    """n_peaks (most: that many or more), n_masses: how many masses (mz) have how many MS1 peaks (mz) within the tolerance."""
    width = mz_tolerance if mz_tolerance > 0 else 1.0
    own = masses.select("mz").distinct()
    spread = peaks.select(F.col("mz").alias("_peak")).withColumn("_near", F.explode(F.array(*[F.floor(F.col("_peak") / width) + k for k in (-1, 0, 1)])))
    met = own.join(spread, (F.floor(F.col("mz") / width) == F.col("_near")) & (F.abs(F.col("mz") - F.col("_peak")) <= mz_tolerance), "left")
    per = met.groupBy("mz").agg(F.count("_peak").alias("n"))
    return per.groupBy(F.least(F.col("n"), F.lit(most)).alias("n_peaks")).agg(F.count("*").alias("n_masses"))
