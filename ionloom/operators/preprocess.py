"""Pre-processing aggregates: MS1 filters, lists with and without spectra, match rates, peak widths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ionloom.operators.joins import almost_unique, first_of_each


def in_precursor_range(ms1: DataFrame, spectra: DataFrame) -> DataFrame:
    """MS1 peaks from the lowest precursor less 25 to three times the highest plus 25."""
    bounds = spectra.agg(F.min("precursor_mz").alias("_low"), F.max("precursor_mz").alias("_high"))
    met = ms1.crossJoin(F.broadcast(bounds))
    return met.where((F.col("mz_min") >= F.col("_low") - 25) & (F.col("mz_max") <= 3 * F.col("_high") + 25)).drop("_low", "_high")


def split_by_spectra(ms1: DataFrame, matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MS1 peaks that some spectrum matches, with ms2_matches, and the others, their ids marked _NOPEAKS."""
    counts = matched.where("not is_fake").groupBy("peak_id").agg(F.count("*").alias("ms2_matches"))
    own = ms1.join(counts, "peak_id", "left").fillna(0, ["ms2_matches"])
    return own.where("ms2_matches > 0"), own.where("ms2_matches = 0").withColumn("peak_id", F.concat("peak_id", F.lit("_NOPEAKS")))


def blank_masses(spectra: DataFrame, tolerance: float) -> DataFrame:
    """Precursor masses of blanks, one of those that lie together."""
    return almost_unique(spectra.where("is_blank").select("precursor_mz", "spectrum_id"), "precursor_mz", tolerance, ["precursor_mz", "spectrum_id"]).select("precursor_mz")


def with_enough_peaks(spectra: DataFrame, least: int = 5) -> DataFrame:
    """Spectra (peaks) of at least `least` peaks; the others aren't written out."""
    return spectra.where(F.size("peaks") >= least)


def presence(intensity):
    """A precursor's ion count, at least 1 so that it counts as there."""
    return F.when(intensity == 0, F.lit(1.0)).otherwise(intensity)


def match_rates(matched: DataFrame, warn_above: float = 5.0) -> DataFrame:
    """Per sample: spectra, those without an MS1 peak, their share in percent, whether that is too much."""
    share = 100.0 * F.count_if("is_fake") / F.count("*")
    return matched.groupBy("sample").agg(F.count("*").alias("n_spectra"), F.count_if("is_fake").alias("n_unmatched"), share.alias("percent_unmatched"), (share > warn_above).alias("warn"))


def top_unmatched(matched: DataFrame, n: int = 5) -> DataFrame:
    """Per sample, the n masses (to two digits) without a peak: most frequent, then strongest, then heaviest first."""
    own = matched.where("is_fake").groupBy("sample", F.bround("mz", 2).alias("mz")).agg(F.count("*").alias("freq"), F.max("intensity").alias("intensity"))
    return first_of_each(own, ["sample"], [F.desc("freq"), F.desc("intensity"), F.desc("mz")], n)


def alignment_samples(metadata: DataFrame, n: int = 3) -> DataFrame:
    """The first n samples of each batch that aren't blank, by file name."""
    return first_of_each(metadata.where("sample_type <> 'blank'"), ["batch"], ["filename"], n)


def batch_plan(metadata: DataFrame) -> DataFrame:
    """What is clustered together: batch, is_blank, samples; blanks are a list of their own."""
    return metadata.groupBy("batch", (F.col("sample_type") == "blank").alias("is_blank")).agg(F.array_sort(F.collect_list("sample_code")).alias("samples"))


def peak_widths(clusters: DataFrame, factors: tuple[float, ...] = (1.5, 1.25, 1.0, 0.75, 0.5, 0.25, 0.0)) -> DataFrame:
    """One row: suggested peak widths of clusters outside blanks, and the time tolerance: half the mean (or median) width.

    Bounds are the quartiles, widened by the largest factor of their distance that leaves the lower one positive.
    """
    own = clusters.where("not coalesce(bflag, false) and rt_max > rt_min and rt_max < 1000000").select((F.col("rt_max") - F.col("rt_min")).alias("w"))
    q = own.agg(F.percentile("w", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.avg("w").alias("mean"), F.min("w").alias("least"), F.max("w").alias("most"))
    spread = F.col("q")[2] - F.col("q")[0]
    low = F.coalesce(*[F.when(F.col("q")[0] - f * spread > 0, F.col("q")[0] - f * spread) for f in factors])
    high = F.coalesce(*[F.when(F.col("q")[0] - f * spread > 0, F.col("q")[2] + f * spread) for f in factors])
    return q.select(F.greatest("least", low).alias("width_from"), F.least("most", high).alias("width_to"), (F.col("mean") / 2).alias("rt_tolerance_mean"), (F.col("q")[1] / 2).alias("rt_tolerance_median"))


def chromatogram(ms1: DataFrame, kind: str = "tic", mz_from: float = 0.0, mz_to: float = 1e9, rt_from: float = 0.0, rt_to: float = 1e9) -> DataFrame:
    """sample, rt, intensity: total (tic, xic) or base peak (bpc) intensity of points (sample, rt, mz, intensity) in a range."""
    own = ms1.where(F.col("mz").between(mz_from, mz_to) & F.col("rt").between(rt_from, rt_to))
    return own.groupBy("sample", "rt").agg((F.max if kind == "bpc" else F.sum)("intensity").alias("intensity"))
