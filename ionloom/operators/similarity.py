"""Similarity of spectra as sparse pairs: an index on peaks finds candidates, kernels score them. No N x N table exists."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ionloom.functions.kernels import cosine_of, shifted_cosine_of


def _cells(value, width: float):
    return F.explode(F.array(*[F.floor(value / width) + k for k in (-1, 0, 1)]))


def candidate_pairs(spectra: DataFrame, tolerance: float, max_shift: float | None = None) -> DataFrame:
    """id_a < id_b of spectra (id, precursor_mz, peaks) with a peak in common, directly or by the precursors' difference.

    Direct: m/z within the tolerance. Shifted: precursor less m/z within it, for precursors within max_shift. All other
    pairs have cosine 0. None for max_shift leaves shifted pairs out.
    """
    width = tolerance if tolerance > 0 else 1e-6
    peaks = spectra.select("id", "precursor_mz", F.explode("peaks").alias("p")).select("id", "precursor_mz", F.col("p.mz").alias("mz"))

    def met(value, slack: float):
        left = peaks.select(F.col("id").alias("id_a"), F.col("precursor_mz").alias("pa"), value.alias("x"), F.floor(value / width).alias("cell"))
        right = peaks.select(F.col("id").alias("id_b"), F.col("precursor_mz").alias("pb"), value.alias("y"), _cells(value, width).alias("cell"))
        return left.join(right, "cell").where((F.col("id_a") < F.col("id_b")) & (F.abs(F.col("x") - F.col("y")) <= tolerance + slack))

    out = met(F.col("mz"), 0.0).select("id_a", "id_b")
    if max_shift is not None:
        loss = met(F.col("precursor_mz") - F.col("mz"), 1e-9).where(F.abs(F.col("pa") - F.col("pb")) <= max_shift)
        out = out.unionByName(loss.select("id_a", "id_b"))
    return out.distinct()


def pairwise(spectra: DataFrame, tolerance: float, max_shift: float | None = None, least: float = 0.1, digits: int = 3) -> DataFrame:
    """id_a < id_b, cosine (rounded), matched, n_peaks_a, n_peaks_b for pairs of at least `least`; all others are 0.

    With max_shift, cosines are shifted by the precursors' difference where that is no more.
    """
    pairs = candidate_pairs(spectra, tolerance, max_shift)
    side = lambda s: spectra.select(F.col("id").alias(f"id_{s}"), F.col("precursor_mz").alias(f"mz_{s}"), F.col("peaks").alias(f"peaks_{s}"))
    met = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
    shift = F.col("mz_a") - F.col("mz_b") if max_shift is not None else F.lit(0.0)
    scored = met.withColumn("s", shifted_cosine_of(F.col("peaks_a"), F.col("peaks_b"), shift, tolerance, max_shift if max_shift is not None else math.inf))
    out = scored.select("id_a", "id_b", F.bround("s.cosine", digits).alias("cosine"), F.col("s.matched").alias("matched"), F.size("peaks_a").alias("n_peaks_a"), F.size("peaks_b").alias("n_peaks_b"))
    return out.where(F.col("cosine") >= least)


def binned_cosine(peaks: DataFrame) -> DataFrame:
    """id_a < id_b, cosine, matched of spectra as rows (id, mz, intensity), where equal m/z alone match: one equi-join.

    The form for masses that are integers, or numbers of bins. Norms are computed once for each spectrum.
    """
    norms = peaks.groupBy("id").agg(F.sum(F.col("intensity") * F.col("intensity")).alias("norm"))
    a, b = peaks.alias("a"), peaks.alias("b")
    met = a.join(b, (F.col("a.mz") == F.col("b.mz")) & (F.col("a.id") < F.col("b.id")))
    top = met.groupBy(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).agg(F.sum(F.col("a.intensity") * F.col("b.intensity")).alias("top"), F.count("*").alias("matched"))
    with_norms = top.join(norms.select(F.col("id").alias("id_a"), F.col("norm").alias("norm_a")), "id_a").join(norms.select(F.col("id").alias("id_b"), F.col("norm").alias("norm_b")), "id_b")
    return with_norms.select("id_a", "id_b", (F.col("top") / F.sqrt(F.col("norm_a") * F.col("norm_b"))).alias("cosine"), "matched")


def binned_shifted_cosine(peaks: DataFrame, precursors: DataFrame) -> DataFrame:
    """As binned_cosine, then what is left over once more, moved by the precursors' difference (precursors: id, precursor).

    Of each pair the one with the larger precursor (ties: larger id) is a; its leftover peaks match b's that lie the
    difference lower. Pairs without any match don't come.
    """
    own = peaks.join(precursors, "id")
    norms = peaks.groupBy("id").agg(F.sum(F.col("intensity") * F.col("intensity")).alias("norm"))
    a, b = own.alias("a"), own.alias("b")
    above = (F.col("a.precursor") > F.col("b.precursor")) | ((F.col("a.precursor") == F.col("b.precursor")) & (F.col("a.id") > F.col("b.id")))
    keep = [F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), F.col("a.mz").alias("mz_a"), F.col("b.mz").alias("mz_b"), (F.col("a.intensity") * F.col("b.intensity")).alias("product")]
    direct = a.join(b, (F.col("a.mz") == F.col("b.mz")) & above).select(*keep)
    moved = F.col("a.precursor") - F.col("b.precursor")
    # a leftover of a has no equal in b, and one of b none in a; that is asked once the shifted pair is met
    shifted = a.join(b, (F.col("a.mz") - F.col("a.precursor") == F.col("b.mz") - F.col("b.precursor")) & above & (moved > 0)).select(*keep)
    held = peaks.select(F.col("id").alias("hid"), F.col("mz").alias("hmz"))
    shifted = shifted.join(held, (F.col("id_b") == F.col("hid")) & (F.col("mz_a") == F.col("hmz")), "left_anti").join(held, (F.col("id_a") == F.col("hid")) & (F.col("mz_b") == F.col("hmz")), "left_anti")
    top = direct.unionByName(shifted).groupBy("id_a", "id_b").agg(F.sum("product").alias("top"), F.count("*").alias("matched"))
    with_norms = top.join(norms.select(F.col("id").alias("id_a"), F.col("norm").alias("norm_a")), "id_a").join(norms.select(F.col("id").alias("id_b"), F.col("norm").alias("norm_b")), "id_b")
    return with_norms.select("id_a", "id_b", (F.col("top") / F.sqrt(F.col("norm_a") * F.col("norm_b"))).alias("cosine"), "matched")


def shared_proportion(peaks: DataFrame) -> DataFrame:
    """id_a < id_b, share: 2 * common peaks / all peaks of both, at most 1, of spectra as rows (id, mz)."""
    n = peaks.groupBy("id").agg(F.count("*").alias("n"))
    a, b = peaks.alias("a"), peaks.alias("b")
    met = a.join(b, (F.col("a.mz") == F.col("b.mz")) & (F.col("a.id") < F.col("b.id"))).groupBy(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).agg(F.count("*").alias("common"))
    met = met.join(n.select(F.col("id").alias("id_a"), F.col("n").alias("n_a")), "id_a").join(n.select(F.col("id").alias("id_b"), F.col("n").alias("n_b")), "id_b")
    return met.select("id_a", "id_b", F.least(F.lit(1.0), 2 * F.col("common") / (F.col("n_a") + F.col("n_b"))).alias("share"))


def binned_correlation(peaks: DataFrame, n_bins: int) -> DataFrame:
    """id_a < id_b, corr: of intensities over n_bins bins of m/z (0 where a spectrum has no peak), for pairs with a bin in common."""
    own = peaks.groupBy("id").agg(F.sum("intensity").alias("s"), F.sum(F.col("intensity") * F.col("intensity")).alias("q"))
    a, b = peaks.alias("a"), peaks.alias("b")
    met = a.join(b, (F.col("a.mz") == F.col("b.mz")) & (F.col("a.id") < F.col("b.id"))).groupBy(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).agg(F.sum(F.col("a.intensity") * F.col("b.intensity")).alias("p"))
    side = lambda s: own.select(F.col("id").alias(f"id_{s}"), F.col("s").alias(f"s_{s}"), F.col("q").alias(f"q_{s}"))
    met = met.join(side("a"), "id_a").join(side("b"), "id_b")
    spread = lambda s: F.col(f"q_{s}") - F.col(f"s_{s}") * F.col(f"s_{s}") / n_bins
    both = F.sqrt(spread("a") * spread("b"))
    return met.select("id_a", "id_b", F.when((spread("a") > 0) & (spread("b") > 0), (F.col("p") - F.col("s_a") * F.col("s_b") / n_bins) / both).alias("corr"))


def window_merged(peaks: DataFrame, width: float) -> DataFrame:
    """id, mz, intensity, n: peaks (id, mz, intensity) of fixed windows of m/z as one each, at their mean m/z by intensity."""
    return peaks.groupBy("id", F.floor(F.col("mz") / width).alias("_w")).agg((F.sum(F.col("mz") * F.col("intensity")) / F.sum("intensity")).alias("mz"), F.sum("intensity").alias("intensity"), F.count("*").alias("n")).drop("_w")


def mixed_estimate(peaks: DataFrame, spectra: DataFrame, tolerance: float, least: float = 0.1) -> DataFrame:
    """The shared proportion where it is below `least`, else the exact cosine: id_a, id_b, similarity."""
    rough = shared_proportion(peaks)
    low = rough.where(F.col("share") < least).select("id_a", "id_b", F.col("share").alias("similarity"))
    side = lambda s: spectra.select(F.col("id").alias(f"id_{s}"), F.col("peaks").alias(f"peaks_{s}"))
    high = rough.where(F.col("share") >= least).join(side("a"), "id_a").join(side("b"), "id_b")
    return low.unionByName(high.select("id_a", "id_b", F.least(F.lit(1.0), cosine_of(F.col("peaks_a"), F.col("peaks_b"), tolerance)).alias("similarity")))


def aggregated_after_merge(pairs: DataFrame, membership: DataFrame) -> DataFrame:
    """Pairs between representatives: the largest cosine of any members. membership: id, rep."""
    rep = lambda s: membership.select(F.col("id").alias(f"id_{s}"), F.col("rep").alias(f"rep_{s}"))
    met = pairs.join(rep("a"), "id_a", "left").join(rep("b"), "id_b", "left").select(F.coalesce("rep_a", "id_a").alias("x"), F.coalesce("rep_b", "id_b").alias("y"), "cosine")
    met = met.where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "cosine")
    return met.groupBy("id_a", "id_b").agg(F.max("cosine").alias("cosine"))
