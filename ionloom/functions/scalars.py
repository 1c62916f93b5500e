"""Column functions of spectra and annotations; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_float32(mz: Column) -> Column:
    """A peak's m/z as a reader keeps it: rounded to single precision."""
    return mz.cast("float").cast("double")


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def scaled(intensity: Column, factor: float) -> Column:
    """ln(1 + x) + 1 for factor 0, else x to the power of factor."""
    return F.log1p(intensity) + 1 if factor == 0 else F.pow(intensity, F.lit(factor))


def unscaled(intensity: Column, factor: float, digits: int = 5) -> Column:
    return F.bround(F.expm1(intensity - 1) if factor == 0 else F.pow(intensity, F.lit(1.0 / factor)), digits)


def scaled_peaks(peaks: Column, factor: float) -> Column:
    return F.transform(peaks, lambda p: F.struct(p["mz"].alias("mz"), scaled(p["intensity"], factor).alias("intensity")))


def unscaled_peaks(peaks: Column, factor: float) -> Column:
    return F.transform(peaks, lambda p: F.struct(p["mz"].alias("mz"), unscaled(p["intensity"], factor).alias("intensity")))


def rmse(a_min: Column, a_max: Column, b_min: Column, b_max: Column) -> Column:
    """Root mean square of how far two intervals' bounds lie apart."""
    return F.sqrt((F.pow(a_min - b_min, 2) + F.pow(a_max - b_max, 2)) / 2)


def aligned(a: str, b: str, rt_tolerance: float) -> Column:
    """Centres within 4 tolerances, or bounds within 2."""
    c = lambda side, name: F.col(f"{side}.{name}")
    near = F.abs(c(a, "rt_mean") - c(b, "rt_mean")) <= 4 * rt_tolerance
    return near | (rmse(c(a, "rt_min"), c(a, "rt_max"), c(b, "rt_min"), c(b, "rt_max")) <= 2 * rt_tolerance)


def peaks_near(peaks: Column, mz: Column, tolerance: float) -> Column:
    return F.exists(peaks, lambda p: F.abs(p["mz"] - mz) <= tolerance)


def filtered_for_annotation(peaks: Column, precursor: Column, cutoff: float, isotope_step: float) -> Column:
    """Peaks away from the precursor that reach the cutoff; where none does, the three strongest."""
    away = F.filter(peaks, lambda p: F.abs(p["mz"] - precursor) > 2 * isotope_step)
    strong = F.filter(away, lambda p: p["intensity"] >= cutoff)
    ranked = F.array_sort(away, lambda p, q: F.when(p["intensity"] > q["intensity"], -1).when(p["intensity"] < q["intensity"], 1).when(p["mz"] < q["mz"], -1).when(p["mz"] > q["mz"], 1).otherwise(0))
    return F.when(F.size(strong) > 0, strong).otherwise(F.slice(ranked, 1, 3))


def display_filter(peaks: Column, least_share: float = 0.0, mz_from: float = 0.0, mz_to: float = 1e9, top: int = 1 << 30) -> Column:
    """Peaks by share of the strongest, m/z range and rank, in m/z order."""
    base = F.array_max(F.transform(peaks, lambda p: p["intensity"]))
    kept = F.filter(peaks, lambda p: (p["intensity"] >= base * least_share) & (p["mz"] >= mz_from) & (p["mz"] <= mz_to))
    by_strength = F.array_sort(F.transform(kept, lambda p: F.struct((-p["intensity"]).alias("k"), p["mz"].alias("mz"), p["intensity"].alias("intensity"))))
    return F.array_sort(F.transform(F.slice(by_strength, 1, top), lambda p: F.struct(p["mz"].alias("mz"), p["intensity"].alias("intensity"))))


def annotation_text(ann: Column, sim: Column, mz_error: Column, rt_error: Column, variant: Column, n_common: Column) -> Column:
    """ann (sim s - mzE e - rtE r)[id]{n}"""
    return F.format_string("%s (sim %s - mzE %s - rtE %s)[%s]{%s}", ann, sim.cast("string"), F.bround(mz_error, 5).cast("string"), rt_error.cast("string"), F.trim(variant.cast("string")), n_common.cast("string"))


ANNOTATION = r"^(.*) \(sim (\S+) - mzE (\S+) - rtE (\S+)\)\[([^\]]*)\]\{(\d+)\}$"


def parsed_annotation(text: Column) -> Column:
    """The struct that annotation_text() spelled out."""
    part = lambda k: F.regexp_extract(text, ANNOTATION, k)
    return F.struct(part(1).alias("ann"), part(2).cast("double").alias("sim"), part(3).cast("double").alias("mz_error"), part(4).cast("double").alias("rt_error"), part(5).alias("variant"), part(6).cast("int").alias("n_common"))


def joined_text(values: Column) -> Column:
    """Lists as text, only at sinks."""
    return F.array_join(values, ";")


def p_value(cdf: Column, n: Column) -> Column:
    """Of a best similarity among n comparisons: 1 - (1 - cdf) ** n."""
    return 1 - F.exp(n * F.log(1 - cdf))
