"""MGF spectra: a text source with one row a spectrum, parsed in the JVM, and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ionloom.functions.scalars import unscaled_peaks

END = "END IONS"
_PEAK_LINE = r"^\s*[-+0-9.][-+0-9.eE]*\s+[-+0-9.][-+0-9.eE]*"


def parsed(value: Column, with_peaks: bool = True) -> list[Column]:
    """Columns of a spectrum's text. Peaks are single-precision numbers; one without mass or intensity ends the list.

    Missing numbers are -1, as is a base peak without peaks; a spectrum without scan or precursor mass fails.
    """
    tag = lambda name: F.nullif(F.trim(F.regexp_extract(value, rf"(?m)^\s*{name}=(.*?)\s*$", 1)), F.lit(""))
    number = lambda name, kind="double": F.coalesce(F.nullif(F.regexp_extract(tag(name), r"^([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)", 1), F.lit("")).cast(kind), F.lit(-1).cast(kind))
    needed = lambda name, pattern, kind: F.coalesce(F.nullif(F.regexp_extract(tag(pattern), r"^([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)", 1), F.lit("")).cast(kind), F.raise_error(F.lit(f"a spectrum without {name}")).cast(kind))
    lines = F.filter(F.split(value, r"\r?\n"), lambda x: x.rlike(_PEAK_LINE))
    pairs = F.transform(lines, lambda x: F.split(F.trim(x), r"\s+"))
    peaks = F.transform(pairs, lambda x: F.struct(x[0].cast("float").cast("double").alias("mz"), x[1].cast("float").cast("double").alias("intensity")))
    bad = F.array_position(F.transform(peaks, lambda p: (p["mz"] <= 0) | (p["intensity"] <= 0)), True)
    peaks = F.array_sort(F.when(bad > 0, F.slice(peaks, 1, (bad - 1).cast("int"))).otherwise(peaks))
    out = [
        needed("scan number", "SCANS?", "long").alias("scans"), needed("precursor mass", "PEPMASS", "double").alias("precursor_mz"), number("RTINSECONDS").alias("rt"),
        number("RTMIN").alias("rt_min"), number("RTMAX").alias("rt_max"), F.coalesce(tag("PEAK_ID"), F.lit("")).alias("peak_id"), number("PEAK_AREA").alias("peak_area"),
        number("PRECURSOR_INTENSITY").alias("precursor_intensity"), number("NUM_PEAKS", "int").alias("num_peaks"), number("CLUSTER_SIZE", "int").alias("cluster_size"),
        number("CHARGE", "int").alias("charge"), F.coalesce(F.array_max(F.transform(peaks, lambda p: p["intensity"])), F.lit(-1.0)).alias("base_peak_int"), tag("TITLE").alias("title"),
    ]
    return [*out, peaks.alias("peaks")] if with_peaks else out


def read_mgf(spark: SparkSession, path: str, with_peaks: bool = True) -> DataFrame:
    """Spectra of MGF files, with `file`. Files are split like any text; a spectrum is a record."""
    raw = spark.read.option("lineSep", END).text(path).where(F.col("value").contains("BEGIN IONS"))
    return raw.select(*parsed(F.col("value"), with_peaks), F.input_file_name().alias("file"))


def spectrum_text(columns: list[str]) -> Column:
    """One spectrum as MGF text; absent columns leave their lines out."""
    line = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}="), F.col(c).cast("string")))
    tags = (("SCANS", "scans"), ("TITLE", "title"), ("PEPMASS", "precursor_mz"), ("RTINSECONDS", "rt"), ("RTMIN", "rt_min"), ("RTMAX", "rt_max"), ("PEAK_ID", "peak_id"), ("PEAK_AREA", "peak_area"), ("PRECURSOR_INTENSITY", "precursor_intensity"), ("CLUSTER_SIZE", "cluster_size"))
    charge = [F.when(F.col("charge").isNotNull(), F.concat(F.lit("CHARGE="), F.abs("charge").cast("string"), F.when(F.col("charge") < 0, "-").otherwise("+")))] if "charge" in columns else []
    rows = F.array_join(F.transform("peaks", lambda p: F.concat(p["mz"].cast("string"), F.lit(" "), p["intensity"].cast("string"))), "\n")
    return F.concat_ws("\n", F.lit("BEGIN IONS"), *[line(n, c) for n, c in tags if c in columns], *charge, F.concat(F.lit("NUM_PEAKS="), F.size("peaks").cast("string")), rows, F.lit("END IONS\n"))


def write_mgf(spectra: DataFrame, path: str) -> None:
    """Text files of spectra: without peaks of no intensity, without empty spectra; a time outside its range widens it by half a second."""
    kept = spectra.withColumn("peaks", F.filter("peaks", lambda p: p["intensity"] > 0)).where(F.size("peaks") > 0)
    if {"rt", "rt_min", "rt_max"} <= set(kept.columns):
        low, high = F.when(F.col("rt") < F.col("rt_min"), F.col("rt") - 0.5).otherwise(F.col("rt_min")), F.when(F.col("rt") > F.col("rt_max"), F.col("rt") + 0.5).otherwise(F.col("rt_max"))
        kept = kept.withColumns({"rt_min": low, "rt_max": high})
    if "title" in kept.columns:
        kept = kept.withColumn("title", F.substring("title", 1, 200))
    kept.select(spectrum_text(kept.columns).alias("value")).write.text(path)


def write_clusters_mgf(clusters: DataFrame, path: str, factor: float) -> None:
    """A count table's spectra (id, precursor_mz, peaks, ...) with their intensities unscaled."""
    write_mgf(clusters.withColumn("peaks", unscaled_peaks(F.col("peaks"), factor)).withColumnRenamed("id", "scans"), path)
