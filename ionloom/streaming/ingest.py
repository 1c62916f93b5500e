"""Spectra that arrive as files: a streaming source, and quantification that grows with each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ionloom.operators.quant import quantify
from ionloom.sources.mgf import END, parsed


def stream_spectra(spark: SparkSession, folder: str, most_files: int = 64) -> DataFrame:
    """Spectra of MGF files as they come into a folder."""
    raw = spark.readStream.option("lineSep", END).option("maxFilesPerTrigger", most_files).text(folder)
    return raw.where(F.col("value").contains("BEGIN IONS")).select(*parsed(F.col("value")), F.col("_metadata.file_name").alias("file"))


def quantify_stream(spectra: DataFrame, mz_tolerance: float, out: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's counts by rounded mass and file to a Parquet table; a batch that is run again replaces its own."""

    def add(batch: DataFrame, number: int) -> None:
        members = batch.select(F.bround(F.col("precursor_mz") / mz_tolerance).cast("long").alias("cluster_id"), F.col("file").alias("sample"), F.col("peak_area"))
        quantify(members).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spectra.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, watermark: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Windowed counts and sums of an event stream (ts, event_type, value), late events dropped behind the watermark."""
    return events.withWatermark("ts", watermark).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
