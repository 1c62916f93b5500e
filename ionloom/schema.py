"""The data model: long tables with fixed schemas; wide tables exist only at sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PEAK = T.StructType([T.StructField("mz", T.DoubleType()), T.StructField("intensity", T.DoubleType())])
PEAKS = T.ArrayType(PEAK)

SPECTRUM = T.StructType([
    T.StructField("scans", T.LongType()), T.StructField("precursor_mz", T.DoubleType()), T.StructField("rt", T.DoubleType()),
    T.StructField("rt_min", T.DoubleType()), T.StructField("rt_max", T.DoubleType()), T.StructField("peak_id", T.StringType()),
    T.StructField("peak_area", T.DoubleType()), T.StructField("precursor_intensity", T.DoubleType()), T.StructField("num_peaks", T.IntegerType()),
    T.StructField("cluster_size", T.IntegerType()), T.StructField("charge", T.IntegerType()), T.StructField("base_peak_int", T.DoubleType()),
    T.StructField("title", T.StringType()), T.StructField("peaks", PEAKS),
])

MS1_PEAK = "peak_id string, sample string, mz double, mz_min double, mz_max double, rt double, rt_min double, rt_max double, area double"
CLUSTER_MEMBER = "cluster_id bigint, sample string, scan bigint, peak_id string, peak_area double, base_peak_int double"
RULES = "ion string, mzdiff double, charge int, neutral_loss_h2o int, neutral_loss_nh3 int, neutral_loss int, sim_cutoff double"

# Fixed values.
SAMPLE_TYPES = ("blank", "sample", "control", "bed", "hit")
MANDATORY_METADATA = ("filename", "sample_code", "data_collection_batch", "sample_type")
BASELINE_RT = (0.0, 1_000_000.0)  # the interval of a blank's baseline, in seconds; it absorbs others when rows merge
PROTON_ELECTRON = 1.00783
ISOTOPE_STEP = 1.0033

# Defaults of parameters.
FRAGMENT_TOLERANCE, MZ_TOLERANCE, RT_TOLERANCES = 0.05, 0.025, (1.0, 2.0)
SIMILARITY, SIMILARITY_BLANK, SIMILARITY_NETWORK = 0.55, 0.3, 0.6
TOP_K, MAX_COMPONENT, MIN_MATCHED = 15, 200, 6
SCALE_FACTOR, MAX_SHIFT, BFLAG_FACTOR = 0.5, 200.0, 1.5


def is_baseline(rt_min: Column, rt_max: Column) -> Column:
    return (rt_min == BASELINE_RT[0]) & (rt_max == BASELINE_RT[1])


def checked_metadata(raw: DataFrame) -> DataFrame:
    """Sample metadata with prefix families as maps: bioactivity (double), cor (boolean), gr (string).

    Column names are upper-cased first. A missing column, a code that isn't unique or isn't a plain name, an unknown
    sample type and batches that aren't numbered from 1 fail when rows are read.
    """
    upper = raw.toDF(*[c.upper() for c in raw.columns])
    missing = [c for c in MANDATORY_METADATA if c.upper() not in upper.columns]
    if missing:
        raise ValueError(f"metadata lacks {', '.join(missing)}")

    def family(prefix: str, kind: str) -> Column:
        own = [c for c in upper.columns if c.startswith(prefix)]
        if not own:
            return F.lit(None).cast(f"map<string,{kind}>")
        return F.map_from_arrays(F.array(*[F.lit(c.removeprefix(prefix)) for c in own]), F.array(*[F.expr(f"try_cast(`{c}` as {kind})") for c in own]))

    code, kind = F.col("SAMPLE_CODE"), F.lower("SAMPLE_TYPE")
    fail = lambda message: F.raise_error(F.concat(F.lit(message), F.coalesce(code, F.lit("null")))).cast("string")
    name = F.when(code.rlike(r"^[A-Za-z.][A-Za-z0-9._]*$"), code).otherwise(fail("not a plain sample code: "))
    rows = upper.select(
        F.col("FILENAME").alias("filename"), name.alias("sample_code"), F.col("DATA_COLLECTION_BATCH").cast("int").alias("batch"),
        F.when(kind.isin(*SAMPLE_TYPES), kind).otherwise(fail("unknown sample type of ")).alias("sample_type"),
        family("BIOACTIVITY_", "double").alias("bioactivity"), family("COR_", "boolean").alias("cor"), family("GR_", "string").alias("gr"),
    )
    bounds = rows.agg(F.count("*").alias("n"), F.count_distinct("sample_code").alias("codes"), F.max("batch").alias("last"), F.count_distinct("batch").alias("batches"), F.min("batch").alias("first"))
    sound = (F.col("n") == F.col("codes")) & (F.col("first") == 1) & (F.col("last") == F.col("batches"))
    checked = rows.join(F.broadcast(bounds.select(sound.alias("sound"))))
    return checked.withColumn("sample_code", F.when(F.col("sound"), F.col("sample_code")).otherwise(F.raise_error(F.lit("sample codes repeat, or batches aren't 1..k")).cast("string"))).drop("sound")
