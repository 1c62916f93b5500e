"""Views of the star schema as spectra, members, clusters and samples: whole tables, integer masses where kernels are checked by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def members(spark: SparkSession, d: str) -> DataFrame:
    """Line items as cluster members: 200 clusters by part, 8 samples by supplier."""
    return table(spark, d, "lineitem").select(
        (F.col("l_partkey") % 200).alias("cluster_id"), F.concat(F.lit("S"), (F.col("l_suppkey") % 8).cast("string")).alias("sample"), F.col("l_orderkey").alias("scan"),
        F.col("l_extendedprice").alias("peak_area"), F.col("l_quantity").alias("base_peak_int"), F.col("l_partkey").alias("sub_id"),
    )


MEMBERS = "SELECT l_partkey % 200 AS cluster_id, 'S' || CAST(l_suppkey % 8 AS VARCHAR) AS sample, l_orderkey AS scan, l_extendedprice AS peak_area, l_quantity AS base_peak_int, l_partkey AS sub_id FROM lineitem"


def clusters(spark: SparkSession, d: str) -> DataFrame:
    """Parts as clusters: mass by price, retention by size, flags by key."""
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.alias("id"), F.col("p_retailprice").alias("mz"), (F.col("p_size") * 10.0).alias("rt_mean"), (F.col("p_size") * 10.0 - k % 5).alias("rt_min"), (F.col("p_size") * 10.0 + k % 7).alias("rt_max"),
        F.when(k % 10 == 0, 3).otherwise(0).cast("long").alias("blanks_total"), F.when(k % 11 == 0, 2).otherwise(0).cast("long").alias("controls_total"), F.when(k % 13 == 0, 1).otherwise(0).cast("long").alias("beds_total"),
        (k % 100 + 1).cast("double").alias("sum_ints"), ((k * 37) % 1000).cast("double").alias("base_peak_int"), (k % 9 + 1).cast("long").alias("num_spectra"), (k % 10 == 0).alias("bflag"),
        F.array(F.concat((k % 50).cast("string"), F.lit("_S"), (k % 3).cast("string")), F.when(k % 4 == 0, F.concat(F.lit("fake_S"), (k % 5).cast("string"))).otherwise(F.concat((k % 20).cast("string"), F.lit("_S"), (k % 4).cast("string")))).alias("peak_ids"),
    )


CLUSTERS = """SELECT p_partkey AS id, p_retailprice AS mz, p_size * 10.0::DOUBLE AS rt_mean, p_size * 10.0::DOUBLE - p_partkey % 5 AS rt_min, p_size * 10.0::DOUBLE + p_partkey % 7 AS rt_max,
 CASE WHEN p_partkey % 10 = 0 THEN 3 ELSE 0 END AS blanks_total, CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 0 END AS controls_total, CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END AS beds_total,
 CAST(p_partkey % 100 + 1 AS DOUBLE) AS sum_ints, CAST((p_partkey * 37) % 1000 AS DOUBLE) AS base_peak_int, p_partkey % 9 + 1 AS num_spectra, p_partkey % 10 = 0 AS bflag,
 [CAST(p_partkey % 50 AS VARCHAR) || '_S' || CAST(p_partkey % 3 AS VARCHAR), CASE WHEN p_partkey % 4 = 0 THEN 'fake_S' || CAST(p_partkey % 5 AS VARCHAR) ELSE CAST(p_partkey % 20 AS VARCHAR) || '_S' || CAST(p_partkey % 4 AS VARCHAR) END] AS peak_ids FROM part"""


def peaks(spark: SparkSession, d: str) -> DataFrame:
    """300 spectra by supplier and return flag: integer masses by part and spectrum, integer intensities by price."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    own = table(spark, d, "lineitem").select(((F.col("l_suppkey") % 100) * 3 + flag).alias("id"), "l_partkey", F.floor("l_extendedprice").alias("v"))
    own = own.withColumn("mz", (((F.col("l_partkey") % 40) * (F.col("id") % 5 + 1)) % 120 + 10).cast("double"))
    return own.groupBy("id", "mz").agg(F.sum("v").cast("double").alias("intensity"))


PEAKS = """SELECT id, CAST(((p % 40) * (id % 5 + 1)) % 120 + 10 AS DOUBLE) AS mz, CAST(sum(v) AS DOUBLE) AS intensity FROM (SELECT (l_suppkey % 100) * 3 + CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS id, l_partkey AS p,
 CAST(floor(l_extendedprice) AS BIGINT) AS v FROM lineitem) GROUP BY 1, 2"""


def spectra(spark: SparkSession, d: str) -> DataFrame:
    """The same spectra as arrays, with a precursor."""
    rows = peaks(spark, d).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("mz", "intensity"))).alias("peaks"))
    return rows.select("id", (F.col("id") % 40 + 20).cast("double").alias("precursor_mz"), "peaks")


def cosines(spark: SparkSession, d: str) -> DataFrame:
    """id_a, id_b, cosine in thousandths (exact in both engines), matched, n_peaks_a, n_peaks_b."""
    from ionloom.operators.similarity import binned_cosine

    own = peaks(spark, d)
    n = own.groupBy("id").agg(F.count("*").alias("n"))
    side = lambda s: n.select(F.col("id").alias(f"id_{s}"), F.col("n").alias(f"n_peaks_{s}"))
    return binned_cosine(own).withColumn("cosine", F.floor(F.col("cosine") * 1000 + 0.5) / 1000).join(side("a"), "id_a").join(side("b"), "id_b").select("id_a", "id_b", "cosine", "matched", "n_peaks_a", "n_peaks_b")


COSINES = f"""WITH pk AS MATERIALIZED ({PEAKS}), nm AS (SELECT id, sum(intensity * intensity) AS n2, count(*) AS n FROM pk GROUP BY id),
 top AS (SELECT a.id AS id_a, b.id AS id_b, sum(a.intensity * b.intensity) AS t, count(*) AS matched FROM pk a JOIN pk b ON a.mz = b.mz AND a.id < b.id GROUP BY 1, 2),
 cos AS MATERIALIZED (SELECT id_a, id_b, floor(t / sqrt(x.n2 * y.n2) * 1000 + 0.5) / 1000 AS cosine, matched, x.n AS n_peaks_a, y.n AS n_peaks_b FROM top JOIN nm x ON x.id = id_a JOIN nm y ON y.id = id_b)"""


def metadata(spark: SparkSession) -> DataFrame:
    """The eight samples: types, two batches, a bioactivity, a correlation group."""
    rows = [(f"f{k}", f"S{k}", 1 + k % 2, ("blank", "control", "bed", "hit", "sample", "sample", "sample", "sample")[k], {"bio": float((k * 7) % 5)}, {"all": True, "some": k > 2}, {"size": "odd" if k % 2 else "even"}) for k in range(8)]
    return spark.createDataFrame(rows, "filename string, sample_code string, batch int, sample_type string, bioactivity map<string,double>, cor map<string,boolean>, gr map<string,string>")


METADATA = "SELECT 'S' || CAST(k AS VARCHAR) AS sample, 1 + k % 2 AS batch, ['blank','control','bed','hit','sample','sample','sample','sample'][k + 1] AS sample_type, CAST((k * 7) % 5 AS DOUBLE) AS bio, CASE WHEN k % 2 = 1 THEN 'odd' ELSE 'even' END AS tag FROM range(8) t(k)"
