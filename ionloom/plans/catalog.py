"""All queries of the engine by name: the operators on views of the star schema, and SQL for those that SQL expresses."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ionloom.functions import kernels as K, scalars as S, stats
from ionloom.operators import annotate, correlation, graph, islands, joins, library, preprocess, quant, similarity
from ionloom.plans.lenses import CLUSTERS, COSINES, MEMBERS, METADATA, PEAKS, clusters, cosines, members, metadata, peaks, spectra, table
from ionloom.sources.mgf import read_mgf, write_mgf
from ionloom.streaming.ingest import event_counts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
SAMPLES = [f"S{k}" for k in range(8)]
_QUANT = f"SELECT cluster_id, sample, count(*) AS n_spectra, CAST(sum(DISTINCT floor(peak_area)) AS DOUBLE) AS area FROM ({MEMBERS}) GROUP BY 1, 2"
_FOURTH = lambda x: F.floor(x * 1e4 + 0.5) / 1e4


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import ionloom.plans.more  # noqa: F401  registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    import ionloom.plans.more  # noqa: F401

    return dict(_SQL)


# Quantification ---------------------------------------------------------------------------------------------------------


@query("SELECT cluster_id, " + ", ".join(f"count(*) FILTER (sample = '{s}') AS \"{s}_spectra\"" for s in SAMPLES) + f" FROM ({MEMBERS}) GROUP BY 1")
def quant_spectra_pivot(spark, d):
    return quant.pivoted(quant.quantify(members(spark, d)), "cluster_id", "sample", SAMPLES, area=False)


@query(_QUANT)
def quant_area_distinct(spark, d):
    return quant.quantify(members(spark, d))


@query(f"SELECT cluster_id, max(base_peak_int) AS base_peak_int FROM ({MEMBERS}) GROUP BY 1")
def base_peak(spark, d):
    return quant.base_peaks(members(spark, d))


@query(f"WITH q AS (SELECT sub_id, sample, count(*) AS n, sum(DISTINCT floor(peak_area)) AS a FROM ({MEMBERS}) GROUP BY 1, 2) SELECT sub_id % 200 AS cluster_id, sample, CAST(sum(n) AS BIGINT) AS n_spectra, CAST(sum(a) AS DOUBLE) AS area FROM q GROUP BY 1, 2")
def quant_rollup(spark, d):
    own = members(spark, d)
    parts = quant.quantify(own, cluster="sub_id")
    return quant.rolled_up(parts, own.select("sub_id", "cluster_id").distinct())


@query(f"SELECT cluster_id, tag, sum(area) AS area FROM ({_QUANT}) JOIN ({METADATA}) USING (sample) GROUP BY 1, 2")
def group_sum(spark, d):
    tags = metadata(spark).select(F.col("sample_code").alias("sample"), F.explode("gr").alias("g", "tag")).drop("g")
    return quant.group_sums(quant.quantify(members(spark, d)), tags)


@query(f"SELECT cluster_id, CAST(coalesce(sum(n_spectra) FILTER (sample_type = 'blank'), 0) AS BIGINT) AS blanks_total, CAST(coalesce(sum(n_spectra) FILTER (sample_type = 'control'), 0) AS BIGINT) AS controls_total, CAST(coalesce(sum(n_spectra) FILTER (sample_type = 'bed'), 0) AS BIGINT) AS beds_total FROM ({_QUANT}) JOIN ({METADATA}) USING (sample) GROUP BY 1")
def type_totals(spark, d):
    types = metadata(spark).select(F.col("sample_code").alias("sample"), "sample_type")
    return quant.type_totals(quant.quantify(members(spark, d)), types)


@query(f"WITH c AS ({CLUSTERS}) SELECT id, EXISTS (SELECT 1 FROM c b WHERE b.blanks_total > 0 AND abs(c.mz - b.mz) <= 0.025) AS bflag, EXISTS (SELECT 1 FROM c b WHERE b.controls_total > 0 AND abs(c.mz - b.mz) <= 0.025) AS cflag, EXISTS (SELECT 1 FROM c b WHERE b.beds_total > 0 AND abs(c.mz - b.mz) <= 0.025) AS bedflag FROM c")
def flag_near_mass(spark, d):
    return quant.near_flags(clusters(spark, d).drop("bflag"), 0.025).select("id", "bflag", "cflag", "bedflag")


@query(f"WITH c AS ({CLUSTERS}), h AS (SELECT DISTINCT 'S' || CAST(id % 3 AS VARCHAR) AS sample, mz FROM c WHERE base_peak_int > 940) SELECT id, (SELECT string_agg(s, ';' ORDER BY s) FROM (SELECT DISTINCT sample AS s FROM h WHERE abs(h.mz - c.mz) <= 0.05)) AS hflag FROM c")
def hit_samples(spark, d):
    own = clusters(spark, d)
    hits = own.where("base_peak_int > 940").select(F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("sample"), "mz")
    return quant.hit_samples(own.select("id", "mz"), hits, 0.05).select("id", F.array_join("hflag", ";").alias("hflag"))


@query(f"WITH c AS ({CLUSTERS}), q AS (SELECT quantile_cont(base_peak_int, 0.5) + 0.25 * (quantile_cont(base_peak_int, 0.75) - quantile_cont(base_peak_int, 0.25)) AS cutoff FROM c WHERE blanks_total > 0) SELECT id, base_peak_int FROM c, q WHERE base_peak_int > cutoff")
def noise_filter(spark, d):
    return quant.noise_filtered(clusters(spark, d), 0.25, F.col("blanks_total") > 0).select("id", "base_peak_int")


@query("SELECT l_returnflag, floor(quantile_cont(l_extendedprice, 0.25) * 1e3 + 0.25) / 1e3 AS q1, floor(quantile_cont(l_extendedprice, 0.5) * 1e3 + 0.25) / 1e3 AS median, floor(quantile_cont(l_extendedprice, 0.75) * 1e3 + 0.25) / 1e3 AS q3 FROM lineitem GROUP BY 1")
def iqr_cutoff(spark, d):
    third = lambda c: (F.floor(F.col(c) * 1e3 + 0.25) / 1e3).alias(c)
    return stats.quartiles(table(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"]).select("l_returnflag", third("q1"), third("median"), third("q3"))


@query(f"SELECT count(DISTINCT id) AS n_clusters, count(*) FILTER (blanks_total = 0) AS n_not_blank, CAST(sum(num_spectra) AS BIGINT) AS n_spectra, count(DISTINCT floor(mz)) AS n_masses FROM ({CLUSTERS})")
def quality_statistics(spark, d):
    own = clusters(spark, d).withColumn("mz", F.floor("mz").cast("double"))
    return quant.quality_statistics(own, "num_spectra").select("n_clusters", "n_not_blank", "n_spectra", "n_masses")


@query(f"SELECT num_spectra AS size, count(*) AS n_clusters FROM ({CLUSTERS}) GROUP BY 1")
def size_histogram(spark, d):
    return quant.size_histogram(clusters(spark, d), "num_spectra")


@query(f"""WITH p AS (SELECT id, unnest(peak_ids) AS peak FROM ({CLUSTERS})), s AS (SELECT id, regexp_extract(peak, '^[^_]*_(.*)$', 1) AS sample, count(*) FILTER (NOT starts_with(peak, 'fake_')) AS r, count(*) FILTER (starts_with(peak, 'fake_')) AS f FROM p GROUP BY 1, 2)
SELECT id, count(*) AS n_samples, count(*) FILTER (r > 1) AS n_samples_joined, CAST(sum(r) AS BIGINT) AS n_real, CAST(sum(f) AS BIGINT) AS n_fake FROM s GROUP BY 1""")
def isomer_diagnostics(spark, d):
    return quant.isomer_diagnostics(clusters(spark, d))


@query(f"WITH m AS (SELECT DISTINCT mz FROM ({CLUSTERS}) WHERE blanks_total > 0), n AS (SELECT m.mz, count(c.mz) AS n FROM m LEFT JOIN ({CLUSTERS}) c ON abs(m.mz - c.mz) <= 0.05 GROUP BY 1) SELECT least(n, 301) AS n_peaks, count(*) AS n_masses FROM n GROUP BY 1")
def isomer_histogram(spark, d):
    own = clusters(spark, d)
    return quant.isomer_histogram(own.where("blanks_total > 0"), own, 0.05)


_MERGE = f"SELECT *, id % 300 AS g FROM ({CLUSTERS})"


@query(f"SELECT g, min(id) AS id, floor(sum(mz * sum_ints) / sum(sum_ints) * 100 + 0.5) / 100 AS mz, floor(sum(rt_mean * sum_ints) / sum(sum_ints) * 100 + 0.5) / 100 AS rt_mean, CAST(sum(num_spectra) AS BIGINT) AS num_spectra, sum(sum_ints) AS sum_ints, max(base_peak_int) AS base_peak_int, bool_or(bflag) AS bflag, CAST(sum(blanks_total) AS BIGINT) AS blanks_total FROM ({_MERGE}) GROUP BY 1")
def merge_clean(spark, d):
    own = clusters(spark, d).withColumn("g", F.col("id") % 300).drop("peak_ids", "controls_total", "beds_total", "rt_min", "rt_max")
    third = lambda c: (F.floor(F.col(c) * 100 + 0.5) / 100).alias(c)
    return quant.merged(own, "g").select("g", "id", third("mz"), third("rt_mean"), "num_spectra", "sum_ints", "base_peak_int", "bflag", "blanks_total")


@query(f"SELECT g, min(id) AS id, arg_min(mz, id) AS mz, arg_min(rt_mean, id) AS rt_mean, CAST(sum(num_spectra) AS BIGINT) AS num_spectra, sum(sum_ints) AS sum_ints, max(base_peak_int) AS base_peak_int FROM ({_MERGE}) GROUP BY 1")
def merge_symbolic(spark, d):
    own = clusters(spark, d).withColumn("g", F.col("id") % 300).select("g", "id", "mz", "rt_mean", "num_spectra", "sum_ints", "base_peak_int")
    return quant.merged(own, "g", "symbolic")


@query(f"SELECT g, min(id) AS id, CAST(sum(floor(mz)) AS DOUBLE) AS sum_areas, max(base_peak_int) AS base_peak_int FROM ({_MERGE}) GROUP BY 1")
def merge_ms1(spark, d):
    own = clusters(spark, d).select((F.col("id") % 300).alias("g"), "id", F.col("mz").alias("sum_areas"), "base_peak_int")
    return quant.merged(own, "g", "ms1", weight="sum_areas")


# Joins -------------------------------------------------------------------------------------------------------------------


@query(f"WITH s AS (SELECT event_id AS spectrum_id, user_id % 8 AS sample, user_id % 8 = 0 AS is_blank, value AS mz, event_id % 500 AS rt FROM events), p AS (SELECT id AS peak_id, id % 8 AS sample, mz % 100 AS m, rt_mean, rt_min, rt_max, sum_ints AS area FROM ({CLUSTERS})), c AS (SELECT spectrum_id, peak_id, row_number() OVER (PARTITION BY spectrum_id ORDER BY abs(s.rt - p.rt_mean), CAST(peak_id AS VARCHAR)) AS n, count(*) OVER (PARTITION BY spectrum_id) AS k FROM s JOIN p ON s.sample = p.sample AND s.mz BETWEEN m - 0.5 - 0.05 AND m + 0.5 + 0.05 AND s.rt BETWEEN rt_min - 3 AND rt_max + 3) SELECT s.spectrum_id, coalesce(CAST(c.peak_id AS VARCHAR), 'fake_' || CAST(s.sample AS VARCHAR)) AS peak_id, c.peak_id IS NULL AS is_fake, c.peak_id IS NULL AND s.is_blank AS is_baseline, coalesce(c.k, 0) AS n_candidates FROM s LEFT JOIN c ON c.spectrum_id = s.spectrum_id AND n = 1")
def nearest_peak(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("spectrum_id"), (F.col("user_id") % 8).alias("sample"), (F.col("user_id") % 8 == 0).alias("is_blank"), F.col("value").alias("mz"), (F.col("event_id") % 500).cast("double").alias("rt"))
    p = clusters(spark, d).select(F.col("id").cast("string").alias("peak_id"), (F.col("id") % 8).alias("sample"), (F.col("mz") % 100 - 0.5).alias("mz_min"), (F.col("mz") % 100 + 0.5).alias("mz_max"), F.col("rt_mean").alias("rt"), "rt_min", "rt_max", F.col("sum_ints").alias("area"))
    return joins.nearest_peak(e, p, 0.05, 3.0, 6.0).select("spectrum_id", "peak_id", "is_fake", "is_baseline", "n_candidates")


_MEET = "((a.rt_mean BETWEEN b.rt_min - 2 AND b.rt_max + 2) OR (b.rt_mean BETWEEN a.rt_min - 2 AND a.rt_max + 2))"
_ALIGNED = "(abs(a.rt_mean - b.rt_mean) <= 8 OR sqrt(((a.rt_min - b.rt_min) * (a.rt_min - b.rt_min) + (a.rt_max - b.rt_max) * (a.rt_max - b.rt_max)) / 2) <= 4)"


@query(f"WITH c AS ({CLUSTERS}) SELECT a.id AS id_a, b.id AS id_b FROM c a JOIN c b ON a.id < b.id AND abs(a.mz - b.mz) <= 0.5 AND {_MEET} AND (a.bflag OR {_ALIGNED})")
def coelution_pairs(spark, d):
    return joins.coelution_pairs(clusters(spark, d), 0.5, 2.0)


@query(f"WITH c AS (SELECT * FROM ({CLUSTERS}) WHERE blanks_total = 0) SELECT a.id AS id_a, b.id AS id_b FROM c a JOIN c b ON a.id < b.id AND {_MEET} AND {_ALIGNED} AND a.id % 6 = b.id % 6")
def coelution_without_mass(spark, d):
    own = clusters(spark, d).where("blanks_total = 0").withColumn("batches", F.array(F.col("id") % 6)).drop("peak_ids")
    return annotate.coeluting(own, 2.0).select(F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"))


@query(f"WITH c AS ({CLUSTERS}) SELECT a.id AS id_a, b.id AS id_b FROM c a JOIN c b ON a.id < b.id AND abs(a.mz - b.mz) <= 0.1 AND EXISTS (SELECT 1 FROM (SELECT unnest(a.peak_ids) AS p) WHERE NOT starts_with(p, 'fake_') AND list_contains(b.peak_ids, p))")
def shared_peak_ids(spark, d):
    return joins.peak_sharing_pairs(clusters(spark, d), 0.1)


@query(f"SELECT q.cluster_id, q.sample, n_spectra, batch, sample_type FROM ({_QUANT}) q LEFT JOIN ({METADATA}) m USING (sample)")
def metadata_join(spark, d):
    return joins.with_metadata(quant.quantify(members(spark, d)), metadata(spark)).select("cluster_id", "sample", "n_spectra", "batch", "sample_type")


@query("SELECT l_orderkey, l_linenumber, o_custkey, o_totalprice FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND l_linenumber > 0")
def header_lookup(spark, d):
    m = table(spark, d, "lineitem").select(F.lit("all").alias("sample"), F.col("l_orderkey").alias("scan"), "l_linenumber")
    h = table(spark, d, "orders").select(F.lit("all").alias("sample"), F.col("o_orderkey").alias("scan"), "o_custkey", "o_totalprice")
    return joins.header_lookup(m, h).select(F.col("scan").alias("l_orderkey"), "l_linenumber", "o_custkey", "o_totalprice")


@query("SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY round_even(p_retailprice / 0.05, 0) ORDER BY p_partkey) AS n FROM part) WHERE n = 1")
def almost_unique(spark, d):
    return joins.almost_unique(table(spark, d, "part"), "p_retailprice", 0.05, ["p_partkey"]).select("p_partkey")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def dedupe_first(spark, d):
    return joins.first_of_each(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT user_id, event_type, freq FROM (SELECT user_id, event_type, count(*) AS freq, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS n FROM events GROUP BY 1, 2) WHERE n <= 2")
def top_by_frequency(spark, d):
    own = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("freq"))
    return joins.first_of_each(own, ["user_id"], [F.desc("freq"), "event_type"], 2)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT s_nationkey AS nation FROM supplier UNION SELECT c_nationkey FROM customer EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0")
def set_operations(spark, d):
    s, c = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")), table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"))
    return s.unionByName(c).distinct().join(table(spark, d, "nation").where("n_regionkey = 0").select(F.col("n_nationkey").alias("nation")), "nation", "left_anti")


# Spectra -------------------------------------------------------------------------------------------------------------------


@query(COSINES + " SELECT id_a, id_b, cosine, matched FROM cos")
def spectrum_cosine(spark, d):
    return cosines(spark, d).select("id_a", "id_b", "cosine", "matched")


@query(COSINES + " SELECT id_a, id_b, cosine, matched FROM cos WHERE cosine >= 0.1")
def spectrum_cosine_kernel(spark, d):
    own = similarity.pairwise(spectra(spark, d), 0.25, least=0.05, digits=9)
    return own.withColumn("cosine", F.floor(F.col("cosine") * 1000 + 0.5) / 1000).where("cosine >= 0.1").select("id_a", "id_b", "cosine", F.col("matched").cast("long").alias("matched"))


@query(f"""WITH pk AS MATERIALIZED ({PEAKS}), nm AS (SELECT id, sum(intensity * intensity) AS n2 FROM pk GROUP BY id), x AS (SELECT id, mz, intensity, id % 40 + 20 AS p FROM pk),
 m AS (SELECT a.id AS id_a, b.id AS id_b, a.intensity * b.intensity AS v FROM x a JOIN x b ON a.mz = b.mz AND (a.p > b.p OR (a.p = b.p AND a.id > b.id))
 UNION ALL SELECT a.id, b.id, a.intensity * b.intensity FROM x a JOIN x b ON a.mz - a.p = b.mz - b.p AND a.p > b.p WHERE NOT EXISTS (SELECT 1 FROM x c WHERE c.id = b.id AND c.mz = a.mz) AND NOT EXISTS (SELECT 1 FROM x c WHERE c.id = a.id AND c.mz = b.mz))
 SELECT id_a, id_b, floor(sum(v) / sqrt(any_value(na.n2) * any_value(nb.n2)) * 1000 + 0.5) / 1000 AS cosine, count(*) AS matched FROM m JOIN nm na ON na.id = id_a JOIN nm nb ON nb.id = id_b GROUP BY 1, 2""")
def spectrum_cosine_shift(spark, d):
    own = peaks(spark, d)
    precursors = own.select("id").distinct().withColumn("precursor", (F.col("id") % 40 + 20).cast("double"))
    return similarity.binned_shifted_cosine(own, precursors).withColumn("cosine", F.floor(F.col("cosine") * 1000 + 0.5) / 1000)


@query(f"WITH pk AS MATERIALIZED ({PEAKS}), n AS (SELECT id, count(*) AS n FROM pk GROUP BY 1) SELECT id_a, id_b, least(1.0::DOUBLE, 2 * common / CAST(x.n + y.n AS DOUBLE)) AS share FROM (SELECT a.id AS id_a, b.id AS id_b, count(*) AS common FROM pk a JOIN pk b ON a.mz = b.mz AND a.id < b.id GROUP BY 1, 2) JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b")
def shared_proportion(spark, d):
    return similarity.shared_proportion(peaks(spark, d))


@query(COSINES + " SELECT CAST(id_a % 100 AS BIGINT) AS id_a, CAST(id_b % 100 AS BIGINT) AS id_b, max(cosine) AS cosine FROM (SELECT least(id_a % 100, id_b % 100) AS id_a, greatest(id_a % 100, id_b % 100) AS id_b, cosine FROM cos) WHERE id_a <> id_b GROUP BY 1, 2")
def similarity_after_merge(spark, d):
    ids = peaks(spark, d).select("id").distinct().withColumn("rep", F.col("id") % 100)
    return similarity.aggregated_after_merge(cosines(spark, d), ids)


@query("SELECT l_orderkey, l_linenumber, floor(ln(1 + l_extendedprice) * 1e6 + 0.5) / 1e6 + 1 AS log_scaled, floor(sqrt(l_extendedprice) * 1e6 + 0.5) / 1e6 AS root_scaled FROM lineitem")
def intensity_scaling(spark, d):
    mil = lambda x: F.floor(x * 1e6 + 0.5) / 1e6
    x = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (mil(S.scaled(x, 0) - 1) + 1).alias("log_scaled"), mil(S.scaled(x, 0.5)).alias("root_scaled"))


@query(f"WITH pk AS ({PEAKS}), s AS (SELECT id, id % 40 + 20 AS p, mz, intensity, max(intensity) OVER (PARTITION BY id) AS top FROM pk), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY intensity DESC, mz) AS r FROM s WHERE intensity >= 0.4 * top AND mz BETWEEN 15 AND 90) SELECT id, count(*) AS n, min(mz) AS low, max(mz) AS high FROM k WHERE r <= 12 GROUP BY 1")
def display_peaks(spark, d):
    own = spectra(spark, d).select("id", S.display_filter(F.col("peaks"), 0.4, 15.0, 90.0, 12).alias("p")).where(F.size("p") > 0)
    return own.select("id", F.size("p").cast("long").alias("n"), F.element_at("p", 1)["mz"].alias("low"), F.element_at("p", -1)["mz"].alias("high"))


@query(f"WITH pk AS ({PEAKS}), s AS (SELECT * FROM pk WHERE abs(mz - (id % 40 + 20)) > 2 * 1.0033), k AS (SELECT *, intensity >= 60000 AS strong, bool_or(intensity >= 60000) OVER (PARTITION BY id) AS has, row_number() OVER (PARTITION BY id ORDER BY intensity DESC, mz) AS r FROM s) SELECT id, count(*) AS n, sum(intensity) AS total FROM k WHERE CASE WHEN has THEN strong ELSE r <= 3 END GROUP BY 1")
def annotation_peaks(spark, d):
    own = spectra(spark, d).select("id", S.filtered_for_annotation(F.col("peaks"), F.col("precursor_mz"), 60000.0, 1.0033).alias("p")).where(F.size("p") > 0)
    return own.select("id", F.size("p").cast("long").alias("n"), F.aggregate("p", F.lit(0.0), lambda a, x: a + x["intensity"]).alias("total"))


@query("SELECT p_partkey, '[M+H]+ (sim ' || CAST(p_size AS VARCHAR) || ' - mzE ' || CAST(p_partkey % 10 AS VARCHAR) || '.5 - rtE 2.0)[' || CAST(p_partkey AS VARCHAR) || ']{' || CAST(p_size AS VARCHAR) || '}' AS text, CAST(p_size AS DOUBLE) AS sim, p_partkey % 10 + 0.5::DOUBLE AS mz_error, p_size AS n_common FROM part")
def annotation_text(spark, d):
    own = table(spark, d, "part").select("p_partkey", S.annotation_text(F.lit("[M+H]+"), F.col("p_size"), F.col("p_partkey") % 10 + F.lit(0.5), F.lit(2.0), F.col("p_partkey"), F.col("p_size")).alias("text"))
    return own.withColumn("a", S.parsed_annotation(F.col("text"))).select("p_partkey", "text", "a.sim", "a.mz_error", "a.n_common")


@query(f"WITH pk AS MATERIALIZED ({PEAKS}), o AS (SELECT id, sum(intensity) AS s, sum(intensity * intensity) AS q FROM pk GROUP BY 1), m AS (SELECT a.id AS id_a, b.id AS id_b, sum(a.intensity * b.intensity) AS p FROM pk a JOIN pk b ON a.mz = b.mz AND a.id < b.id GROUP BY 1, 2) SELECT id_a, id_b, floor((p - x.s * y.s / 130) / sqrt((x.q - x.s * x.s / 130) * (y.q - y.s * y.s / 130)) * 1e4 + 0.5) / 1e4 AS corr FROM m JOIN o x ON x.id = id_a JOIN o y ON y.id = id_b")
def spectrum_correlation(spark, d):
    return similarity.binned_correlation(peaks(spark, d), 130).withColumn("corr", _FOURTH(F.col("corr")))


@query(f"SELECT id, floor(sum(mz * intensity) / sum(intensity) * 1e4 + 0.5) / 1e4 AS mz, sum(intensity) AS intensity, count(*) AS n FROM ({PEAKS}) GROUP BY id, floor(mz / 5)")
def window_merge(spark, d):
    return similarity.window_merged(peaks(spark, d), 5.0).withColumn("mz", _FOURTH(F.col("mz")))


@query(f"SELECT id AS scans, CAST(id % 40 + 20 AS DOUBLE) AS precursor_mz, count(*) AS n, sum(mz) AS total FROM ({PEAKS}) GROUP BY 1, 2")
def mgf_round_trip(spark, d):
    own = spectra(spark, d).withColumnRenamed("id", "scans")
    path = f"{graph.shared_folder(spark)}/mgf-{uuid.uuid4().hex}"
    write_mgf(own, path)
    return read_mgf(spark, path).select("scans", "precursor_mz", F.size("peaks").cast("long").alias("n"), F.aggregate("peaks", F.lit(0.0), lambda a, x: a + x["mz"]).alias("total"))


@query(COSINES + " SELECT id_a, id_b, matched FROM cos WHERE cosine >= 0.9")
def matched_peak_pairs(spark, d):
    own = spectra(spark, d)
    side = lambda s: own.select(F.col("id").alias(f"id_{s}"), F.col("peaks").alias(f"p_{s}"))
    met = cosines(spark, d).where("cosine >= 0.9").select("id_a", "id_b").join(side("a"), "id_a").join(side("b"), "id_b")
    return met.select("id_a", "id_b", F.size(K.matched_pairs_of(F.col("p_a"), F.col("p_b"), F.lit(0.0), 0.25)).cast("long").alias("matched"))


# Networks ----------------------------------------------------------------------------------------------------------------


@query(COSINES + ", e AS (SELECT id_a, id_b, cosine, matched FROM cos WHERE cosine >= 0.72) SELECT * FROM e UNION ALL SELECT id, id, 1.0, -1 FROM nm WHERE id NOT IN (SELECT id_a FROM e UNION SELECT id_b FROM e)")
def ssmn_threshold(spark, d):
    nodes = peaks(spark, d).select("id").distinct()
    return graph.with_self_loops(graph.thresholded(cosines(spark, d), 0.72), nodes)


@query(COSINES + " SELECT id_a, id_b, cosine, matched FROM cos WHERE NOT (matched < 22 AND (least(n_peaks_a, n_peaks_b) > 22 OR matched < 2))")
def ssmn_min_matched(spark, d):
    return graph.min_matched(cosines(spark, d), 22).select("id_a", "id_b", "cosine", "matched")


@query(COSINES + ", x AS (SELECT id_a AS id, cosine FROM cos UNION ALL SELECT id_b, cosine FROM cos), c AS (SELECT id, cosine AS cut FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC) AS n FROM x) WHERE n = 16) SELECT id_a, id_b, cosine FROM cos LEFT JOIN c p ON p.id = id_a LEFT JOIN c q ON q.id = id_b WHERE (p.cut IS NULL OR cosine > p.cut) AND (q.cut IS NULL OR cosine > q.cut)")
def mutual_topk(spark, d):
    return graph.mutual_top_k(cosines(spark, d), 15).select("id_a", "id_b", "cosine")


_STRONG = ", e AS MATERIALIZED (SELECT id_a AS a, id_b AS b FROM cos WHERE cosine >= 0.78 UNION SELECT id_b, id_a FROM cos WHERE cosine >= 0.78)"
_RECURSIVE = COSINES.replace("WITH pk", "WITH RECURSIVE pk", 1) + _STRONG


@query(_RECURSIVE + ", r(id, root) AS (SELECT id, id FROM nm UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id) SELECT id, min(root) AS component FROM r GROUP BY 1")
def components(spark, d):
    return graph.components(graph.thresholded(cosines(spark, d), 0.78), peaks(spark, d).select("id").distinct())


@query(_RECURSIVE + ", r(id, n) AS (SELECT id, 0 FROM nm WHERE id < 10 UNION SELECT e.b, r.n + 1 FROM r JOIN e ON e.a = r.id WHERE r.n < 3) SELECT id, min(n) AS distance FROM r GROUP BY 1")
def blank_distance(spark, d):
    return graph.distance_from(graph.thresholded(cosines(spark, d), 0.78), peaks(spark, d).where("id < 10").select("id").distinct())


@query()
def prune_components(spark, d):
    return graph.prune_components(graph.thresholded(cosines(spark, d), 0.6), 40).select("id_a", "id_b", "cosine")


@query()
def similarity_network(spark, d):
    return graph.network(cosines(spark, d), peaks(spark, d).select("id").distinct(), 0.6, 6, 15, 200)


def _directed(spark, d):
    """Strong pairs as directed edges, and their nodes."""
    e = graph.mutual_top_k(cosines(spark, d), 4)
    nodes = peaks(spark, d).select("id").distinct()
    touched = e.select(F.col("id_a").alias("id")).unionByName(e.select(F.col("id_b").alias("id"))).distinct()
    own = e.select(F.col("id_b").alias("src"), F.col("id_a").alias("dst"), F.when(F.col("id_a") % 5 == 0, "[M+H-H2O]+").otherwise("[M+Na]+").alias("annotation"), F.abs(F.col("cosine") - 0.5).alias("mz_error"), (F.col("id_b") % 7).cast("double").alias("rt_error"))
    loops = nodes.join(touched, "id", "left_anti").select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit("").alias("annotation"), F.lit(0.0).alias("mz_error"), F.lit(0.0).alias("rt_error"))
    return graph.cut(own.unionByName(loops)), nodes.withColumns({"multicharge_ion": (F.col("id") % 19 == 0).cast("int"), "isotope_ion": (F.col("id") % 23 == 0).cast("int")})


@query()
def protonated_representatives(spark, d):
    return graph.protonated_representatives(*_directed(spark, d))


@query()
def protonated_network(spark, d):
    edges, nodes = _directed(spark, d)
    chosen = graph.protonated_representatives(edges, nodes)
    known = nodes.join(chosen.select("id", "representative"), "id").withColumn("blanks_total", (F.col("id") % 30 == 0).cast("int"))
    return graph.protonated_networks(edges.withColumnsRenamed({"src": "id_a", "dst": "id_b"}), cosines(spark, d), known, 1, 6, 15, 200)[1]


@query(COSINES + ", t AS (SELECT id_a, id_b, 'x' || CAST(id_a % 3 AS VARCHAR) AS annotation FROM cos WHERE matched > 20) SELECT c.id_a, c.id_b, c.cosine, t.annotation FROM cos c LEFT JOIN t USING (id_a, id_b) WHERE c.cosine >= 0.6")
def described_edges(spark, d):
    own = cosines(spark, d)
    texts = own.where("matched > 20").select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"), F.concat(F.lit("x"), (F.col("id_a") % 3).cast("string")).alias("annotation"))
    return graph.described(graph.thresholded(own, 0.6), texts).select("id_a", "id_b", "cosine", "annotation")


# Islands ------------------------------------------------------------------------------------------------------------------


@query(f"WITH c AS ({CLUSTERS}), g AS (SELECT id, mz, CASE WHEN mz - lag(mz) OVER (ORDER BY mz) > 0.0251 THEN 1 ELSE 0 END AS gap FROM c), i AS (SELECT id, mz, sum(gap) OVER (ORDER BY mz RANGE UNBOUNDED PRECEDING) AS i FROM g) SELECT id, min(id) OVER (PARTITION BY i) AS first_id FROM i")
def mass_islands(spark, d):
    own = islands.islands(clusters(spark, d), "mz", 0.025)
    return own.select("id", F.min("id").over(Window.partitionBy("island")).alias("first_id"))


@query()
def island_clean(spark, d):
    own = clusters(spark, d)
    pairs = joins.coelution_pairs(own, 0.025, 2.0).withColumn("cosine", ((F.col("id_a") + F.col("id_b")) % 10) / 10)
    return islands.greedy_clean(own, pairs, 0.025, 2.0, 0.55, bflag_cutoff=300.0)


@query()
def ms1_clean(spark, d):
    return islands.greedy_clean(clusters(spark, d), None, 0.025, 2.0, None)


def _measured(spark, d):
    own = spectra(spark, d)
    return own.select("id", (F.floor(F.col("id") / 6) + (F.col("id") % 6) * 0.004).alias("mz"), (F.col("id") % 9 * 1.0).alias("rt_mean"), (F.col("id") % 9 - 3.0).alias("rt_min"), (F.col("id") % 9 + 3.0).alias("rt_max"), (F.col("id") + 1.0).alias("precursor_intensity"), "peaks", (F.col("id") % 2 + 1).cast("int").alias("batch"), (F.col("id") % 10 == 0).alias("is_blank"))


@query()
def cluster_spectra(spark, d):
    own = _measured(spark, d).withColumn("peaks", F.filter("peaks", lambda p: p["mz"] > 0))
    return islands.cluster(own.withColumn("mz", F.col("mz") + 60), 0.025, 0.5, 4.0, 0.55)


@query()
def cluster_hierarchy(spark, d):
    return islands.hierarchical(_measured(spark, d).withColumn("mz", F.col("mz") + 60), 0.025, 0.5, (3.0, 4.0), 0.55, 0.3)


@query()
def consensus_spectra(spark, d):
    own = _measured(spark, d)
    members_ = own.select((F.col("id") % 100).alias("cluster_id"), "id")
    return islands.consensus(own, members_, 0.5).select("cluster_id", "size", "mz", "rt_mean", "rt_min", "rt_max", F.size("peaks").alias("n_peaks"))


# Statistics -----------------------------------------------------------------------------------------------------------------

_VECTORS = "SELECT l_partkey % 500 AS key, l_suppkey AS s, CAST(sum(l_quantity) AS DOUBLE) AS x, CAST(any_value(floor(s_acctbal)) AS DOUBLE) AS y FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2"


def _vectors(spark, d):
    own = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return own.groupBy((F.col("l_partkey") % 500).alias("key"), F.col("l_suppkey").alias("s")).agg(F.sum("l_quantity").alias("x"), F.first(F.floor("s_acctbal")).cast("double").alias("y"))


@query(f"SELECT key, count(*) AS n, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN floor(corr(x, y) * 1e4 + 0.5) / 1e4 END AS corr FROM ({_VECTORS}) GROUP BY 1")
def corr_pearson(spark, d):
    return stats.pearson(_vectors(spark, d), ["key"], "x", "y").withColumn("corr", _FOURTH(F.col("corr")))


@query(f"WITH v AS ({_VECTORS}), r AS (SELECT key, rank() OVER (PARTITION BY key ORDER BY x) + (count(*) OVER (PARTITION BY key, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY key ORDER BY y) + (count(*) OVER (PARTITION BY key, y) - 1) / 2.0 AS ry FROM v) SELECT key, count(*) AS n, CASE WHEN min(rx) < max(rx) AND min(ry) < max(ry) THEN floor(corr(rx, ry) * 1e4 + 0.5) / 1e4 END AS corr FROM r GROUP BY 1")
def corr_spearman(spark, d):
    return stats.spearman(_vectors(spark, d), ["key"], "x", "y").withColumn("corr", _FOURTH(F.col("corr")))


@query(f"WITH v AS MATERIALIZED ({_VECTORS}), p AS (SELECT a.key, sign(a.x - b.x) AS sx, sign(a.y - b.y) AS sy FROM v a JOIN v b ON a.key = b.key AND a.s < b.s), t AS (SELECT key, sum(sx * sy) AS s, sum(abs(sx)) AS nx, sum(abs(sy)) AS ny FROM p GROUP BY 1), n AS (SELECT key, count(*) AS n FROM v GROUP BY 1) SELECT n.key, n, CASE WHEN nx > 0 AND ny > 0 THEN floor(s / sqrt(CAST(nx AS DOUBLE) * ny) * 1e4 + 0.5) / 1e4 END AS corr FROM n LEFT JOIN t USING (key)")
def corr_kendall(spark, d):
    return stats.kendall(_vectors(spark, d), ["key"], "x", "y", "s").withColumn("corr", _FOURTH(F.col("corr")))


def _correlated(spark, d):
    meta = metadata(spark)
    q = quant.quantify(members(spark, d))
    return correlation.correlate(q, correlation.prepared_bioactivity(meta), correlation.correlation_groups(meta), q.select("cluster_id"), "pearson", "n_spectra")


_CORR = f"""WITH q AS ({_QUANT}), m AS (SELECT *, CAST(substr(sample, 2) AS INT) AS k FROM ({METADATA})), g AS (SELECT 'all' AS cor, sample, bio FROM m UNION ALL SELECT 'some', sample, bio FROM m WHERE k > 2),
 f AS (SELECT c.cluster_id, cor, coalesce(n_spectra, 0) AS x, bio FROM (SELECT DISTINCT cluster_id FROM q) c CROSS JOIN g LEFT JOIN q ON q.cluster_id = c.cluster_id AND q.sample = g.sample),
 r AS (SELECT cluster_id, cor, CASE WHEN min(x) < max(x) THEN floor(corr(x, bio) * 1e4 + 0.5) / 1e4 END AS corr, sum(x) AS total FROM f GROUP BY 1, 2)"""


@query(_CORR + " SELECT cluster_id, cor, 'bio' AS bioactivity, corr, CASE WHEN corr IS NULL AND total <> 0 THEN 'CTE' END AS corr_status FROM r")
def bioactivity_correlation(spark, d):
    return _correlated(spark, d).withColumn("corr", _FOURTH(F.col("corr")))


@query(_CORR + ", h AS (SELECT cluster_id, cor, corr, max(corr) OVER (PARTITION BY cluster_id) AS best FROM r WHERE corr >= 0.2 AND cluster_id % 10 <> 0), p AS (SELECT cluster_id, cor || '_bio_top_' || CAST(row_number() OVER (PARTITION BY cor ORDER BY corr DESC, best DESC, (cluster_id * 37) % 1000 DESC, cluster_id) AS VARCHAR) AS label, row_number() OVER (PARTITION BY cor ORDER BY corr DESC, best DESC, (cluster_id * 37) % 1000 DESC, cluster_id) AS n FROM h) SELECT cluster_id, string_agg(label, ';' ORDER BY label) AS hits FROM p WHERE n <= 20 GROUP BY 1")
def top_hits(spark, d):
    known = members(spark, d).select("cluster_id").distinct().select("cluster_id", F.when(F.col("cluster_id") % 10 == 0, 1).otherwise(0).alias("blanks_total"), F.lit(0).alias("beds_total"), ((F.col("cluster_id") * 37) % 1000).alias("base_peak_int"))
    found = _correlated(spark, d).withColumn("corr", _FOURTH(F.col("corr")))
    return correlation.top_hits(found, known, 20, 0.2).select("cluster_id", F.array_join("hits", ";").alias("hits"))


# Library ------------------------------------------------------------------------------------------------------------------

_RESULTS = "SELECT l_partkey AS scan, l_suppkey AS spectrum_id, l_extendedprice AS mq_score, l_returnflag AS adduct, l_orderkey, l_linenumber FROM lineitem"


def _results(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("scan"), F.col("l_suppkey").alias("spectrum_id"), F.col("l_extendedprice").alias("mq_score"), F.col("l_returnflag").alias("adduct"))


@query(f"WITH r AS (SELECT CASE WHEN scan % 2 = 0 AND scan > 2 THEN scan - 1 ELSE scan END AS cluster_id, spectrum_id, max(mq_score) AS s FROM ({_RESULTS}) GROUP BY 1, 2) SELECT p_partkey AS id, string_agg(CAST(spectrum_id AS VARCHAR), ';' ORDER BY s DESC, spectrum_id) AS gnps_spectrum_id FROM part LEFT JOIN r ON r.cluster_id = p_partkey GROUP BY 1")
def gnps_join(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    merged = parts.where("id % 2 = 0 and id > 2").select((F.col("id") - 1).alias("id"), F.array(F.col("id") - 1, F.col("id")).alias("joined_ids"))
    found = library.remapped(_results(spark, d), merged).drop("scan")
    return library.joined_results(parts, found, ["spectrum_id"])


@query(f"WITH r AS (SELECT scan, spectrum_id, mq_score, row_number() OVER (PARTITION BY scan ORDER BY mq_score DESC, spectrum_id) AS n FROM ({_RESULTS})) SELECT p_partkey AS id, coalesce(string_agg(CAST(spectrum_id AS VARCHAR), ';' ORDER BY n), 'NA') AS spectrum_id FROM part LEFT JOIN r ON r.scan = p_partkey AND n <= 3 GROUP BY 1")
def library_top_results(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    hits = _results(spark, d).select(F.col("scan").alias("cluster_id"), F.col("spectrum_id").alias("hit"), F.col("mq_score").alias("score"))
    found = library.top_results(parts, hits.withColumnRenamed("hit", "spectrum_id").withColumn("spectrum_id", F.col("spectrum_id")), 3, ["spectrum_id"])
    return found.select("id", "spectrum_id")


@query("SELECT l_orderkey, l_linenumber, p_name, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def compound_join(spark, d):
    hits = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("compound_id"))
    return library.with_compounds(hits, table(spark, d, "part").select(F.col("p_partkey").alias("compound_id"), "p_name", "p_brand")).select("l_orderkey", "l_linenumber", "p_name", "p_brand")


@query(COSINES + " SELECT cluster_id, compound_id, cosine, matched, rank FROM (SELECT id_a AS cluster_id, id_b AS compound_id, cosine, matched, row_number() OVER (PARTITION BY id_a ORDER BY cosine DESC, id_b) AS rank FROM cos WHERE abs(id_a % 40 - id_b % 40) <= 2 AND cosine >= 0.2) WHERE rank <= 10")
def library_search(spark, d):
    own = spectra(spark, d)
    met = library.search(own, own.withColumnRenamed("id", "compound_id"), 2.0, 0.25, 0.15, 1 << 30).where("cluster_id < compound_id")
    third = met.withColumn("cosine", F.floor(F.col("score") * 1000 + 0.5) / 1000).where("cosine >= 0.2")
    return third.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("cosine"), "compound_id"))).where("rank <= 10").select("cluster_id", "compound_id", "cosine", F.col("matched").cast("long").alias("matched"), F.col("rank").cast("long").alias("rank"))


# Pre-processing ----------------------------------------------------------------------------------------------------------------


@query("WITH b AS (SELECT min(l_quantity) + 900 AS low, max(l_quantity) * 8 AS high FROM lineitem) SELECT p_partkey FROM part, b WHERE p_retailprice - 0.01 >= low - 25 AND p_retailprice + 0.01 <= 3 * high + 25")
def precursor_range(spark, d):
    ms1 = table(spark, d, "part").select("p_partkey", (F.col("p_retailprice") - 0.01).alias("mz_min"), (F.col("p_retailprice") + 0.01).alias("mz_max"))
    bounds = table(spark, d, "lineitem").agg(F.min("l_quantity").alias("a"), F.max("l_quantity").alias("b")).select(F.explode(F.array(F.col("a") + 900, F.col("b") * 8)).alias("precursor_mz"))
    return preprocess.in_precursor_range(ms1, bounds).select("p_partkey")


def _matched(spark, d):
    own = table(spark, d, "events")
    return own.select(F.col("event_type").alias("sample"), (F.col("user_id") % 50).cast("string").alias("peak_id"), (F.col("event_id") % 7 == 0).alias("is_fake"), F.floor("value").cast("double").alias("mz"), F.col("value").alias("intensity"))


@query("SELECT event_type AS sample, count(*) AS n_spectra, count(*) FILTER (event_id % 7 = 0) AS n_unmatched, 100.0 * count(*) FILTER (event_id % 7 = 0) / count(*) > 5 AS warn FROM events GROUP BY 1")
def match_rates(spark, d):
    return preprocess.match_rates(_matched(spark, d)).select("sample", "n_spectra", "n_unmatched", "warn")


@query("SELECT sample, mz, freq FROM (SELECT event_type AS sample, floor(value) AS mz, count(*) AS freq, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, max(value) DESC, floor(value) DESC) AS n FROM events WHERE event_id % 7 = 0 GROUP BY 1, 2) WHERE n <= 5")
def top_unmatched(spark, d):
    return preprocess.top_unmatched(_matched(spark, d)).select("sample", "mz", "freq")


@query("WITH m AS (SELECT user_id % 50 AS k, count(*) AS n FROM events WHERE event_id % 7 <> 0 GROUP BY 1) SELECT CASE WHEN n IS NULL THEN CAST(i AS VARCHAR) || '_NOPEAKS' ELSE CAST(i AS VARCHAR) END AS peak_id, coalesce(n, 0) AS ms2_matches FROM range(60) t(i) LEFT JOIN m ON m.k = i")
def split_by_spectra(spark, d):
    own = table(spark, d, "events").select((F.col("user_id") % 50).cast("string").alias("peak_id"), (F.col("event_id") % 7 == 0).alias("is_fake"))
    with_ms2, without = preprocess.split_by_spectra(spark.range(60).select(F.col("id").cast("string").alias("peak_id")), own)
    return with_ms2.unionByName(without)


@query(f"SELECT quantile_cont(rt_max - rt_min, 0.5) / 2 AS rt_tolerance_median FROM ({CLUSTERS}) WHERE NOT bflag AND rt_max > rt_min")
def peak_widths(spark, d):
    return preprocess.peak_widths(clusters(spark, d)).select("rt_tolerance_median")


@query("SELECT l_returnflag AS sample, CAST(l_linenumber AS DOUBLE) AS rt, max(l_extendedprice) AS intensity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 GROUP BY 1, 2")
def chromatogram(spark, d):
    points = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), F.col("l_linenumber").cast("double").alias("rt"), F.col("l_quantity").alias("mz"), F.col("l_extendedprice").alias("intensity"))
    return preprocess.chromatogram(points, "bpc", 10.0, 20.0)


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return event_counts(table(spark, d, "events")).select(F.col("window.start").alias("window_start"), "event_type", "n")
