"""Further queries of the engine: sources and sinks by round trip, pre-processing, reducers, annotation, with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ionloom.functions import kernels as K, scalars as S
from ionloom.operators import annotate, correlation, graph, islands, preprocess, quant, similarity, symbolic
from ionloom.plans.catalog import _FOURTH, query
from ionloom.plans.lenses import CLUSTERS, COSINES, MEMBERS, METADATA, PEAKS, clusters, cosines, members, metadata, peaks, spectra, table
from ionloom.schema import ISOTOPE_STEP, PROTON_ELECTRON
from ionloom.sources import tables
from ionloom.sources.mgf import read_mgf, write_clusters_mgf, write_mgf


def _path(spark, what: str) -> str:
    return f"{graph.shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


# Sources and sinks ------------------------------------------------------------------------------------------------------


@query(f"SELECT id AS scans, CAST(id % 40 + 20 AS DOUBLE) AS precursor_mz, CAST(id % 9 AS DOUBLE) AS rt, 't' || CAST(id AS VARCHAR) AS title, count(*) AS num_peaks, max(CAST(mz AS DOUBLE)) AS base_peak_int FROM ({PEAKS}) GROUP BY id")
def mgf_headers(spark, d):
    own = spectra(spark, d).select(F.col("id").alias("scans"), "precursor_mz", (F.col("id") % 9).cast("double").alias("rt"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"), F.transform("peaks", lambda p: F.struct(p["mz"].alias("mz"), p["mz"].alias("intensity"))).alias("peaks"))
    path = _path(spark, "mgf")
    write_mgf(own, path)
    return read_mgf(spark, path, with_peaks=False).select("scans", "precursor_mz", "rt", "title", F.col("num_peaks").cast("long").alias("num_peaks"), "base_peak_int")


@query("SELECT p_partkey AS scans, CASE WHEN p_size - 10.0::DOUBLE > p_partkey % 50 THEN p_partkey % 50 - 0.5::DOUBLE ELSE p_size - 10.0::DOUBLE END AS rt_min, CASE WHEN p_size + 10.0::DOUBLE < p_partkey % 50 THEN p_partkey % 50 + 0.5::DOUBLE ELSE p_size + 10.0::DOUBLE END AS rt_max, left(repeat(p_name || '-', 40), 200) AS title FROM part WHERE p_partkey % 7 <> 0")
def mgf_time_range(spark, d):
    k = F.col("p_partkey")
    one = F.array(F.struct(F.lit(50.0).alias("mz"), F.when(k % 7 == 0, 0.0).otherwise(1.0).alias("intensity")))
    own = table(spark, d, "part").select(k.alias("scans"), F.lit(100.0).alias("precursor_mz"), (k % 50).cast("double").alias("rt"), (F.col("p_size") - F.lit(10.0)).alias("rt_min"), (F.col("p_size") + F.lit(10.0)).alias("rt_max"), F.repeat(F.concat("p_name", F.lit("-")), F.lit(40)).alias("title"), one.alias("peaks"))
    path = _path(spark, "mgf")
    write_mgf(own, path)
    return read_mgf(spark, path).select("scans", "rt_min", "rt_max", "title")


@query(f"SELECT id AS scans, sum((mz % 7 + 1) * (mz % 7 + 1)) AS total, max((mz % 7 + 1) * (mz % 7 + 1)) AS base_peak_int FROM ({PEAKS}) GROUP BY id")
def mgf_of_clusters(spark, d):
    path = _path(spark, "mgf")
    write_clusters_mgf(spectra(spark, d).withColumn("peaks", F.transform("peaks", lambda p: F.struct(p["mz"].alias("mz"), (p["mz"] % 7 + 1).alias("intensity")))), path, 0.5)
    return read_mgf(spark, path).select("scans", F.aggregate("peaks", F.lit(0.0), lambda a, x: a + x["intensity"]).alias("total"), "base_peak_int")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name || ', \"' || c_mktsegment || '\"' END AS name, CAST(c_custkey % 4 AS VARCHAR) || ';x' AS tags FROM customer")
def csv_round_trip(spark, d):
    k = F.col("c_custkey")
    own = table(spark, d, "customer").select(k, F.when(k % 3 != 0, F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))).alias("name"), F.array((k % 4).cast("string"), F.lit("x")).alias("tags"))
    path = _path(spark, "csv")
    tables.write_csv(own, path, "c_custkey")
    return tables.read_csv(spark, path, "c_custkey long, name string, tags string")


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 1, '2'")
def below_preamble(spark, d):
    rows = table(spark, d, "nation").select(F.concat_ws(",", "n_nationkey", "n_name").alias("value"))
    head = spark.createDataFrame([("1,2",), ("made by a run",), ("n_nationkey,n_name",), ("1,2",)], "value string").coalesce(1)
    path = _path(spark, "preamble")
    head.unionByName(rows).coalesce(1).write.text(path)
    return tables.read_below_preamble(spark, path, "n_nationkey").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")


@query(f"SELECT cluster_id, sample, scan, peak_area, base_peak_int FROM ({MEMBERS})")
def members_round_trip(spark, d):
    path = _path(spark, "members")
    tables.write_members(members(spark, d), path)
    return tables.read_members(spark, path).select("cluster_id", "sample", "scan", "peak_area", "base_peak_int")


@query("SELECT p_partkey AS cluster_index, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey + 1000 END AS scan, p_brand AS spectrum_id, p_retailprice AS mq_score, p_type || '_' || p_name AS ion_source_instrument FROM part")
def gnps_results(spark, d):
    own = table(spark, d, "part")
    k = F.col("p_partkey")
    clusters_, results = _path(spark, "gnps"), _path(spark, "gnps")
    own.where(k % 5 != 0).select(k.alias("#ClusterIdx"), (k + 1000).alias("#Scan")).write.option("header", True).option("sep", "\t").csv(clusters_)
    own.select(k.alias("#Scan#"), F.col("p_brand").alias("SpectrumID"), F.col("p_retailprice").alias("MQScore"), F.col("p_type").alias("Ion_Source"), F.col("p_name").alias("Instrument")).write.option("header", True).option("sep", "\t").csv(results)
    return tables.read_gnps(spark, clusters_, results).select("cluster_index", "scan", "spectrum_id", "mq_score", "ion_source_instrument")


@query(COSINES + " SELECT id_a AS source, id_b AS target, cosine, matched FROM cos WHERE cosine >= 0.7")
def edges_file(spark, d):
    path = _path(spark, "edges")
    tables.write_edges(cosines(spark, d).where("cosine >= 0.7").select("id_a", "id_b", "cosine", "matched"), path)
    back = tables.read_csv(spark, path, "msclusterID_source long, msclusterID_target long, cosine double, num_matched_peaks long")
    return back.select(F.col("msclusterID_source").alias("source"), F.col("msclusterID_target").alias("target"), "cosine", F.col("num_matched_peaks").alias("matched"))


@query(f"SELECT id, mz, num_spectra FROM ({CLUSTERS})")
def attributes_file(spark, d):
    path = _path(spark, "attributes")
    tables.write_attributes(clusters(spark, d).select("id", "mz", "num_spectra"), path)
    return tables.read_csv(spark, path, "id long, mz double, num_spectra long")


@query("SELECT 'mz_tolerance' AS name, '0.025' AS value UNION ALL SELECT 'batches', '2' UNION ALL SELECT 'title', 'a \"run\"'")
def manifest(spark, d):
    path = _path(spark, "manifest")
    tables.write_manifest(spark, path, {"mz_tolerance": 0.025, "batches": 2, "title": 'a "run"'})
    return spark.read.text(path).select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "value"))


# Pre-processing -----------------------------------------------------------------------------------------------------------


@query(f"SELECT batch, sample_type = 'blank' AS is_blank, string_agg(sample, ';' ORDER BY sample) AS samples FROM ({METADATA}) GROUP BY 1, 2")
def batch_plan(spark, d):
    return preprocess.batch_plan(metadata(spark)).select("batch", "is_blank", F.array_join("samples", ";").alias("samples"))


@query(f"SELECT batch, sample AS sample_code FROM (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY 'f' || substr(sample, 2)) AS n FROM ({METADATA}) WHERE sample_type <> 'blank') WHERE n <= 3")
def alignment_samples(spark, d):
    return preprocess.alignment_samples(metadata(spark)).select("batch", "sample_code")


@query("SELECT precursor_mz FROM (SELECT p_retailprice AS precursor_mz, row_number() OVER (PARTITION BY round_even(p_retailprice / 0.05, 0) ORDER BY p_retailprice, p_partkey) AS n FROM part WHERE p_partkey % 10 = 0) WHERE n = 1")
def blank_masses(spark, d):
    own = table(spark, d, "part").select((F.col("p_partkey") % 10 == 0).alias("is_blank"), F.col("p_retailprice").alias("precursor_mz"), F.col("p_partkey").alias("spectrum_id"))
    return preprocess.blank_masses(own, 0.05)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 1.0 ELSE l_discount END AS presence FROM lineitem")
def presence(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", preprocess.presence(F.col("l_discount")).alias("presence"))


@query(f"SELECT id, count(*) AS n FROM ({PEAKS}) GROUP BY id HAVING count(*) >= 24")
def enough_peaks(spark, d):
    return preprocess.with_enough_peaks(spectra(spark, d), 24).select("id", F.size("peaks").cast("long").alias("n"))


@query(f"SELECT quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.75) AS q3, floor(avg(w) / 2 * 1e6 + 0.5) / 1e6 AS half_mean FROM (SELECT rt_max - rt_min AS w FROM ({CLUSTERS}) WHERE NOT bflag AND rt_max > rt_min AND rt_max < 1000000)")
def peak_width_quartiles(spark, d):
    """The widths that peak_widths suggests where nothing is widened (factor 0)."""
    own = preprocess.peak_widths(clusters(spark, d), (0.0,))
    return own.select(F.col("width_from").alias("q1"), F.col("width_to").alias("q3"), (F.floor(F.col("rt_tolerance_mean") * 1e6 + 0.5) / 1e6).alias("half_mean"))


@query("SELECT event_type AS sample, floor(100.0 * count(*) FILTER (event_id % 7 = 0) / count(*) * 1e6 + 0.5) / 1e6 AS percent FROM events GROUP BY 1")
def unmatched_percent(spark, d):
    own = table(spark, d, "events").select(F.col("event_type").alias("sample"), (F.col("event_id") % 7 == 0).alias("is_fake"))
    return preprocess.match_rates(own).select("sample", (F.floor(F.col("percent_unmatched") * 1e6 + 0.5) / 1e6).alias("percent"))


# Quantification, reducers --------------------------------------------------------------------------------------------------


@query("SELECT l_partkey AS key FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size < 25")
def intersection(spark, d):
    return table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("key")).intersect(table(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("key")))


_GROUPS = f"SELECT *, id % 300 AS g FROM ({CLUSTERS})"


@query(f"""WITH m AS ({_GROUPS}), p AS (SELECT g, id, unnest(peak_ids) AS p, unnest(range(2)) AS k FROM m), f AS (SELECT g, p, min(id * 2 + k) AS o FROM p GROUP BY 1, 2)
SELECT g, (SELECT string_agg(p, ';' ORDER BY o) FROM f WHERE f.g = m.g) AS peak_ids, string_agg(CAST(id AS VARCHAR) || ';' || CAST(id + 1 AS VARCHAR), ';' ORDER BY id) AS joined_ids, string_agg('s' || CAST(id % 7 AS VARCHAR), ';' ORDER BY id) FILTER (id % 5 <> 0) AS smiles, min(id % 4) AS blank_dist, CAST(sum(id % 3) + count(*) - 1 AS BIGINT) AS num_joins FROM m GROUP BY g""")
def merge_lists(spark, d):
    k = F.col("id")
    own = clusters(spark, d).select((k % 300).alias("g"), "id", "peak_ids", F.array(k, k + 1).alias("joined_ids"), F.when(k % 5 != 0, F.concat(F.lit("s"), (k % 7).cast("string"))).alias("smiles"), (k % 4).alias("blank_dist"), (k % 3).alias("num_joins"))
    out = quant.merged(own, "g")
    return out.select("g", F.array_join("peak_ids", ";").alias("peak_ids"), F.array_join(F.col("joined_ids").cast("array<string>"), ";").alias("joined_ids"), F.nullif("smiles", F.lit("")).alias("smiles"), "blank_dist", F.col("num_joins").cast("long").alias("num_joins"))


@query(f"""WITH m AS (SELECT g, sum_ints, CASE WHEN id % 9 = 0 THEN 0 ELSE rt_min END AS rt_min, CASE WHEN id % 9 = 0 THEN 1000000 ELSE rt_max END AS rt_max, id % 9 = 0 AS base FROM ({_GROUPS}))
SELECT g, CASE WHEN bool_or(base) THEN 0 ELSE floor(sum(rt_min * sum_ints) / sum(sum_ints) * 100 + 0.5) / 100 END AS rt_min, CASE WHEN bool_or(base) THEN 1000000 ELSE floor(sum(rt_max * sum_ints) / sum(sum_ints) * 100 + 0.5) / 100 END AS rt_max FROM m GROUP BY 1""")
def merge_bounds(spark, d):
    base = F.col("id") % 9 == 0
    own = clusters(spark, d).select((F.col("id") % 300).alias("g"), "id", "sum_ints", F.when(base, 0.0).otherwise(F.col("rt_min")).alias("rt_min"), F.when(base, 1_000_000.0).otherwise(F.col("rt_max")).alias("rt_max"))
    out = quant.merged(own, "g")
    return out.select("g", *[(F.floor(F.col(c) * 100 + 0.5) / 100).alias(c) for c in ("rt_min", "rt_max")])


@query(f"SELECT count(DISTINCT id) / CAST(count(DISTINCT floor(mz)) AS DOUBLE) AS clusters_a_mass FROM ({CLUSTERS})")
def clusters_a_mass(spark, d):
    return quant.quality_statistics(clusters(spark, d).withColumn("mz", F.floor("mz").cast("double")), "num_spectra").select("clusters_a_mass")


@query("SELECT 'bio,0.0,2.0,4.0,1.0,3.0,0.0,2.0,4.0' AS line")
def correlation_preamble(spark, d):
    lines = correlation.preamble(correlation.prepared_bioactivity(metadata(spark)), [f"S{k}" for k in range(8)])
    return spark.createDataFrame([(x,) for x in lines], "line string")


# Spectra ---------------------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, floor(l_quantity * 1e3 + 0.5) / 1e3 AS from_log, floor(l_quantity * 1e3 + 0.5) / 1e3 AS from_root FROM lineitem")
def intensity_unscaling(spark, d):
    x, third = F.col("l_quantity").cast("double"), lambda c: F.floor(c * 1e3 + 0.5) / 1e3
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", third(S.unscaled(S.scaled(x, 0), 0)).alias("from_log"), third(S.unscaled(S.scaled(x, 0.5), 0.5)).alias("from_root"))


@query("SELECT l_orderkey, l_linenumber, floor((1 - pow(1 - l_discount, l_quantity)) * 1e6 + 0.5) / 1e6 AS p FROM lineitem WHERE l_discount < 0.09")
def best_match_chance(spark, d):
    own = table(spark, d, "lineitem").where("l_discount < 0.09")
    return own.select("l_orderkey", "l_linenumber", (F.floor(S.p_value(F.col("l_discount"), F.col("l_quantity")) * 1e6 + 0.5) / 1e6).alias("p"))


@query(COSINES + ", s AS (SELECT a.id AS id_a, b.id AS id_b, least(1.0::DOUBLE, 2 * count(*) / CAST(any_value(x.n) + any_value(y.n) AS DOUBLE)) AS share FROM pk a JOIN pk b ON a.mz = b.mz AND a.id < b.id JOIN nm x ON x.id = a.id JOIN nm y ON y.id = b.id GROUP BY 1, 2) SELECT s.id_a, s.id_b, floor((CASE WHEN share < 0.3 THEN share ELSE least(1.0::DOUBLE, cosine) END) * 1000 + 0.5) / 1000 AS similarity FROM s JOIN cos USING (id_a, id_b)")
def mixed_estimate(spark, d):
    own = similarity.mixed_estimate(peaks(spark, d), spectra(spark, d), 0.25, 0.3)
    return own.select("id_a", "id_b", (F.floor(F.col("similarity") * 1000 + 0.5) / 1000).alias("similarity"))


@query(COSINES + """, m AS (SELECT id_a, id_b, least(id_a % 40, id_b % 40) + 20 AS trim FROM top), t AS (SELECT m.id_a, m.id_b, sum(a.intensity * b.intensity) AS t FROM m JOIN pk a ON a.id = m.id_a AND a.mz < trim JOIN pk b ON b.id = m.id_b AND b.mz = a.mz GROUP BY 1, 2),
 n AS (SELECT id, trim, sum(intensity * intensity) AS n2 FROM pk JOIN (SELECT DISTINCT unnest(range(20, 60)) AS trim) ON mz <= trim GROUP BY 1, 2)
 SELECT m.id_a, m.id_b, coalesce(floor(t / sqrt(p.n2 * q.n2) * 1000 + 0.5) / 1000, 0) AS cosine FROM m LEFT JOIN t USING (id_a, id_b) LEFT JOIN n p ON p.id = m.id_a AND p.trim = m.trim LEFT JOIN n q ON q.id = m.id_b AND q.trim = m.trim""")
def trimmed_cosine(spark, d):
    own = spectra(spark, d)
    pairs = similarity.candidate_pairs(own, 0.25)
    side = lambda s: own.select(F.col("id").alias(f"id_{s}"), F.col("precursor_mz").alias(f"m_{s}"), F.col("peaks").alias(f"p_{s}"))
    met = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
    return met.select("id_a", "id_b", (F.floor(K.trimmed_cosine_of(F.col("p_a"), F.col("p_b"), F.least("m_a", "m_b"), 0.25) * 1000 + 0.5) / 1000).alias("cosine"))


@query(f"""WITH RECURSIVE o AS (SELECT id, mz, v, row_number() OVER (PARTITION BY id ORDER BY mz) AS n FROM (SELECT id, mz, intensity AS v, row_number() OVER (PARTITION BY id ORDER BY mz) AS first, id % 40 + 20 AS p FROM ({PEAKS})) WHERE first = 1 OR NOT (abs(mz - p) > 1.5 AND abs(mz - p) < 20)),
 r AS (SELECT id, n, 1 AS g, mz, v FROM o WHERE n = 1 UNION ALL SELECT r.id, o.n, CASE WHEN o.mz - r.mz <= 1.5 THEN g ELSE g + 1 END, CASE WHEN o.mz - r.mz <= 1.5 THEN r.mz * (r.v / (r.v + o.v)) + o.mz * (1 - r.v / (r.v + o.v)) ELSE o.mz END, CASE WHEN o.mz - r.mz <= 1.5 THEN r.v + o.v ELSE o.v END FROM r JOIN o ON o.id = r.id AND o.n = r.n + 1),
 j AS (SELECT id, g, max(v) AS v, row_number() OVER (PARTITION BY id ORDER BY max(v)) AS place, count(*) OVER (PARTITION BY id) AS n FROM r GROUP BY id, g), c AS (SELECT id, CASE WHEN any_value(n) > 10 THEN max(v) FILTER (place = 2 * n // 3 + 1) * 0.001 ELSE 0 END AS least FROM j GROUP BY id),
 k AS (SELECT j.id, v FROM j JOIN c USING (id) WHERE v > least) SELECT id, count(*) AS n, floor(sum(1000 * v / w) * 1e4 + 0.5) / 1e4 AS total FROM k JOIN (SELECT id, sum(v) AS w FROM k GROUP BY id) USING (id) GROUP BY id""")
def joined_peaks(spark, d):
    own = spectra(spark, d).select("id", K.joined_peaks_of(F.col("peaks"), 1.5, F.col("precursor_mz")).alias("p"))
    return own.select("id", F.size("p").cast("long").alias("n"), _FOURTH(F.aggregate("p", F.lit(0.0), lambda a, x: a + x["intensity"] * x["intensity"])).alias("total"))


@query(f"""WITH o AS (SELECT id % 50 AS rep, mz, sum((mz % 7 + 1) * (mz % 7 + 1) * (id + 1)) AS v FROM ({PEAKS}) GROUP BY 1, 2), j AS (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY v) AS place, count(*) OVER (PARTITION BY rep) AS n, sum(v) OVER (PARTITION BY rep) AS w FROM o),
 c AS (SELECT rep, CASE WHEN any_value(n) > 10 THEN max(v) FILTER (place = 2 * n // 3 + 1) * 0.001 ELSE 0 END AS least FROM j GROUP BY rep), k AS (SELECT j.rep, mz, v FROM j JOIN c USING (rep) WHERE v > least)
 SELECT rep, mz, floor(sqrt(1000 / sum(v) OVER (PARTITION BY rep) * v) * 1e4 + 0.5) / 1e4 AS intensity FROM k""")
def merged_peaks(spark, d):
    own = spectra(spark, d).select("id", (F.col("id") + 1.0).alias("sum_ints"), F.transform("peaks", lambda p: F.struct(p["mz"].alias("mz"), (p["mz"] % 7 + 1).alias("intensity"))).alias("peaks"))
    out = islands.clean_peaks(own, own.select("id", (F.col("id") % 50).alias("rep")), 0.5, 0.25)
    return out.select("rep", F.explode("peaks").alias("p")).select("rep", _FOURTH(F.col("p.mz")).alias("mz"), _FOURTH(F.col("p.intensity")).alias("intensity"))


# Networks ---------------------------------------------------------------------------------------------------------------------

_RANK_ROUNDS = 45
_TOP4 = COSINES + ", x4 AS (SELECT id_a AS id, cosine FROM cos UNION ALL SELECT id_b, cosine FROM cos), c4 AS (SELECT id, cosine AS cut FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC) AS n FROM x4) WHERE n = 5), e AS MATERIALIZED (SELECT DISTINCT id_b AS src, id_a AS dst FROM cos LEFT JOIN c4 p ON p.id = id_a LEFT JOIN c4 q ON q.id = id_b WHERE (p.cut IS NULL OR cosine > p.cut) AND (q.cut IS NULL OR cosine > q.cut))"
_RANKS = _TOP4 + ", dg AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY 1), w AS MATERIALIZED (SELECT id, 1.0::DOUBLE / count(*) OVER () AS w, deg FROM nm LEFT JOIN dg ON src = id), r0 AS MATERIALIZED (SELECT id, w AS rank FROM w)" + "".join(
    f", r{k} AS MATERIALIZED (SELECT w.id, 0.5 * (coalesce(got, 0) + lost * w) + 0.5 * w AS rank FROM w LEFT JOIN (SELECT dst AS id, sum(rank / deg) AS got FROM e JOIN r{k - 1} r ON r.id = e.src JOIN dg ON dg.src = e.src GROUP BY 1) s ON s.id = w.id, (SELECT coalesce(sum(rank), 0) AS lost FROM r{k - 1} JOIN w USING (id) WHERE deg IS NULL))"
    for k in range(1, _RANK_ROUNDS + 1)
)


@query(_RANKS + f" SELECT id, floor(rank * 1e6 + 0.5) / 1e6 AS rank FROM r{_RANK_ROUNDS}")
def pagerank(spark, d):
    e = graph.mutual_top_k(cosines(spark, d), 4).select(F.col("id_b").alias("src"), F.col("id_a").alias("dst"))
    nodes = peaks(spark, d).select("id").distinct()
    touched = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id"))).distinct()
    loops = nodes.join(touched, "id", "left_anti").select(F.col("id").alias("src"), F.col("id").alias("dst"))
    return graph.pagerank(graph.cut(e.unionByName(loops)), 0.5, 1e-10).withColumn("rank", F.floor(F.col("rank") * 1e6 + 0.5) / 1e6)


@query(COSINES.replace("WITH pk", "WITH RECURSIVE pk", 1) + """, s AS (SELECT * FROM cos WHERE cosine >= 0.6 AND NOT (matched < 6 AND (least(n_peaks_a, n_peaks_b) > 6 OR matched < 2))), x AS (SELECT id_a AS id, cosine FROM s UNION ALL SELECT id_b, cosine FROM s), c AS (SELECT id, cosine AS cut FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC) AS n FROM x) WHERE n = 16),
 f AS MATERIALIZED (SELECT id_a, id_b, cosine, matched FROM s LEFT JOIN c p ON p.id = id_a LEFT JOIN c q ON q.id = id_b WHERE (p.cut IS NULL OR cosine > p.cut) AND (q.cut IS NULL OR cosine > q.cut)),
 g AS MATERIALIZED (SELECT id_a, id_b, cosine, matched FROM f UNION ALL SELECT id, id, 1.0, -1 FROM nm WHERE id NOT IN (SELECT id_a FROM f UNION SELECT id_b FROM f)), b AS MATERIALIZED (SELECT id_a AS a, id_b AS b FROM g UNION SELECT id_b, id_a FROM g),
 r(id, root) AS (SELECT id, id FROM nm UNION SELECT b.b, r.root FROM r JOIN b ON b.a = r.id), m AS (SELECT id, min(root) AS root FROM r GROUP BY 1), i AS (SELECT root, row_number() OVER (ORDER BY root) AS component_index FROM (SELECT DISTINCT root FROM m))
 SELECT id_a, id_b, cosine, matched, component_index FROM g JOIN m ON m.id = id_a JOIN i USING (root)""")
def similarity_network_whole(spark, d):
    """The network whose components are left as large as they are."""
    return graph.network(cosines(spark, d), peaks(spark, d).select("id").distinct(), 0.6, 6, 15, 0).select("id_a", "id_b", "cosine", "matched", "component_index")


# Annotation ----------------------------------------------------------------------------------------------------------------------

RULES = [("[M+H]+", 1.007276, 1, 0, 0, 0, 0.0), ("[M+Na]+", 22.989218, 1, 1, 0, 0, 0.2), ("[M+K]+", 38.963158, 1, 1, 1, 0, 0.2), ("[M+2H]2+", 1.007276, 2, 0, 0, 0, 0.0), ("[M+3H]3+", 1.007276, 3, 0, 0, 0, 0.0), ("[2M+H]+", 1.007276, 1, 1, 0, 0, 0.3), ("[3M+H]+", 1.007276, 1, 0, 0, 0, 0.3), ("[M+H-H2O]+", 18.01056, 1, 0, 0, 1, 0.2), ("[M+1]+", 0.0, 1, 0, 0, 0, 0.2), ("[M+2]+", 0.0, 1, 0, 0, 0, 0.2), ("[M-H]-", -1.007276, -1, 0, 0, 0, 0.0)]
_E = PROTON_ELECTRON
#: Ion forms of one molecule of mass m: [M+H]+, [M+Na]+, its isotope, less water, two charges and that one's isotope, dimer, another ion.
_FORMS = ["m + 1.00783", "m + 22.989218", f"m + 1.00783 + {ISOTOPE_STEP}", "m + 1.00783 - 18.01056", "m / 2 + 1.007276", f"m / 2 + 1.007276 + {_E / 2}", "2 * m + 1.007276", "m + 77.7"]
_ION_VIEW = "SELECT id, floor((CASE " + " ".join(f"WHEN j = {j} THEN {f}" for j, f in enumerate(_FORMS)) + " END) * 1e4 + 0.5) / 1e4 AS mz, rt_mean, rt_mean - 2 AS rt_min, rt_mean + 2 AS rt_max, CASE WHEN id % 40 = 7 THEN 3 ELSE 0 END AS blanks_total, CASE WHEN j IN (2, 5) THEN 40.0 ELSE 100.0 END AS area, g % 3 = 0 AS strong, floor((m + 1.00783 - 18.01056) * 1e4 + 0.5) / 1e4 AS held, j = 0 AND g % 2 = 0 AS has_peak FROM (SELECT p_partkey AS id, p_partkey % 8 AS j, p_partkey // 8 AS g, 150.0 + (p_partkey // 8) % 400 * 3.37 AS m, (p_partkey // 8) * 5.0 + p_partkey % 2 AS rt_mean FROM part)"


def ions(spark, d):
    """Parts as ions: eight forms of each molecule, which elute together."""
    # the view's text is plain SQL of both engines but for whole division
    table(spark, d, "part").createOrReplaceTempView("_parts")
    own = spark.sql(_ION_VIEW.replace("p_partkey // 8", "floor(p_partkey / 8)").replace("FROM part", "FROM _parts").replace("40.0 ELSE 100.0", "40D ELSE 100D").replace("150.0 +", "150D +").replace("* 5.0", "* 5D").replace("* 3.37", "* 3.37D"))
    peaks_ = F.when(F.col("has_peak"), F.array(F.struct(F.col("held").alias("mz"), F.lit(10.0).alias("intensity")))).otherwise(F.array().cast("array<struct<mz:double,intensity:double>>"))
    as_double = [F.col(c).cast("double").alias(c) for c in ("mz", "rt_mean", "rt_min", "rt_max", "area")]
    return own.select("id", *as_double, F.col("blanks_total").cast("long").alias("blanks_total"), F.array(F.lit(1)).alias("batches"), "strong", peaks_.alias("peaks"))


def _sim(a, b):
    return F.element_at(F.array(F.lit(0.8), F.lit(0.3), F.lit(0.1)), ((a + b) % 3 + 1).cast("int"))


def _found(spark, d):
    own = ions(spark, d)
    pairs = graph.cut(annotate.coeluting(own, 1.0), "pairs").withColumns({"sim": _sim(F.col("l.id"), F.col("r.id")), "trim_sim": F.lit(0.1)})
    rules = spark.createDataFrame(RULES, "ion string, mzdiff double, charge int, neutral_loss_h2o int, neutral_loss_nh3 int, neutral_loss int, sim_cutoff double")
    found = graph.cut(annotate.annotated_pairs(pairs, rules, annotate.isotopic_evidence(pairs, 0.05), 0.025, 0.05), "annotated")
    return found.withColumn("mz_error", F.floor(F.col("mz_error") * 100 + 0.5) / 100), pairs


_RULES_SQL = ", ".join(f"('{i}', {m}::DOUBLE, {z}, {w}, {n}, {loss}, {s}::DOUBLE)" for i, m, z, w, n, loss, s in RULES)
_PAIRS_SQL = f"""v AS MATERIALIZED (SELECT id, CAST(mz AS DOUBLE) AS mz, CAST(rt_mean AS DOUBLE) AS rt_mean, CAST(rt_min AS DOUBLE) AS rt_min, CAST(rt_max AS DOUBLE) AS rt_max, blanks_total, CAST(area AS DOUBLE) AS area, strong, CAST(held AS DOUBLE) AS held, has_peak FROM ({_ION_VIEW})),
 u AS (SELECT *, CASE WHEN blanks_total > 0 THEN rt_mean - 3 ELSE rt_min END AS low, CASE WHEN blanks_total > 0 THEN rt_mean + 3 ELSE rt_max END AS high FROM v),
 p AS MATERIALIZED (SELECT l.id AS id_a, r.id AS id_b FROM u l JOIN u r ON l.id < r.id AND r.rt_mean >= l.rt_mean - 60 AND r.rt_mean <= l.rt_mean + 60 AND ((l.rt_mean BETWEEN r.low - 1 AND r.high + 1) OR (r.rt_mean BETWEEN l.low - 1 AND l.high + 1)) AND (l.blanks_total > 0 OR r.blanks_total > 0 OR abs(l.rt_mean - r.rt_mean) <= 4 OR sqrt(((l.rt_min - r.rt_min) * (l.rt_min - r.rt_min) + (l.rt_max - r.rt_max) * (l.rt_max - r.rt_max)) / 2) <= 2))"""
_FOUND_SQL = f"""WITH {_PAIRS_SQL}, rules(ion, mzdiff, charge, h2o, nh3, loss, cutoff) AS (VALUES {_RULES_SQL}), pos AS (SELECT * FROM rules WHERE charge > 0),
 more AS (SELECT *, 0.0::DOUBLE AS less, ion AS name FROM pos UNION ALL SELECT *, 18.01056::DOUBLE, replace(ion, ']', '-H2O]') FROM pos WHERE h2o = 1 UNION ALL SELECT *, 17.02655::DOUBLE, replace(ion, ']', '-NH3]') FROM pos WHERE nh3 = 1),
 q AS MATERIALIZED (SELECT id_a, id_b, [0.8, 0.3, 0.1][(id_a + id_b) % 3 + 1]::DOUBLE AS sim, CASE WHEN l.mz >= r.mz THEN l ELSE r END AS h, CASE WHEN l.mz >= r.mz THEN r ELSE l END AS w, l, r FROM p JOIN v l ON l.id = id_a JOIN v r ON r.id = id_b),
 ev AS (SELECT DISTINCT l.id AS id, z FROM q, (VALUES (2, {_E / 2}::DOUBLE), (3, {_E / 3}::DOUBLE)) s(z, step) WHERE abs(abs(round(l.mz - r.mz, 4)) - step) <= 0.05 AND r.area <= l.area * 2 / 3),
 a AS (SELECT id_a, id_b, 1 AS o, 'multicharge' AS class, ion, abs((h.mz - {_E}) / charge + mzdiff - w.mz) AS err, sim, h.id AS hi, w.id AS lo FROM q JOIN pos ON charge > 1 WHERE abs((h.mz - {_E}) / charge + mzdiff - w.mz) <= 0.025 AND (w.id, charge) IN (SELECT id, z FROM ev)
 UNION ALL SELECT id_a, id_b, 2, 'dimer', name, abs((w.mz - {_E}) * CAST(ion[2] AS INT) + mzdiff - less - h.mz), sim, h.id, w.id FROM q JOIN more ON ion[2] IN ('2', '3') WHERE abs((w.mz - {_E}) * CAST(ion[2] AS INT) + mzdiff - less - h.mz) <= 0.025 AND NOT w.strong AND (NOT (h.has_peak AND ((h.held > w.mz + mzdiff + 18.01056 + 32.02566 AND h.held < h.mz - 0.05) OR h.held > h.mz + 0.05)) OR sim >= cutoff)
 UNION ALL SELECT id_a, id_b, 3, 'fragment', 'fragment', abs(h.held - w.mz), sim, h.id, w.id FROM q WHERE h.has_peak AND abs(h.held - w.mz) <= 0.05 AND greatest(0.1, sim) >= 0.2 AND h.blanks_total = 0 AND w.blanks_total = 0
 UNION ALL SELECT id_a, id_b, 4, 'adduct', name, abs(round(h.mz - w.mz, 4) + {_E} - (mzdiff - less)), sim, h.id, w.id FROM q JOIN more ON ion[1:2] = '[M' AND charge = 1 AND loss = 0 AND NOT regexp_matches(ion, '^\\[M\\+[0-9]+\\]') WHERE abs(round(h.mz - w.mz, 4) + {_E} - (mzdiff - less)) <= 0.025 AND sim >= cutoff
 UNION ALL SELECT id_a, id_b, 5, 'neutral_loss', ion, abs(round(h.mz - w.mz, 4) - mzdiff), sim, h.id, w.id FROM q JOIN pos ON loss = 1 WHERE abs(round(h.mz - w.mz, 4) - mzdiff) <= 0.025 AND sim >= cutoff
 UNION ALL SELECT id_a, id_b, 6, 'isotope', ion, abs(round(h.mz - w.mz, 4) - {ISOTOPE_STEP} * CAST(ion[4] AS INT)), sim, h.id, w.id FROM q JOIN pos ON regexp_matches(ion, '^\\[M\\+[0-9]+\\]') WHERE abs(round(h.mz - w.mz, 4) - {ISOTOPE_STEP} * CAST(ion[4] AS INT)) <= 0.025 AND sim >= cutoff
 UNION ALL SELECT id_a, id_b, 7, 'analog', 'analog', 0.0, sim, h.id, w.id FROM q WHERE sim >= 0.7),
 k AS MATERIALIZED (SELECT id_a, id_b, class, ion, floor(err * 100 + 0.5) / 100 AS mz_error, sim, CASE WHEN class IN ('adduct', 'dimer', 'isotope') THEN hi ELSE lo END AS src, CASE WHEN class IN ('adduct', 'dimer', 'isotope') THEN lo ELSE hi END AS dst FROM (SELECT *, min(o) OVER (PARTITION BY id_a, id_b) AS best FROM a) WHERE o = best)"""


@query(f"WITH {_PAIRS_SQL} SELECT id_a, id_b FROM p")
def coelution_with_blanks(spark, d):
    return annotate.coeluting(ions(spark, d), 1.0).select(F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"))


@query(_FOUND_SQL + " SELECT id, z AS charge FROM ev")
def isotopic_evidence(spark, d):
    return annotate.isotopic_evidence(graph.cut(annotate.coeluting(ions(spark, d), 1.0), "pairs"), 0.05)


@query(_FOUND_SQL + " SELECT * FROM k")
def ion_annotation(spark, d):
    return _found(spark, d)[0]


def _samples(spark, d):
    return ions(spark, d).select("id", F.array((F.col("id") % 3).cast("string"), F.lit("x")).alias("samples"))


_TEXT = "ion || ' (sim ' || CAST(sim AS VARCHAR) || ' - mzE ' || CAST(mz_error AS VARCHAR) || ' - rtE ' || CAST(rt_error AS VARCHAR) || ')[' || CAST(other AS VARCHAR) || ']{' || CAST(n AS VARCHAR) || '}'"
_KINDS = {"multicharge": "multi_charges", "dimer": "dimers", "fragment": "fragments", "adduct": "adducts", "neutral_loss": "neutral_losses", "isotope": "isotopes", "analog": "analogs"}
_DETAILS_SQL = ", t AS (SELECT k.*, abs(l.rt_mean - r.rt_mean) AS rt_error, CASE WHEN id_a % 3 = id_b % 3 THEN 2 ELSE 1 END AS n FROM k JOIN v l ON l.id = id_a JOIN v r ON r.id = id_b)"


@query(_FOUND_SQL + _DETAILS_SQL + ", b AS (SELECT src AS id, dst AS other, * FROM t UNION ALL SELECT dst, src, * FROM t WHERE class = 'analog') SELECT id, " + ", ".join(f"string_agg({_TEXT}, ';' ORDER BY other, {_TEXT}) FILTER (class = '{c}') AS {n}" for c, n in _KINDS.items()) + " FROM b GROUP BY id")
def annotation_columns(spark, d):
    found, pairs = _found(spark, d)
    return annotate.annotation_columns(found, annotate.pair_details(pairs, _samples(spark, d)))


@query(_FOUND_SQL + _DETAILS_SQL + ", e AS (SELECT src, dst, max(sim) AS cosine, string_agg(ion, ';' ORDER BY ion) AS annotation, arg_min(mz_error, ion) AS mz_error, any_value(rt_error) AS rt_error, any_value(n) AS n_common FROM t WHERE class <> 'analog' GROUP BY 1, 2) SELECT * FROM e UNION ALL SELECT id, id, 1.0, '', 0.0, 0.0, 0 FROM v WHERE id NOT IN (SELECT src FROM e UNION SELECT dst FROM e)")
def annotation_network(spark, d):
    found, pairs = _found(spark, d)
    return annotate.annotation_network(found, ions(spark, d).select("id"), annotate.pair_details(pairs, _samples(spark, d)))


@query(_FOUND_SQL + " SELECT class, count(*) AS n FROM k GROUP BY 1")
def annotation_classes(spark, d):
    """How many annotations each class has; none has none. No edge runs the wrong way."""
    found, _ = _found(spark, d)
    wrong = annotate.direction_errors(found, ions(spark, d)).groupBy("class").agg(F.count("*").alias("wrong"))
    return found.groupBy("class").agg(F.count("*").alias("n")).join(wrong, "class", "left_anti")


_PLURAL = {"isotope": "isotopes", "adduct": "adducts", "dimer": "dimers", "multicharge": "multicharges", "fragment": "fragments"}


def _symbolic_sql() -> str:
    """Class after class: what each round makes joins what the next one looks at."""
    out = _FOUND_SQL + ", links AS MATERIALIZED (SELECT DISTINCT dst AS origin, class, src AS target FROM k WHERE src NOT IN (SELECT id FROM v WHERE blanks_total > 0)), now0 AS (SELECT id, id AS origin, [id] AS merged FROM v WHERE blanks_total = 0), top AS (SELECT CASE WHEN max(id) > 1 THEN CAST(pow(10, length(CAST(max(id) - 1 AS VARCHAR))) AS BIGINT) ELSE 1 END AS start FROM v), n0 AS (SELECT start FROM top)"
    for k, (one, many) in enumerate(_PLURAL.items()):
        out += f", m{k} AS MATERIALIZED (SELECT w.id, w.origin, any_value(merged) AS merged, list_sort(list_distinct(list(target))) AS more, row_number() OVER (ORDER BY w.id) AS place FROM now{k} w JOIN links l ON l.origin = w.origin AND class = '{one}' AND NOT list_contains(merged, target) GROUP BY w.id, w.origin)"
        out += f", s{k} AS MATERIALIZED (SELECT place + start - 1 AS symbolic_id, '{many}' AS class, id AS source, origin, list_concat(merged, more) AS merged FROM m{k}, n{k}), n{k + 1} AS MATERIALIZED (SELECT start + (SELECT count(*) FROM s{k}) AS start FROM n{k})"
        out += f", now{k + 1} AS MATERIALIZED (SELECT * FROM now{k} UNION ALL SELECT symbolic_id, origin, merged FROM s{k})"
    return out + " " + " UNION ALL ".join(f"SELECT symbolic_id, class, source, array_to_string(merged, ';') AS merged FROM s{k}" for k in range(len(_PLURAL)))


@query(_symbolic_sql())
def symbolic_clusters(spark, d):
    found, _ = _found(spark, d)
    kind = F.element_at(F.create_map(*[F.lit(x) for p in _PLURAL.items() for x in p]), F.col("class"))
    links = found.where(F.col("class").isin(*_PLURAL)).select(F.col("dst").alias("id"), kind.alias("class"), F.col("src").alias("target"))
    known = ions(spark, d).select("id", "blanks_total", F.lit(1).alias("representative"))
    made, _ = symbolic.symbolic_clusters(quant.quantify(members(spark, d)), known, links)
    return made.select("symbolic_id", "class", "source", F.array_join("merged", ";").alias("merged"))
