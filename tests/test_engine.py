"""Operators on small tables made here, against plain Python."""

from __future__ import annotations

import itertools
import math
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ionloom.functions import stats
from ionloom.operators import annotate, correlation, graph, islands, joins, library, quant, symbolic
from ionloom.schema import checked_metadata


def test_range_join_is_the_theta_join(spark):
    rng = random.Random(3)
    a = [(i, round(rng.uniform(0, 5), 3)) for i in range(150)]
    l = spark.createDataFrame(a, "id long, x double")
    for tolerance in (0.0, 0.05, 0.7):
        got = joins.range_join(l.alias("l"), l.alias("r"), F.col("l.x"), F.col("r.x"), tolerance, extra=F.col("l.id") < F.col("r.id")).select(F.col("l.id"), F.col("r.id")).collect()
        assert {tuple(r) for r in got} == {(i, j) for (i, x), (j, y) in itertools.product(a, a) if i < j and abs(x - y) <= tolerance}
        assert len(got) == len(set(got))


def test_range_join_has_no_nested_loop(spark):
    l = spark.range(1000).withColumn("x", F.col("id") * 0.1)
    plan = joins.range_join(l.alias("l"), l.alias("r"), F.col("l.x"), F.col("r.x"), 0.05)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_peak_fakes_what_has_none(spark):
    s = spark.createDataFrame([(1, "a", 10.0, 5.0, False), (2, "a", 99.0, 5.0, False), (3, "a", 99.0, 5.0, True)], "spectrum_id long, sample string, mz double, rt double, is_blank boolean")
    p = spark.createDataFrame([("p1", "a", 9.9, 10.1, 4.0, 3.0, 6.0, 7.0), ("p2", "a", 9.9, 10.1, 5.5, 3.0, 8.0, 8.0)], "peak_id string, sample string, mz_min double, mz_max double, rt double, rt_min double, rt_max double, area double")
    got = {r.spectrum_id: r for r in joins.nearest_peak(s, p, 0.05, 1.0, 4.0).collect()}
    assert got[1].peak_id == "p2" and not got[1].is_fake
    assert got[2].peak_id == "fake_a" and (got[2].rt_min, got[2].rt_max) == (3.0, 7.0)
    assert got[3].is_baseline and got[3].rt_max == 1_000_000.0


def test_equal_truncated_areas_count_once(spark):
    rows = [(1, "a", 1, "x", 10.2, 1.0), (1, "a", 2, "y", 10.9, 1.0), (1, "a", 3, "z", 11.0, 1.0), (1, "b", 4, "w", 3.0, 1.0)]
    m = spark.createDataFrame(rows, "cluster_id long, sample string, scan long, peak_id string, peak_area double, base_peak_int double")
    got = {r["sample"]: (r.n_spectra, r.area) for r in quant.quantify(m).collect()}
    assert got == {"a": (3, 21.0), "b": (1, 3.0)}
    assert sum(n for n, _ in got.values()) == len(rows)


def test_substring_ids_only_when_asked(spark):
    d = spark.createDataFrame([(["1_S", "fake_S"], ["11_S"])], "a array<string>, b array<string>")
    assert not d.select(joins.shared_peak_ids(F.col("a"), F.col("b"))).first()[0]
    assert d.select(joins.shared_peak_ids(F.col("a"), F.col("b"), "substring")).first()[0]


def test_baseline_absorbs(spark):
    d = spark.createDataFrame([(1, 10.0, 5.0, 0.0, 1e6, 2.0, 7), (2, 10.1, 6.0, 5.0, 7.0, 1.0, 7)], "id long, mz double, rt_mean double, rt_min double, rt_max double, sum_ints double, g int")
    r = quant.merged(d, "g").first()
    assert (r.rt_min, r.rt_max, r.id) == (0.0, 1_000_000.0, 1)
    assert r.mz == pytest.approx(10.0333, abs=1e-4)


def test_top_k_drops_ties_at_the_cutoff(spark):
    e = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (1, 4, 0.8), (5, 5, 1.0)], "id_a long, id_b long, cosine double")
    assert {(r.id_a, r.id_b) for r in graph.mutual_top_k(e, 2).collect()} == {(1, 2), (5, 5)}
    assert len(graph.mutual_top_k(e, 3).collect()) == 4


def _components(pairs, nodes):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)]
    nodes = {n for p in pairs for n in p} | {999}
    got = graph.components(spark.createDataFrame(pairs, "id_a long, id_b long"), spark.createDataFrame([(n,) for n in nodes], "id long"))
    assert {r.id: r.component for r in got.collect()} == _components(pairs, nodes)


def test_pruning_bounds_components(spark):
    rng = random.Random(2)
    e = [(a, b, round(rng.uniform(0.6, 1), 3)) for a in range(30) for b in range(a + 1, 30) if rng.random() < 0.3]
    kept = graph.prune_components(spark.createDataFrame(e, "id_a long, id_b long, cosine double"), 8)
    sizes = graph.components(kept).groupBy("component").count().agg(F.max("count")).first()[0]
    assert sizes <= 8
    assert kept.join(spark.createDataFrame(e, "id_a long, id_b long, cosine double"), ["id_a", "id_b", "cosine"], "left_anti").count() == 0


def test_pagerank_adds_up_and_prefers_targets(spark):
    e = spark.createDataFrame([(1, 3), (2, 3), (3, 4), (5, 5)], "src long, dst long")
    got = {r.id: r["rank"] for r in graph.pagerank(e).collect()}
    assert sum(got.values()) == pytest.approx(1, abs=1e-6)
    assert got[4] > got[3] > got[1] == pytest.approx(got[2])


def test_representative_is_the_sink_of_variants(spark):
    edges = spark.createDataFrame([(1, 3, "[M+Na]+", 0.01, 0.5), (2, 3, "[M+K]+", 0.02, 0.1), (4, 4, "", 0.0, 0.0)], "src long, dst long, annotation string, mz_error double, rt_error double")
    nodes = spark.createDataFrame([(i, 0, 0) for i in (1, 2, 3, 4)], "id long, multicharge_ion int, isotope_ion int")
    got = {r.id: r for r in graph.protonated_representatives(edges, nodes).collect()}
    assert {i for i, r in got.items() if r.representative} == {3, 4}
    assert got[3].n_ancestors == 2 and got[3].mz_error_sum == pytest.approx(0.03) and got[3].n_ancestor_edges == 2


def test_a_multicharge_ion_is_no_representative(spark):
    edges = spark.createDataFrame([(1, 3, "[M+Na]+", 0.01, 0.5)], "src long, dst long, annotation string, mz_error double, rt_error double")
    nodes = spark.createDataFrame([(1, 0, 0), (3, 1, 0)], "id long, multicharge_ion int, isotope_ion int")
    assert not any(r.representative for r in graph.protonated_representatives(edges, nodes).collect())


def _cluster_rows(rng, n):
    return [(i, round(rng.uniform(100, 101.5), 4), t := round(rng.uniform(0, 60), 2), t - 2.0, t + 2.0, rng.randrange(1, 9), rng.uniform(1, 50), rng.uniform(0, 100), 0, False, [f"{i}_S"]) for i in range(n)]


def test_islands_clean_like_one_pass_over_everything(spark):
    rng = random.Random(11)
    rows = _cluster_rows(rng, 90)
    pairs = {(i, j): round(rng.random(), 2) for i in range(90) for j in range(i + 1, 90) if rng.random() < 0.3}
    d = spark.createDataFrame(rows, islands.CLEAN_COLUMNS)
    p = spark.createDataFrame([(i, j, c) for (i, j), c in pairs.items()], "id_a long, id_b long, cosine double")
    got = {r.id: r.rep for r in islands.greedy_clean(d, p, 0.025, 2.0, 0.55).collect()}
    whole = islands.clean_island([islands._Row(r) for r in d.toPandas().itertuples()], pairs, 0.55, 0.025, 2.0, -1.0, False, True)
    assert got == {m: r.id for r in whole for m in r.members}
    assert set(got) == set(range(90))


def test_no_mergeable_pair_is_left_by_ms1_clean(spark):
    rng = random.Random(4)
    d = spark.createDataFrame(_cluster_rows(rng, 60), islands.CLEAN_COLUMNS)
    merged = islands.greedy_clean(d, None, 0.025, 2.0, None)
    rest = quant.merged(d.join(merged, "id").drop("peak_ids"), "rep").select("id", "mz", "rt_mean", "rt_min", "rt_max", F.lit(False).alias("bflag"))
    assert joins.coelution_pairs(rest, 0.025, 2.0).count() == 0


def test_islands_across_buckets(spark):
    d = spark.createDataFrame([(i, i * 0.02) for i in range(9000)] + [(10_000, 500.0)], "id long, mz double")
    assert islands.islands(d, "mz", 0.025).select("island").distinct().count() == 2


def test_clusters_of_planted_groups(spark):
    rows = []
    for g in range(5):
        peaks = [(50.0 + 10 * k + g, 100.0 * (k + 1)) for k in range(8)]
        rows += [(g * 10 + c, 300.0 + g * 5 + c * 0.001, 10.0, 8.0, 12.0, 1.0 + c, peaks) for c in range(4)]
    d = spark.createDataFrame(rows, "id long, mz double, rt_mean double, rt_min double, rt_max double, precursor_intensity double, peaks array<struct<mz:double,intensity:double>>")
    got = {r.id: r.cluster_id for r in islands.cluster(d, 0.025, 0.05, 1.0, 0.55).collect()}
    assert got == {g * 10 + c: g * 10 for g in range(5) for c in range(4)}


def test_correlation_status(spark):
    q = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 3.0), (2, "a", 5.0), (2, "b", 5.0), (2, "c", 5.0), (3, "a", 0.0)], "cluster_id long, sample string, area double")
    bio = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), ("c", "x", 3.0)], "sample string, bioactivity string, value double")
    groups = spark.createDataFrame([(s, "all") for s in "abc"], "sample string, cor string")
    for method in ("pearson", "spearman", "kendall"):
        got = {r.cluster_id: (r["corr"], r.corr_status) for r in correlation.correlate(q, bio, groups, q.select("cluster_id"), method).collect()}
        assert got[1][0] == pytest.approx(1.0) and got[2] == (None, "CTE") and got[3] == (None, None)


def test_annotation_classes(spark):
    peaks = [(60.0, 5.0)]
    rows = [(1, 100.0, peaks), (2, 121.9814, peaks), (3, 101.0033, peaks), (4, 81.9894, peaks)]
    d = spark.createDataFrame([(i, m, 10.0, 8.0, 12.0, 0, [1], 9.0, p, False) for i, m, p in rows], "id long, mz double, rt_mean double, rt_min double, rt_max double, blanks_total long, batches array<int>, area double, peaks array<struct<mz:double,intensity:double>>, strong boolean")
    pairs = annotate.coeluting(d, 1.0).withColumns({"sim": F.lit(0.9), "trim_sim": F.lit(0.0)})
    rules = spark.createDataFrame([("[M+Na]+", 22.98922, 1, 0, 0, 0, 0.2), ("[M+1]+", 0.0, 1, 0, 0, 0, 0.75), ("[M+H-H2O]+", 18.0106, 1, 0, 0, 1, 0.2)], "ion string, mzdiff double, charge int, neutral_loss_h2o int, neutral_loss_nh3 int, neutral_loss int, sim_cutoff double")
    found = annotate.annotated_pairs(pairs, rules, annotate.isotopic_evidence(pairs, 0.01), 0.01, 0.01)
    got = {(r.id_a, r.id_b): r["class"] for r in found.collect()}
    assert got[1, 2] == "adduct" and got[1, 3] == "isotope" and got[1, 4] == "neutral_loss"
    assert annotate.direction_errors(found, d).count() == 0


def test_symbolic_ids_follow_the_next_power_of_ten(spark):
    clusters = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 1, 0), (42, 0, 1)], "id long, blanks_total long, representative int")
    links = spark.createDataFrame([(1, "adducts", 2), (1, "adducts", 3), (1, "fragments", 42)], "id long, class string, target long")
    q = spark.createDataFrame([(1, "a", 2, 5.0), (2, "a", 3, 7.0), (42, "b", 1, 1.0)], "cluster_id long, sample string, n_spectra long, area double")
    made, counts = symbolic.symbolic_clusters(q, clusters, links)
    got = {r.symbolic_id: (r["class"], r.source, r.merged) for r in made.collect()}
    assert got[100] == ("adducts", 1, [1, 2])
    assert got[101] == ("fragments", 1, [1, 42]) and got[102] == ("fragments", 100, [1, 2, 42])
    assert {(r.symbolic_id, r["sample"]): r.area for r in counts.collect()}[100, "a"] == 12.0


def test_an_unknown_compound_fails(spark):
    hits = spark.createDataFrame([(1, 9)], "id long, compound_id long")
    with pytest.raises(Exception, match="no such compound"):
        library.with_compounds(hits, spark.createDataFrame([(1, "x")], "compound_id long, name string")).collect()


def test_metadata_rules(spark):
    good = spark.createDataFrame([("f", "S1", "1", "Blank", "1.5", "1", "red"), ("g", "S2", "2", "sample", "x", "0", None)], "filename string, sample_code string, data_collection_batch string, sample_type string, bioactivity_a string, cor_all string, gr_c string")
    rows = {r.sample_code: r for r in checked_metadata(good).collect()}
    assert rows["S1"].sample_type == "blank" and rows["S1"].bioactivity == {"A": 1.5} and rows["S2"].bioactivity == {"A": None}
    with pytest.raises(Exception, match="batches"):
        checked_metadata(good.withColumn("data_collection_batch", F.lit("3"))).collect()
    with pytest.raises(ValueError, match="lacks"):
        checked_metadata(good.drop("sample_type"))


def test_entry_works_without_the_llm_folder():
    code = "import sys; sys.modules['ionloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'quant_spectra_pivot' in q and not any(k.startswith('op') and k[2].isdigit() for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0], timeout=120)


def test_components_fail_loudly(spark, monkeypatch):
    monkeypatch.setattr(graph, "MOST_ROUNDS", 1)
    chain = spark.range(200).select(F.col("id").alias("id_a"), (F.col("id") + 1).alias("id_b"))
    with pytest.raises(RuntimeError):
        graph.components(chain)
    with pytest.raises(RuntimeError):
        graph.pagerank(chain.withColumnsRenamed({"id_a": "src", "id_b": "dst"}), tolerance=0.0, most_rounds=2)


def test_numbers_follow_the_order(spark):
    got = graph.numbered(spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(5), "x", "place").collect()
    assert [r.place for r in sorted(got, key=lambda r: r.x)] == list(range(1, 1001))


def test_time_parts_islands(spark):
    rows = [(i, 100.0 + 0.01 * i, 50.0 * (i % 3), 50.0 * (i % 3) - 2, 50.0 * (i % 3) + 2) for i in range(30)]
    own = spark.createDataFrame(rows, "id long, mz double, rt_mean double, rt_min double, rt_max double")
    assert islands.islands(own, "mz", 0.025).select("island").distinct().count() == 1
    assert islands.timed_islands(own, "mz", 0.035, 1.0).select("island").distinct().count() == 3
    assert islands.timed_islands(own, "mz", 0.025, 1.0).select("island").distinct().count() == 30


def test_kendall_is_the_sum_over_pairs_that_never_become_rows(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, *range(n)]) if k == 3 else i, float(rng.randrange(m)), None if rng.random() < 0.05 else float(rng.randrange(9))) for k, n, m in ((1, 70, 9), (2, 41, 1), (3, 50, 30), (4, 1, 1), (5, 2, 5)) for i in range(n)]
    rows += [(None, 1, 1.0, 2.0), (None, 2, 2.0, 3.0), (6, 1, math.nan, 2.0), (6, 2, 1.0, 3.0)]
    d = spark.createDataFrame(rows, "key long, o long, x double, y double")
    found = stats.kendall(d, ["key"], "x", "y", "o")
    want = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key and r[3] is not None]
        sign = [((a[2] > b[2]) - (a[2] < b[2]), (a[3] > b[3]) - (a[3] < b[3])) for a, b in itertools.combinations(own, 2) if None not in (a[1], b[1]) and a[1] != b[1]]
        s, nx, ny = sum(x * y for x, y in sign), sum(abs(x) for x, _ in sign), sum(abs(y) for _, y in sign)
        want[key] = (len(own), s / math.sqrt(nx * ny) if nx and ny and key else None)
    got = {r.key: (r.n, r.corr) for r in found.collect()}
    assert math.isnan(got.pop(6)[1]) and want.pop(6)
    assert got == {k: (n, c if c is None else pytest.approx(c)) for k, (n, c) in want.items() if n}
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def _plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_nearest_peak_is_that_of_all_pairs_and_peaks_are_not_broadcast(spark):
    rng = random.Random(6)
    s = [(i // 2 if i < 20 else i, rng.choice("ab"), rng.choice([None, 5.0, round(rng.uniform(0, 20), 1)]), float(rng.randrange(60)), i % 3 == 0) for i in range(300)]
    p = [(f"p{k}", rng.choice("ab"), mz, mz + rng.choice([0.5, 1.0, 30.0]), rt, rt - rng.randrange(4), rt + rng.choice([1, 4, 1_000_000]), float(k)) for k in range(150) for mz, rt in [(rng.choice([4.5, round(rng.uniform(0, 20), 1)]), float(rng.randrange(60)))]]
    d = joins.nearest_peak(spark.createDataFrame(s, "spectrum_id long, sample string, mz double, rt double, is_blank boolean"), spark.createDataFrame(p, "peak_id string, sample string, mz_min double, mz_max double, rt double, rt_min double, rt_max double, area double"), 0.05, 3.0, 6.0)
    met = {}
    for i, sample, mz, rt, _ in s:
        met.setdefault(i, []).extend((abs(rt - q[4]), q[0], q[7]) for q in p if mz is not None and q[1] == sample and q[2] - 0.05 <= mz <= q[3] + 0.05 and q[5] - 3 <= rt <= q[6] + 3)
    want = [(i, min(met[i])[1:] if met[i] else ("fake_" + sample, None), not met[i], len(met[i])) for i, sample, *_ in s]
    assert sorted(map(str, ((r.spectrum_id, (r.peak_id, r.peak_area), r.is_fake, r.n_candidates) for r in d.collect()))) == sorted(map(str, want))
    assert "SortMergeJoin" in _plan(d) and "_rt" in _plan(d)


def _meet(a, b, t):
    return a["rt_min"] - t <= b["rt_mean"] <= a["rt_max"] + t or b["rt_min"] - t <= a["rt_mean"] <= b["rt_max"] + t


def _aligned(a, b, t):
    return abs(a["rt_mean"] - b["rt_mean"]) <= 4 * t or math.sqrt(((a["rt_min"] - b["rt_min"]) ** 2 + (a["rt_max"] - b["rt_max"]) ** 2) / 2) <= 2 * t


def _clusters(n, seed):
    rng = random.Random(seed)
    own = [{"id": i, "mz": rng.randrange(12) / 4, "rt_mean": rng.randrange(120) / 2} for i in range(n)]
    for c in own:
        c |= {"rt_min": c["rt_mean"] - rng.choice([0, 3.5, 9, 40]), "rt_max": c["rt_mean"] + rng.choice([0, 2, 8, 1_000_000]), "bflag": rng.choice([None, False, False, True]), "blanks_total": rng.choice([0, 0, 0, 2]), "batches": rng.choice([None, [1], [2, 1], [3, None], [1, 2, 3], [2, 2, 4], [None]])}
        c["peak_ids"] = rng.choice([None, ["fake_a"], ["fake_a", "a"], ["a", "b"], ["b", "c", "a"], ["c", "c"], ["d"], [None, "d", "b"]])
    return own


_CLUSTERS = "id long, mz double, rt_mean double, rt_min double, rt_max double, bflag boolean, blanks_total long, batches array<int>, peak_ids array<string>"


@pytest.mark.parametrize("refine", [False, True])
def test_coelution_pairs_meet_by_mass_and_time(spark, refine):
    own = _clusters(150, 7)
    found = joins.coelution_pairs(spark.createDataFrame(own, _CLUSTERS), 0.5, 2.0, refine)
    want = [(a["id"], b["id"]) for a, b in itertools.combinations(own, 2) if abs(a["mz"] - b["mz"]) <= 0.5 and _meet(a, b, 2) and (not refine or a["bflag"] or _aligned(a, b, 2))]
    assert sorted(map(tuple, found.collect())) == want
    assert "_cell" in _plan(found) and "BroadcastHashJoin" not in _plan(found)


@pytest.mark.parametrize("blanks", [False, True])
def test_coeluting_pairs_meet_by_batch_and_time(spark, blanks):
    own = [c | {"blanks_total": c["blanks_total"] if blanks else 0} for c in _clusters(150, 8)]
    found = annotate.coeluting(spark.createDataFrame(own, _CLUSTERS), 1.0)
    seen = [c | {"own_min": c["rt_min"], "own_max": c["rt_max"]} | ({"rt_min": c["rt_mean"] - 3, "rt_max": c["rt_mean"] + 3} if c["blanks_total"] else {}) for c in own]
    plain = lambda c: c | {"rt_min": c["own_min"], "rt_max": c["own_max"]}
    shared = lambda a, b: bool({*(a["batches"] or ())} & {*(b["batches"] or ())} - {None})
    want = [(a["id"], b["id"]) for a, b in itertools.combinations(seen, 2) if shared(a, b) and _meet(a, b, 1) and (a["blanks_total"] or b["blanks_total"] or _aligned(plain(a), plain(b), 1))]
    assert sorted(map(tuple, found.select("l.id", "r.id").collect())) == want
    assert "_batch" in _plan(found) and "BroadcastHashJoin" not in _plan(found)
    assert not [c for c in found.schema["l"].dataType.names if c.startswith("_")]


def test_peak_sharing_pairs_meet_once_by_peak_and_mass(spark):
    own = _clusters(150, 9)
    found = joins.peak_sharing_pairs(spark.createDataFrame(own, _CLUSTERS), 0.25)
    real = lambda c: {p for p in c["peak_ids"] or () if p and not p.startswith("fake_")}
    assert sorted(map(tuple, found.collect())) == [(a["id"], b["id"]) for a, b in itertools.combinations(own, 2) if abs(a["mz"] - b["mz"]) <= 0.25 and real(a) & real(b)]
    assert "BroadcastHashJoin" not in _plan(found)


def test_shared_peak_ids_goes_by_peak(spark, small):
    from ionloom.plans import catalog

    assert "_peak" in _plan(catalog.shared_peak_ids(spark, small)) and "BroadcastHashJoin" not in _plan(catalog.shared_peak_ids(spark, small))
